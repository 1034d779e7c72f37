"""The driver feature catalog: views, on-demand views and the five feature sets."""

from __future__ import annotations

from datetime import timedelta

from cardwatch.functions import on_demand
from cardwatch.operators.feature_views import Catalog, FeatureView, OnDemandView

KEY = "driver_id"
BATCH, PUSHED = "driver_stats", "driver_stats_push"

# Callers ask for features by these names.
_RATES = ("conv_rate", "acc_rate")
_STATS = (*_RATES, "avg_daily_trips")
_PERFORMANCE_TEAM = (("team", "driver_performance"),)

VIEWS = (
    FeatureView("driver_hourly_stats", BATCH, _STATS, timedelta(days=1), _PERFORMANCE_TEAM),
    FeatureView("driver_hourly_stats_fresh", PUSHED, _STATS, timedelta(days=1), _PERFORMANCE_TEAM),
    FeatureView("driver_reliability", BATCH, ("acc_rate", "conv_rate"), timedelta(hours=12)),
    FeatureView("driver_activity", BATCH, ("avg_daily_trips",), timedelta(days=3)),
)
_PLUS = ("conv_rate_plus_val1", "conv_rate_plus_val2")
_VALUES = ("val_to_add", "val_to_add_2")
ON_DEMAND = (
    OnDemandView("transformed_conv_rate", "driver_hourly_stats",
                 ("conv_rate",), _PLUS, on_demand.conv_rate_plus, _VALUES),
    OnDemandView("transformed_conv_rate_fresh", "driver_hourly_stats_fresh",
                 ("conv_rate",), _PLUS, on_demand.conv_rate_plus, _VALUES),
    OnDemandView("driver_performance_metrics", "driver_hourly_stats",
                 _STATS, ("combined_rating", "performance_score"), on_demand.performance),
    OnDemandView("driver_risk_adjusted_performance", "driver_hourly_stats",
                 _STATS, ("risk_adjusted_score", "engagement_level"), on_demand.risk_adjusted),
)
SETS = (
    ("driver_activity_v1", ("driver_hourly_stats:conv_rate", "transformed_conv_rate")),
    ("driver_activity_v2", ("driver_hourly_stats", "transformed_conv_rate")),
    ("driver_activity_v3", ("driver_hourly_stats_fresh", "transformed_conv_rate_fresh")),
    ("driver_activity_v4", ("driver_hourly_stats", "driver_performance_metrics")),
    ("driver_performance_realtime",
     ("driver_hourly_stats", "driver_risk_adjusted_performance")),
)

CATALOG = Catalog(VIEWS, ON_DEMAND, SETS, KEY)
