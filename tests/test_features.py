import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cardwatch.functions import on_demand
from cardwatch.operators.feature_views import historical_features, latest_features
from cardwatch.plans.driver_features import BATCH, CATALOG, KEY, PUSHED
from cardwatch.sources.features import entity_rows
from cardwatch.streaming import push

STATS = ("driver_id bigint, event_timestamp timestamp_ntz, created timestamp_ntz, "
         "conv_rate float, acc_rate float, avg_daily_trips bigint")
THEN = datetime(2021, 4, 12, 8, 0)


def stats(spark):
    rows = [(d, THEN, THEN, 0.5, 0.8, 10) for d in (1001, 1002)]
    return spark.createDataFrame(rows, STATS)


def one(spark, expressions, conv, acc, trips):
    frame = spark.createDataFrame([(conv, acc, trips)], "c double, a double, t bigint")
    return frame.select(*expressions(F.col("c"), F.col("a"), F.col("t"))).first()


def test_performance(spark):
    row = one(spark, on_demand.performance, 0.5, 0.8, 10)
    assert row.combined_rating == pytest.approx(0.62)
    assert row.performance_score == pytest.approx(1.486695, abs=1e-6)


def test_risk_adjusted(spark):
    row = one(spark, on_demand.risk_adjusted, 0.5, 0.8, 10)
    assert row.risk_adjusted_score == pytest.approx(1.285871, abs=1e-6)
    assert row.engagement_level == pytest.approx(1.022761, abs=1e-6)
    empty = one(spark, on_demand.risk_adjusted, None, math.nan, None)
    assert empty.risk_adjusted_score == 0
    assert empty.engagement_level == pytest.approx(1e-6)


def test_missing_rate_stays_missing(spark):
    frame = spark.createDataFrame([(None, 1, 2)], "c float, x bigint, y bigint")
    row = frame.select(*on_demand.conv_rate_plus(F.col("c"), F.col("x"), F.col("y"))).first()
    assert row[0] is None and row[1] is None


def training_rows(spark):
    rows = [
        {"driver_id": d, "event_timestamp": datetime(2021, 4, 12, h, m, s),
         "label_driver_reported_satisfaction": y, "val_to_add": v, "val_to_add_2": 10 * v}
        for d, h, m, s, y, v in [(1001, 10, 59, 42, 1, 1), (1002, 8, 12, 10, 5, 2),
                                 (1003, 16, 40, 26, 3, 3)]
    ]
    schema = ("driver_id bigint, event_timestamp timestamp_ntz, "
              "label_driver_reported_satisfaction int, val_to_add bigint, val_to_add_2 bigint")
    return entity_rows(spark, rows, schema)


def test_whole_flow(spark, tmp_path):
    """Historical, scoring time, latest, a push, and the latest again."""
    wanted = ["driver_hourly_stats:conv_rate", "transformed_conv_rate:conv_rate_plus_val2"]
    past = historical_features(CATALOG, training_rows(spark), wanted, {BATCH: stats(spark)})
    got = {r.driver_id: (r.conv_rate, r.conv_rate_plus_val2) for r in past.collect()}
    assert got == {1001: (0.5, 10.5), 1002: (0.5, 20.5), 1003: (None, None)}

    now = datetime(2024, 1, 1)
    scoring = historical_features(
        CATALOG, training_rows(spark), wanted, {BATCH: stats(spark)}, as_of=now
    )
    assert {r.conv_rate for r in scoring.collect()} == {None}

    root = f"file://{tmp_path}/push"
    schema = stats(spark).schema
    push.push_batch(stats(spark), 0, root, KEY)
    push.push_batch(spark.createDataFrame([(1001, now, now, 1.0, 1.0, 1000)], STATS), 1, root, KEY)
    older = datetime(2020, 1, 1)
    push.push_batch(spark.createDataFrame([(1001, older, now, 0.1, 0.1, 1)], STATS), 2, root, KEY)

    def served():
        asked = entity_rows(
            spark,
            [{"driver_id": 1001, "val_to_add": 1000, "val_to_add_2": 2000},
             {"driver_id": 7, "val_to_add": 1001, "val_to_add_2": 2002}],
            "driver_id bigint, val_to_add bigint, val_to_add_2 bigint",
        )
        latest = push.read_latest(spark, root, KEY, schema)
        rows = latest_features(CATALOG, asked, "driver_activity_v3", {PUSHED: latest}).collect()
        return {r.driver_id: (r.avg_daily_trips, r.conv_rate_plus_val1) for r in rows}

    expected = {1001: (1000, 1001.0), 7: (None, None)}
    assert served() == expected
    assert push.read_history(spark, root, schema).count() == 4
    push.compact(spark, root, KEY, schema)
    assert served() == expected
    later = datetime(2025, 1, 1)
    push.push_batch(spark.createDataFrame([(1001, later, later, 0.0, 1.0, 5)], STATS), 3, root, KEY)
    assert served() == {1001: (5, 1000.0), 7: (None, None)}
    push.push_batch(spark.createDataFrame([(1001, later, later, 0.0, 1.0, 5)], STATS), 3, root, KEY)
    assert push.read_history(spark, root, schema).count() == 5


def test_views_keep_their_own_ttl(spark):
    asked = spark.createDataFrame(
        [(1001, datetime(2021, 4, 12, 19)), (1001, datetime(2021, 4, 14, 8))],
        "driver_id bigint, event_timestamp timestamp_ntz",
    )
    wanted = ["driver_reliability:acc_rate", "driver_activity:avg_daily_trips",
              "driver_hourly_stats:conv_rate"]
    got = historical_features(CATALOG, asked, wanted, {BATCH: stats(spark)}).collect()
    rows = {r.event_timestamp.day: r for r in got}
    assert rows[12].acc_rate is not None and rows[12].conv_rate == 0.5
    assert rows[14].acc_rate is None and rows[14].conv_rate is None
    assert rows[14].avg_daily_trips == 10


@pytest.mark.parametrize("wanted", ["driver_activity_v9", ["nothing:conv_rate"],
                                    ["driver_activity:conv_rate"]])
def test_unknown_names_are_refused(spark, wanted):
    with pytest.raises(ValueError):
        CATALOG.resolve(wanted)


def test_missing_request_columns_are_refused(spark):
    asked = training_rows(spark).drop("val_to_add_2")
    with pytest.raises(ValueError, match="val_to_add_2"):
        historical_features(CATALOG, asked, "driver_activity_v1", {BATCH: stats(spark)})


def test_same_feature_of_two_views_needs_full_names(spark):
    wanted = ["driver_hourly_stats:conv_rate", "driver_reliability:conv_rate"]
    sources = {BATCH: stats(spark)}
    with pytest.raises(ValueError, match="full_names"):
        historical_features(CATALOG, training_rows(spark), wanted, sources)
    named = historical_features(CATALOG, training_rows(spark), wanted, sources, full_names=True)
    assert named.columns[-2:] == ["driver_hourly_stats__conv_rate", "driver_reliability__conv_rate"]


def test_an_on_demand_view_may_use_pandas(spark):
    import pandas as pd

    from cardwatch.operators.feature_views import Catalog, OnDemandView
    from cardwatch.plans.driver_features import VIEWS

    @F.pandas_udf("double")
    def doubled(rate: pd.Series) -> pd.Series:
        return rate * 2.0

    view = OnDemandView("twice", "driver_hourly_stats", ("conv_rate",), ("twice_rate",),
                        lambda rate: [doubled(rate).alias("twice_rate")])
    catalog = Catalog(VIEWS, (view,), (("set", ("twice",)),), KEY)
    got = historical_features(catalog, training_rows(spark), "set", {BATCH: stats(spark)})
    assert {r.driver_id: r.twice_rate for r in got.collect()} == {1001: 1.0, 1002: 1.0, 1003: None}
