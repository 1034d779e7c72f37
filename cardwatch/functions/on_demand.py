"""Features computed at request time from stored features and request columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cardwatch.functions.parsing import coerce_numeric

CONV_WEIGHT, ACC_WEIGHT = 0.6, 0.4
EPSILON = 1e-6


def conv_rate_plus(conv_rate: Column, val_to_add: Column, val_to_add_2: Column) -> list[Column]:
    """The rate is stored as a 32-bit float; the sum is declared 64-bit."""
    rate = conv_rate.cast("double")
    return [
        (rate + val_to_add).alias("conv_rate_plus_val1"),
        (rate + val_to_add_2).alias("conv_rate_plus_val2"),
    ]


def performance(conv_rate: Column, acc_rate: Column, avg_daily_trips: Column) -> list[Column]:
    rating = conv_rate.cast("double") * CONV_WEIGHT + acc_rate.cast("double") * ACC_WEIGHT
    return [
        rating.alias("combined_rating"),
        (rating * F.log1p(avg_daily_trips)).alias("performance_score"),
    ]


def risk_adjusted(conv_rate: Column, acc_rate: Column, avg_daily_trips: Column) -> list[Column]:
    """Unlike the other views this one reads a missing or bad input as 0."""
    activity = F.log1p(coerce_numeric(avg_daily_trips))
    reliability = (coerce_numeric(acc_rate) + coerce_numeric(conv_rate)) / 2
    harmonic = 2.0 / (1.0 / (activity + EPSILON) + 1.0 / (reliability + EPSILON))
    return [
        (activity * reliability * (0.5 + 0.5 * reliability)).alias("risk_adjusted_score"),
        harmonic.alias("engagement_level"),
    ]
