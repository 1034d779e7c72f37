"""Delay percentiles and distinct counts from daily sketches that merge over any range of days.

A day is one row: exact counts, a KLL sketch of the delays and a HyperLogLog sketch of the ids.  Sketches are built by partial
aggregates, so no task holds the distinct values of a day.  A range is the merge of its days' rows; the events are not
read again.

The rank of a reported percentile is off by at most ``rank_error(k)`` of the range's rows with 99 % confidence, whatever the
number of days merged; a distinct count has a standard error of ``distinct_error(lg)``.  Counts, shares and maxima are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.operators.monitoring import MAX_DELAY_MS, MIN_SHARE_IN_TIME

K = 1000
LG = 14
SUMS = ("decisions", "in_time")


def rank_error(k: int = K) -> float:
    """Of KLL sketches, one-sided, at 99 % confidence."""
    return 2.296 / k**0.9723


def distinct_error(lg: int = LG) -> float:
    return 1.04 / 2 ** (lg / 2)


def daily_delays(df: DataFrame, time: str, delay_ms: str, ids: tuple[str, ...] = (), k: int = K, lg: int = LG) -> DataFrame:
    """day, decisions, in_time, max_ms, delays (sketch) and one sketch per id column; rows without a delay are left out."""
    ms = F.col(delay_ms).cast("bigint")
    return df.filter(F.col(delay_ms).isNotNull()).groupBy(F.col(time).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("decisions"),
        F.count_if(ms <= MAX_DELAY_MS).alias("in_time"),
        F.max(ms).alias("max_ms"),
        F.kll_sketch_agg_bigint(ms, k).alias("delays"),
        *[F.hll_sketch_agg(c, lg).alias(f"{c}_sketch") for c in ids],
    )


def merge_days(days: DataFrame, *by: Column | str, ids: tuple[str, ...] = (), k: int = K) -> DataFrame:
    """One row per group of days, such as months, or one in all; of the same form, so it can be merged again."""
    return days.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_bigint("delays", k).alias("delays"),
        *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in ids],
    )


def read_delays(merged: DataFrame, ids: tuple[str, ...] = ()) -> DataFrame:
    """What :func:`cardwatch.operators.monitoring.latency_share` reports, and the distinct ids, from merged days."""
    share = F.col("in_time") / F.nullif(F.col("decisions"), F.lit(0))
    kept = [c for c in merged.columns if c not in (*SUMS, "max_ms", "delays", *[f"{c}_sketch" for c in ids])]
    return merged.select(
        *kept, "decisions", share.alias("share_in_time"),
        F.kll_sketch_get_quantile_bigint("delays", F.lit(0.5)).alias("median_ms"),
        F.kll_sketch_get_quantile_bigint("delays", F.lit(0.95)).alias("p95_ms"),
        "max_ms", (share >= MIN_SHARE_IN_TIME).alias("within_target"),
        *[F.hll_sketch_estimate(f"{c}_sketch").alias(f"{c}s") for c in ids],
    )
