"""Putting one-row results together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One row with the columns of several one-row frames; no join is needed."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
