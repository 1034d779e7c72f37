"""Tolerant conversions: text that does not parse becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cardwatch.schema import TIMESTAMP_PATTERN, TRANSACTION_TYPES


def parse_timestamp(text: Column, pattern: str = TIMESTAMP_PATTERN) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def typed(name: str, text: Column) -> Column:
    """One raw field as its transaction type."""
    kind = TRANSACTION_TYPES[name]
    value = parse_timestamp(text) if kind == "timestamp_ntz" else text.try_cast(kind)
    return value.alias(name)


def coerce_numeric(value: Column) -> Column:
    """A double, with 0 for null, NaN and text that is no number."""
    number = value.try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))
