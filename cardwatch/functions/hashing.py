"""Repeatable pseudo-random assignment of rows by key.

The value depends on the key alone, so it survives any repartitioning, a second
job over the same table and a lost executor.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def key_bucket(key: Column) -> Column:
    """The first 8 hex digits of the key's md5, as a number below 2**32."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def split_name(key: Column, test_percent: int = 20) -> Column:
    return F.when(key_bucket(key) % 100 >= 100 - test_percent, "test").otherwise("train")


def fold_number(key: Column, folds: int = 3) -> Column:
    return (key_bucket(key) % folds).cast("int")
