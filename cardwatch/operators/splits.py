"""Train/test split and folds by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardwatch.functions.hashing import fold_number, split_name


def with_split(df: DataFrame, key: str, test_percent: int = 20) -> DataFrame:
    return df.withColumn("split", split_name(F.col(key), test_percent))


def train_test(df: DataFrame, key: str, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    name = split_name(F.col(key), test_percent)
    return df.filter(name == "train"), df.filter(name == "test")


def with_fold(df: DataFrame, key: str, folds: int = 3) -> DataFrame:
    return df.withColumn("fold", fold_number(F.col(key), folds))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order; each task keeps only its own first rows."""
    return df.orderBy(*order).limit(rows)
