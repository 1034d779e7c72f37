"""Timestamped feature tables and literal request rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_feature_source(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.read.parquet(*paths)


def entity_rows(spark: SparkSession, rows: list[dict], schema: StructType | str) -> DataFrame:
    """Request rows written in code; the schema is stated, never inferred."""
    return spark.createDataFrame(rows, schema)
