"""Batch writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_rejects(df: DataFrame, path: str) -> None:
    """CSV with header; list columns become text parted by ``;``."""
    columns = [
        F.array_join(f.name, ";").alias(f.name) if isinstance(f.dataType, ArrayType) else f.name
        for f in df.schema.fields
    ]
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_log(lines: DataFrame, path: str) -> None:
    """One text line per row of the single column."""
    lines.write.mode("overwrite").text(path)


def log_served(served: DataFrame, path: str) -> None:
    """Append what was served, and when."""
    served.withColumn("served_at", F.current_timestamp()).write.mode("append").parquet(path)


def write_messages(
    df: DataFrame, sink: str = "text", path: str | None = None, options: dict | None = None
) -> None:
    """Send ``value`` texts; Kafka waits for all replicas and retries three times."""
    writer = df.select("value").write.format(sink).mode("append")
    if sink == "kafka":
        writer.options(**{**DELIVERY, **(options or {})}).save()
    else:
        writer.options(**(options or {})).save(path)


# Delivery settings of the message sink.
DELIVERY = {"kafka.acks": "all", "kafka.retries": "3", "kafka.request.timeout.ms": "30000"}


def current_version(spark: SparkSession, root: str) -> int:
    """The newest published version below ``root``, 0 when there is none."""
    try:
        published = spark.read.schema("version int").parquet(f"{root}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return published.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    version = current_version(spark, root)
    return spark.read.parquet(f"{root}/version={version}") if version else None


def publish(df: DataFrame, root: str) -> int:
    """Write a new version beside the current one, then announce it.

    Readers see the old version until the announcement row is committed, and ``df``
    may read the current version.  One writer at a time.
    """
    version = current_version(df.sparkSession, root) + 1
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    marker = df.sparkSession.range(1).select(F.lit(version).cast("int").alias("version"))
    marker.write.mode("append").parquet(f"{root}/published")
    return version
