"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwatch.session import scratch_path


def written(frame: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """The same rows, read back from a table: lineage ends here, lost executors cost nothing.

    Whole texts are better written with ``zstd``, which takes about half of the room.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.option("compression", codec).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
