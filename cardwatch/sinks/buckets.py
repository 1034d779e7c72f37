"""A table of one row per key in hash buckets, whose versions rewrite only the buckets that change.

A version is a directory of at most ``buckets`` rows, (bucket, folder), published when its folders are written.  A request
reads the folders of its own keys' buckets; an update writes new folders for the buckets of its keys and keeps the files of
all others.  Readers of an older version are not disturbed; one writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cardwatch.operators.latest import fresh_rows, latest_per_key, lookup_latest
from cardwatch.sinks.tables import publish, read_current

BUCKETS = 256
DIRECTORY = "bucket int, folder string, buckets int, covered_until string"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def directory(spark: SparkSession, root: str) -> list:
    """The entries of the current version, one per bucket that has rows; none when there is no version."""
    current = read_current(spark, f"{root}/directory")
    return [] if current is None else current.orderBy("bucket").collect()


def _asked(rows: DataFrame, keys: list[str], buckets: int) -> set[int]:
    """The buckets of the rows' keys; at most ``buckets`` numbers come to the driver."""
    return {r[0] for r in rows.select(bucket_of(keys, buckets)).distinct().collect()}


def read_buckets(spark: SparkSession, entries: list, schema: StructType, only: set[int] | None = None) -> DataFrame:
    """The rows of the entries' folders, or of those in ``only``."""
    folders = [e.folder for e in entries if only is None or e.bucket in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def merge_buckets(
    fresh: DataFrame, root: str, key: str | list[str], *, time: str = "event_timestamp", created: str | None = "created",
    buckets: int = BUCKETS, covered_until: str | None = None,
) -> list[int]:
    """Publish a version with the newest row per key of the table and ``fresh``; returns the buckets written anew.

    The first version fixes the number of buckets.  A bucket is written by one task, so there should be enough of them.
    """
    spark, keys = fresh.sparkSession, [key] if isinstance(key, str) else list(key)
    entries = directory(spark, root)
    buckets = entries[0].buckets if entries else buckets
    touched = _asked(fresh, keys, buckets)
    old = read_buckets(spark, entries, fresh.schema, touched)
    merged = latest_per_key(old.unionByName(fresh), keys, time=time, created=created)
    folder = f"{root}/data/write={uuid.uuid4().hex}"
    if touched:
        merged.withColumn("bucket", bucket_of(keys, buckets)).repartition(buckets, "bucket").write.partitionBy("bucket").parquet(folder)
    kept = [(e.bucket, e.folder, buckets, covered_until) for e in entries if e.bucket not in touched]
    written = [(b, f"{folder}/bucket={b}", buckets, covered_until) for b in touched]
    if kept or written:
        publish(spark.createDataFrame(kept + written, DIRECTORY).coalesce(1), f"{root}/directory")
    return sorted(touched)


def materialize_buckets(
    source: DataFrame, root: str, key: str | list[str], end: str, *, time: str = "event_timestamp",
    created: str | None = "created", buckets: int = BUCKETS,
) -> list[int]:
    """Bring the bucketed latest values up to the instant ``end``, from where the last version reached."""
    kind = source.schema[time].dataType
    entries = directory(source.sparkSession, root)
    start = F.lit(entries[0].covered_until).cast(kind) if entries else None
    fresh = fresh_rows(source, F.lit(end).cast(kind), start, time=time, created=created)
    step = latest_per_key(fresh, key, time=time, created=created)
    return merge_buckets(step, root, key, time=time, created=created, buckets=buckets, covered_until=end)


def asked_rows(requests: DataFrame, root: str, key: str | list[str], schema: StructType | None = None) -> DataFrame:
    """The table's rows in the buckets of the requested keys; the schema is that of its files unless given."""
    spark, keys = requests.sparkSession, [key] if isinstance(key, str) else list(key)
    entries = directory(spark, root)
    if schema is None:
        if not entries:
            raise ValueError(f"nothing was published below {root}")
        schema = spark.read.parquet(entries[0].folder).schema
    only = _asked(requests, keys, entries[0].buckets) if entries else set()
    return read_buckets(spark, entries, schema, only)


def lookup_buckets(requests: DataFrame, root: str, key: str | list[str], schema: StructType, features: list[str]) -> DataFrame:
    """Each request row with its key's latest values, from the buckets of the requested keys alone."""
    return lookup_latest(requests, asked_rows(requests, root, key, schema), key, features)
