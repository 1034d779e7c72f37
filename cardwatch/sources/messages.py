"""JSON messages: one object per text value, as a stream or as a batch."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardwatch.schema import CORRUPT

EARLIEST, LATEST = "earliest", "latest"


def read_message_stream(
    spark: SparkSession,
    source: str = "text",
    *,
    path: str | None = None,
    start: str = EARLIEST,
    checkpoint: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Columns ``value``, ``partition`` and ``offset`` of a Kafka topic or of text files in a folder.

    Kafka needs its connector on the class path and ``kafka.bootstrap.servers`` and
    ``subscribe`` in ``options``.  Files have no partition and offset; ``latest`` there means files
    changed after the first call for a ``checkpoint``: the instant is kept beside it, so a
    restart takes up what came while the job was down.
    """
    if start not in (EARLIEST, LATEST):
        raise ValueError(f"start is {EARLIEST} or {LATEST}, not {start}")
    reader = spark.readStream.format(source).options(**(options or {}))
    if source == "kafka":
        stream = reader.option("startingOffsets", start).load()
        return stream.select(F.col("value").cast("string").alias("value"), "partition", "offset")
    stream = reader.load(path)
    if start == LATEST:
        if checkpoint is None:
            raise ValueError(f"{LATEST} of files needs the query's checkpoint")
        now = F.timestamp_millis(F.lit(_first_start(spark, f"{checkpoint.rstrip('/')}-start")))
        stream = stream.filter(F.col("_metadata.file_modification_time") > now)
    return stream.select("value", F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"))


def _first_start(spark: SparkSession, path: str) -> int:
    """Milliseconds of the first start, written once and read ever after."""
    try:
        return int(spark.read.schema("value string").text(path).first().value)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    now = int(time.time() * 1000)
    spark.createDataFrame([(str(now),)], "value string").coalesce(1).write.text(path)
    return now


def decode(messages: DataFrame, schema: StructType) -> DataFrame:
    """Adds ``message`` and ``problem``, which is null for a well-formed object.

    Malformed text gives a struct of nulls rather than null, so the parser's own
    mark is read instead of testing for null.
    """
    marked = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = messages.withColumn("parsed", F.from_json("value", marked, options))
    problem = F.when(F.col("parsed").isNull(), "empty").when(
        F.col(f"parsed.{CORRUPT}").isNotNull(), "malformed"
    )
    message = F.struct(*[F.col(f"parsed.{f.name}") for f in schema.fields])
    return parsed.withColumn("message", message).withColumn("problem", problem).drop("parsed")


def as_messages(df: DataFrame, label: str = "fraud") -> DataFrame:
    """One JSON text per row, without the label, nulls kept as nulls."""
    body = df.drop(label)
    return body.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def unique_messages(stream: DataFrame, key: str, time: str, within: str = "1 hour") -> DataFrame:
    """Each ``key`` of a stream once, however often its sender repeated it ``within`` that time.

    For receivers of topics that get their messages at least once.  State holds the keys of that time only;
    a repeat that comes later is taken for a new message.  Rows without a key are never repeats of each other.
    """
    marked = stream.withWatermark(time, within)
    named = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("none:"), F.uuid()))
    return marked.withColumn("__key", named).dropDuplicatesWithinWatermark(["__key"]).drop("__key")
