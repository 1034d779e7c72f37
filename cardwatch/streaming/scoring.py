"""Score JSON messages as they come; keep what cannot be scored, with the reason."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cardwatch.operators.modeling import decode_prediction, fraud_probability
from cardwatch.sinks.observed import written_counts
from cardwatch.sinks.tables import DELIVERY
from cardwatch.sources.messages import decode
from cardwatch.streaming.runs import batch_folder, read_batches, running_query, with_trigger

SCORED, REJECTED = "scored", "rejected"
SENT = "sent"
LABELS = ("fraud", "label")  # fixed values: never echoed in a prediction
OUTPUT_SCHEMA = "value string, reason string, status string"
PROGRESS_SCHEMA = "processed bigint, errors bigint, started_at timestamp, ended_at timestamp"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def message_id(given: Column, partition: Column, offset: Column, text: Column) -> Column:
    """The message's own id, else one from its partition and offset, else from its text.

    Offsets count within a partition; a source without partitions has the offset alone.
    """
    place = F.concat_ws("_", partition.cast("string"), offset.cast("string"))
    fallback = F.when(offset.isNotNull(), place).otherwise(F.sha2(text, 256))
    return F.coalesce(given.cast("string"), F.concat(F.lit("unknown_"), fallback))


def envelope(inputs: StructType, alias: str) -> Column:
    """The prediction message around columns ``message``, ``prediction``, ``probability``."""
    names = inputs.fieldNames()

    def given(name: str) -> Column:
        return F.col(f"message.{name}") if name in names else F.lit(None).cast("string")

    kept = [F.col(f"message.{n}") for n in names if n not in LABELS]
    return F.struct(
        message_id(given("transaction_id"), F.col("partition"), F.col("offset"), F.col("value")).alias("transaction_id"),
        given("timestamp").alias("original_timestamp"),
        F.date_format(F.current_timestamp(), ISO).alias("processed_at"),
        decode_prediction(F.col("prediction")).alias("prediction"),
        F.col("fraud_probability").alias("probability"),
        F.lit(alias).alias("model_alias"),
        F.struct(*kept).alias("input_features"),
    )


def score_messages(
    messages: DataFrame, model: PipelineModel, schema: StructType, alias: str = "champion"
) -> DataFrame:
    """Every message once: a prediction in ``value``, or its own text and the ``reason``.

    One pass: the assembler lets incomplete rows through as NaN, and their result is
    thrown away, rather than scanning the batch once for each outcome.
    """
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    wanted = assembler.getInputCols()
    # The message travels in one struct, so its columns cannot meet a feature's name.
    if "partition" not in messages.columns:
        messages = messages.withColumn("partition", F.lit(None).cast("int"))
    decoded = decode(messages, schema).select(
        F.struct("value", "partition", "offset", "message", "problem").alias("__in"),
        *[F.col(f"message.{c}").alias(c) for c in wanted],
    )
    predicted = model.transform(decoded, {assembler.handleInvalid: "keep"}).select(
        "__in.*",
        "prediction",
        fraud_probability(F.col("probability")).alias("fraud_probability"),
    )
    incomplete = reduce(or_, [F.col(f"message.{c}").isNull() for c in wanted])
    reason = F.coalesce("problem", F.when(incomplete, "missing_feature"))
    body = F.to_json(envelope(schema, alias), {"ignoreNullFields": "false"})
    good = F.col("reason").isNull()
    return predicted.withColumn("reason", reason).select(
        F.when(good, body).otherwise(F.col("value")).alias("value"),
        "reason",
        F.when(good, SCORED).otherwise(REJECTED).alias("status"),
    )


def start_scoring(
    messages: DataFrame,
    model_for_batch: Callable[[], PipelineModel],
    schema: StructType,
    out: str,
    checkpoint: str,
    *,
    alias: str = "champion",
    every: str | None = None,
    sink: str | None = None,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Write predictions and dead letters below ``out``, and a progress row per batch, counted by that write.

    With ``sink`` the predictions also go to a topic (``kafka``) or to files below ``path``.
    A replayed batch replaces its files; a topic gets its messages at least once.

    ``model_for_batch`` is asked once per micro-batch, so a promoted model takes over
    without a restart.  See :func:`reloading`.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        started = time.time()
        query_id = running_query(batch)
        folder = batch_folder(f"{out}/messages", query_id, batch_id)
        counts = written_counts(
            score_messages(batch, model_for_batch(), schema, alias),
            F.count_if(F.col("status") == SCORED).alias("processed"),
            F.count_if(F.col("status") == REJECTED).alias("errors"),
            write=lambda rows: rows.write.mode("overwrite").partitionBy("status").parquet(folder),
        )
        if sink is not None:
            written = spark.read.schema(OUTPUT_SCHEMA).parquet(folder)
            place = None if path is None else batch_folder(path, query_id, batch_id)
            send_messages(written.filter(F.col("status") == SCORED), sink, place, options)
        spark.range(1).select(
            F.lit(counts.get("processed", 0)).cast("bigint").alias("processed"),
            F.lit(counts.get("errors", 0)).cast("bigint").alias("errors"),
            F.timestamp_millis(F.lit(int(started * 1000))).alias("started_at"),
            F.current_timestamp().alias("ended_at"),
        ).coalesce(1).write.mode("overwrite").parquet(batch_folder(f"{out}/progress", query_id, batch_id))

    writer = messages.writeStream.foreachBatch(write_batch)
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()


def send_messages(
    rows: DataFrame, sink: str, path: str | None = None, options: dict[str, str] | None = None
) -> None:
    """Write ``value`` to a topic, or to files in place of those at ``path``."""
    settings = {**DELIVERY, **(options or {})} if sink == "kafka" else dict(options or {})
    writer = rows.select("value").write.format(sink).options(**settings)
    if path is None:
        writer.save()
    else:
        writer.mode("overwrite").save(path)


def reloading(
    locate: Callable[[], tuple[int, str]], load: Callable[[str], PipelineModel]
) -> Callable[[], PipelineModel]:
    """A supplier that loads a model again only when ``locate`` names another version."""
    held: dict[str, object] = {}

    def current() -> PipelineModel:
        version, path = locate()
        if held.get("version") != version:
            held.update(version=version, model=load(path))
        return held["model"]

    return current


def read_outputs(spark: SparkSession, out: str) -> DataFrame:
    return read_batches(spark, f"{out}/messages", OUTPUT_SCHEMA)


def read_progress(spark: SparkSession, out: str) -> DataFrame:
    """Processed, errors and messages per second over all batches so far."""
    rows = read_batches(spark, f"{out}/progress", PROGRESS_SCHEMA)
    seconds = F.sum(
        F.col("ended_at").cast("double") - F.col("started_at").cast("double")
    )
    return rows.agg(
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
        (F.sum(F.col("processed") + F.col("errors")) / F.nullif(seconds, F.lit(0.0))).alias(
            "messages_per_second"
        ),
    )


def sink_messages(
    stream: DataFrame,
    checkpoint: str,
    *,
    sink: str = "text",
    path: str | None = None,
    options: dict[str, str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Stream ``value`` to a topic, or to text files, exactly once for files.

    How much was sent can be followed by :class:`cardwatch.streaming.progress.SentLog`.
    """
    sent = stream.select("value").observe(SENT, F.count(F.lit(1)).alias("messages"), F.sum(F.octet_length("value")).alias("bytes"))
    writer = sent.writeStream.format(sink).outputMode("append")
    settings = {**DELIVERY, **(options or {})} if sink == "kafka" else dict(options or {})
    writer = writer.options(**settings).option("checkpointLocation", checkpoint)
    if path is not None:
        writer = writer.option("path", path)
    return with_trigger(writer, every).start()
