"""Daily quality of the service as a stream, with late labels.

A micro-batch writes the confusion counts that its rows add to each day; reading sums them.  So
rows may come in any order, in any number of files and batches and as late as they like, without state, and a
replayed batch replaces its own counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cardwatch.operators.confusion import false_positive_rate, recall
from cardwatch.operators.monitoring import daily_cells
from cardwatch.streaming.runs import batch_folder, read_batches, running_query, with_trigger

DAY_SCHEMA = "day date, tp bigint, fp bigint, fn bigint, tn bigint"


def start_daily_quality(
    scored: DataFrame, time: str, label: str, prediction: str, out: str, checkpoint: str, *,
    every: str | None = None,
) -> StreamingQuery:
    """Count a stream of scored rows; ``time`` is a time without zone."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        cells = daily_cells(batch, time, label, prediction).select("day", "tp", "fp", "fn", "tn")
        cells.write.mode("overwrite").parquet(batch_folder(out, running_query(batch), batch_id))

    writer = scored.writeStream.foreachBatch(write_batch)
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()


def read_daily_quality(spark: SparkSession, out: str) -> DataFrame:
    """The counts of each day over all batches and its rates."""
    cells = ("tp", "fp", "fn", "tn")
    tp, fp, fn, tn = (F.col(c) for c in cells)
    return (
        read_batches(spark, out, DAY_SCHEMA)
        .groupBy("day")
        .agg(*[F.sum(c).alias(c) for c in cells])
        .select(
            "day",
            (tp + fp + fn + tn).alias("transactions"),
            false_positive_rate(fp, tn).alias("fpr"),
            recall(tp, fn).alias("recall"),
        )
    )
