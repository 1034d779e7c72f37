"""Days that close: final figures per day, and what came too late for them.

A day is kept as keyed state until the watermark passes its end; then its counts are emitted once and are final, so
that alerts can rest on them.  A row whose day is over by the watermark of its micro-batch goes to a table of late
counts instead, as do rows without a time.  So closed, late and still open counts add up to all rows.
:mod:`cardwatch.streaming.quality` gives the exact figures of any day at any moment, late rows included.

Tasks sum their rows by day before the shuffle: the state is sent sums and not rows, so one busy day does not fill one
task.  Times are without zone and are read as UTC for the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cardwatch.operators.confusion import false_positive_rate, recall
from cardwatch.operators.monitoring import cell_alerts
from cardwatch.streaming.runs import batch_folder, keyed_state, read_batches, running_query, with_trigger

CLOSED, LATE = "closed", "late"
COUNTS = ("tp", "fp", "fn", "tn")
CELLS = "tp bigint, fp bigint, fn bigint, tn bigint, missed_loss double"
SUMMED = f"day_end bigint, {CELLS}"
HELD_ROWS = 1 << 16
EMITTED = f"kind string, day_end bigint, {CELLS}"
DAY_SCHEMA = f"kind string, day date, {CELLS}"
SECONDS = 86_400


def _by_day(tables: list[pa.Table]) -> pa.Table:
    names = [*COUNTS, "missed_loss"]
    sums = pa.concat_tables(tables).group_by("day_end").aggregate([(name, "sum") for name in names])
    return sums.select(["day_end", *(f"{name}_sum" for name in names)]).rename_columns(["day_end", *names])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows by day; at most ``HELD_ROWS`` sums and a batch are held."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(_by_day([pa.Table.from_batches([batch])]))
        if sum(map(len, held)) > HELD_ROWS:
            yield from _by_day(held).to_batches()
            held = []
    if held:
        yield from _by_day(held).to_batches()


class DayState(StatefulProcessor):
    """The counts of a day, until the watermark reaches its end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cells = handle.getValueState("cells", CELLS)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names, added = [*COUNTS, "missed_loss"], None
        for part in rows:
            here = part[names].sum()
            added = here if added is None else added + here
        day_end = key[0]
        if day_end is None or pd.isna(day_end) or day_end * 1000 <= timerValues.getCurrentWatermarkInMs():
            yield self._row(LATE, day_end, added)
            return
        if self.cells.exists():
            added = added + pd.Series(self.cells.get(), names)
        self.cells.update((*(int(added[c]) for c in COUNTS), float(added["missed_loss"])))
        self.handle.registerTimer(int(day_end) * 1000)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.cells.exists():
            yield self._row(CLOSED, key[0], pd.Series(self.cells.get(), [*COUNTS, "missed_loss"]))
            self.cells.clear()

    def close(self) -> None:
        pass

    @staticmethod
    def _row(kind: str, day_end: int | None, cells: pd.Series) -> pd.DataFrame:
        known = None if day_end is None or pd.isna(day_end) else int(day_end)
        return pd.DataFrame({"kind": [kind], "day_end": pd.array([known], "Int64"), **{c: [int(cells[c])] for c in COUNTS},
                             "missed_loss": [float(cells["missed_loss"])]})


def _counted(scored: DataFrame, time: str, label: str, prediction: str, amount: str | None, lateness: str) -> DataFrame:
    """Counts of the scored rows by their day's end, summed task by task, under a watermark on ``time``."""
    actual, called = F.col(label) == 1, F.col(prediction) == 1
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(`{time}` AS TIMESTAMP_NTZ))")
    missed = F.when(actual & ~F.coalesce(called, F.lit(False)), F.col(amount)) if amount else F.lit(None)
    cells = {"tp": actual & called, "fp": ~actual & called, "fn": actual & ~called, "tn": ~actual & ~called}
    rows = scored.select(
        F.timestamp_micros(micros).alias("at"),
        ((F.floor(micros / (SECONDS * 1_000_000)) + 1) * SECONDS).cast("bigint").alias("day_end"),
        *[F.coalesce(cell, F.lit(False)).cast("bigint").alias(name) for name, cell in cells.items()],
        F.coalesce(F.nanvl(missed.cast("double"), F.lit(0.0)), F.lit(0.0)).alias("missed_loss"),
    )
    # The state must see late rows to count them, so the time itself is not handed on.
    return rows.withWatermark("at", lateness).drop("at").mapInArrow(_summed, SUMMED)


def start_closed_days(
    scored: DataFrame, time: str, label: str, prediction: str, out: str, checkpoint: str, *,
    amount: str | None = None, lateness: str = "2 days", every: str | None = None,
) -> StreamingQuery:
    """Close the days of a stream of scored rows once the newest time is ``lateness`` past their end."""
    rows = _counted(scored, time, label, prediction, amount, lateness)
    emitted = rows.groupBy("day_end").transformWithStateInPandas(DayState(), EMITTED, "append", "eventTime")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        day = F.expr(f"date_add(DATE'1970-01-01', CAST(day_end div {SECONDS} - 1 AS INT))")
        sums = [F.sum(c).alias(c) for c in (*COUNTS, "missed_loss")]
        days = batch.groupBy("kind", day.alias("day")).agg(*sums)
        days.write.mode("overwrite").partitionBy("kind").parquet(batch_folder(out, running_query(batch), batch_id))

    writer = emitted.writeStream.outputMode("append").foreachBatch(write_batch)
    with keyed_state(scored.sparkSession):
        return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()


def closed_cells(spark: SparkSession, out: str) -> DataFrame:
    """day, counts and missed loss of the days that have closed; each is written by one batch."""
    rows = read_batches(spark, out, DAY_SCHEMA).filter(F.col("kind") == CLOSED)
    return rows.select("day", *COUNTS, "missed_loss")


def closed_days(spark: SparkSession, out: str) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    return closed_cells(spark, out).select(
        "day", (tp + fp + fn + tn).alias("transactions"), false_positive_rate(fp, tn).alias("fpr"),
        recall(tp, fn).alias("recall"), "missed_loss",
    )


def late_days(spark: SparkSession, out: str) -> DataFrame:
    """day and transactions of rows that came after their day had closed; day is null for rows without a time."""
    rows = read_batches(spark, out, DAY_SCHEMA).filter(F.col("kind") == LATE)
    return rows.groupBy("day").agg(F.sum(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("transactions"))


def closed_day_alerts(spark: SparkSession, out: str) -> DataFrame:
    """Every broken limit of the closed days; the monthly loss is that of the month's closed days."""
    return cell_alerts(closed_cells(spark, out))
