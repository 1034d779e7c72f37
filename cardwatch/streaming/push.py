"""Push fresh feature rows to the history and to the latest values.

A batch adds its rows to the history and its newest row per key to a folder of
changes; the cost follows the batch, not the table.  Reading the latest values takes
the newest per key over the base table and the changes, so an older row that arrives
late changes nothing.  :func:`compact` folds the changes into a new base.

:func:`start_latest` keeps the newest row per key as state instead and writes a change only when a key's newest row is another
one than before, so the changes grow with what is new and not with what is sent.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from cardwatch.operators.latest import latest_per_key
from cardwatch.sinks.tables import publish, read_current
from cardwatch.streaming.runs import batch_folder, keyed_state, read_batches, running_query, with_trigger


def push_batch(rows: DataFrame, batch_id: int, root: str, key: str, query_id: str = "none") -> None:
    folder = batch_folder(f"{root}/history", query_id, batch_id)
    rows.write.mode("overwrite").parquet(folder)
    written = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    latest_per_key(written, key).write.mode("overwrite").parquet(
        batch_folder(f"{root}/changes", query_id, batch_id)
    )


def start_push(
    rows: DataFrame, root: str, key: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(
        lambda batch, batch_id: push_batch(batch, batch_id, root, key, running_query(batch))
    )
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()


class NewestRow(StatefulProcessor):
    """The newest row of a key; a row is given out when it becomes the newest.

    ``order`` names the columns that rank rows, the most important first; null is lowest.  A state that has not changed
    for ``ttl`` is forgotten.
    """

    def __init__(self, schema: StructType, order: list[str], ttl: timedelta):
        self.schema, self.order = schema, order
        self.ttl_ms = int(ttl.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", self.schema, self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.schema.fieldNames()
        held = tuple(self.newest.get()) if self.newest.exists() else None
        best = held
        for part in rows:
            for column in self.order:  # narrow down to the top before any row becomes Python values
                top = part[column].max()
                part = part[part[column] == top] if not pd.isna(top) else part
            row = tuple(_plain(part[name].iloc[0]) for name in names)
            best = row if best is None or self._rank(row) > self._rank(best) else best
        if best != held:
            self.newest.update(best)
            yield pd.DataFrame([best], columns=names, dtype=object)

    def _rank(self, row: tuple) -> tuple:
        at = self.schema.fieldNames().index
        return tuple((row[at(c)] is not None, row[at(c)]) if row[at(c)] is not None else (False,) for c in self.order)

    def close(self) -> None:
        pass


def _plain(value):
    """A Python value of a cell."""
    if value is None or (not isinstance(value, str) and pd.isna(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def newest_in_state(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The keys' newest rows, kept as the state of an aggregation and given out by the micro-batch that brought them.

    Rows are combined before the shuffle.  ``seen`` is the negative time of the micro-batch: of equal rows the one seen first
    stays, so a repeated row is no change.
    """
    seen = -F.unix_micros(F.current_timestamp())
    tagged = rows.select(F.col(key).alias("key"), F.struct(*order).alias("row"), seen.alias("seen"))
    kept = tagged.groupBy("key").agg(F.max(F.struct("row", "seen")).alias("newest")).filter(F.col("newest.seen") == seen)
    return kept.select(F.col("key").alias(key), "newest.row.*").select(rows.columns)


def start_latest(
    rows: DataFrame, root: str, key: str, checkpoint: str, *, time: str = "event_timestamp", created: str | None = "created",
    ttl: timedelta | None = None, every: str | None = None,
) -> StreamingQuery:
    """Write to the changes below ``root`` what becomes the newest row of a key, kept as state over restarts.

    Newest by ``time``, ``created`` and the other columns, as :func:`latest_per_key` has it.  With ``ttl`` a key that has been
    quiet for so long gives up its state; its next row is written as a change, and readers still take the newest.
    State with a time to live is looked after as long as the query runs, so without ``every`` one micro-batch is run.
    """
    first = [time] if created is None else [time, created]
    order = [*first, *[c for c in rows.columns if c not in (key, *first)]]
    if ttl is None:
        newest = newest_in_state(rows, key, order)
    else:
        newest = rows.groupBy(key).transformWithStateInPandas(NewestRow(rows.schema, order, ttl), rows.schema, "update", "processingTime")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(f"{root}/changes", running_query(batch), batch_id))

    writer = newest.writeStream.outputMode("update").foreachBatch(write_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(once=True) if ttl is not None and every is None else with_trigger(writer, every)
    with keyed_state(rows.sparkSession):
        return writer.start()


def read_history(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    return read_batches(spark, f"{root}/history", schema).select(schema.fieldNames())


def read_latest(spark: SparkSession, root: str, key: str, schema: StructType) -> DataFrame:
    """Newest row per key over the base and the changes made since."""
    names = schema.fieldNames()
    changes = read_batches(spark, f"{root}/changes", schema)
    base = read_current(spark, f"{root}/base")
    if base is None:
        return latest_per_key(changes.select(names), key)
    covered = base.select("covers").limit(1).first()
    for query_id, batch_id in (covered.covers or {}).items() if covered else ():
        changes = changes.filter((F.col("query_id") != query_id) | (F.col("batch_id") > batch_id))
    return latest_per_key(base.select(names).unionByName(changes.select(names)), key)


def compact(spark: SparkSession, root: str, key: str, schema: StructType) -> int:
    """Publish the latest values as the new base; later reads skip folded changes."""
    changes = read_batches(spark, f"{root}/changes", schema)
    last = {r.query_id: r.last for r in changes.groupBy("query_id").agg(F.max("batch_id").alias("last")).collect()}
    latest = read_latest(spark, root, key, schema)
    pairs = [F.lit(x) for pair in last.items() for x in pair]
    covers = (F.create_map(*pairs) if pairs else F.lit(None)).cast("map<string,bigint>")
    return publish(latest.withColumn("covers", covers), f"{root}/base")
