"""Starting, bounding and reading back streaming queries."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType


def with_trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Take what is there and stop, or run a micro-batch at each interval."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Start a query with the state store that keyed state needs; queries keep the setting they are started with."""
    before = spark.conf.get(STATE_PROVIDER)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_PROVIDER, before)


def finish(query: StreamingQuery, timeout_seconds: int | None = None) -> bool:
    """Wait for the query, at most for the time limit; True when it ended by itself."""
    try:
        ended = query.awaitTermination(timeout_seconds)
    finally:
        query.stop()
    return True if ended is None else ended


def running_query(batch: DataFrame) -> str:
    """The id of the streaming query that runs this micro-batch; its checkpoint keeps it over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def batch_folder(root: str, query_id: str, batch_id: int) -> str:
    """A replayed batch meets its own folder again; a query with a new checkpoint never does."""
    return f"{root}/query_id={query_id}/batch_id={batch_id}"


def read_batches(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """Everything the batches wrote, plus ``query_id`` and ``batch_id``; empty when nothing ran yet."""
    fields = spark.createDataFrame([], schema).schema.fields
    full = StructType([*fields, StructField("query_id", StringType()), StructField("batch_id", LongType())])
    try:
        return spark.read.schema(full).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def append_stream(rows: DataFrame, path: str, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    """Append a stream to a table, each row once whatever fails in between."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()
