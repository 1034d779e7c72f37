"""What running queries have sent, from the figures that their own micro-batches report."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from cardwatch.streaming.scoring import SENT

SENT_SCHEMA = "query_id string, batches bigint, last_batch bigint, messages bigint, bytes bigint"


@dataclass
class Total:
    batches: int = 0
    last_batch: int = -1
    messages: int = 0
    bytes: int = 0


class SentLog(StreamingQueryListener):
    """Totals per query of what it sent while this session listened; nothing is read back from where it went.

    A batch that is replayed after a failure reports again and counts once.  The log holds one total per query, so it does not grow
    with the stream.  Events come a moment after the batch; :meth:`settled` waits for the end of a query.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.totals, self.ended = spark, {}, {}
        self.lock = threading.Lock()
        spark.streams.addListener(self)

    def stop(self) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.id)).clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        sent = progress.observedMetrics.get(SENT)
        if sent is not None:
            self.add(str(progress.id), progress.batchId, sent["messages"] or 0, sent["bytes"] or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.id)).set()

    def _end_of(self, query_id: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(query_id, threading.Event())

    def add(self, query_id: str, batch_id: int, messages: int, size: int) -> None:
        with self.lock:
            total = self.totals.setdefault(query_id, Total())
            if batch_id > total.last_batch:
                total.batches += 1
                total.last_batch = batch_id
                total.messages += messages
                total.bytes += size

    def settled(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all figures of an ended query are in."""
        return self._end_of(str(query.id)).wait(seconds)

    def table(self) -> DataFrame:
        with self.lock:
            rows = [(q, t.batches, t.last_batch, t.messages, t.bytes) for q, t in self.totals.items()]
        return self.spark.createDataFrame(rows, SENT_SCHEMA)
