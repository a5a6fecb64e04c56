"""Rates of running queries, from Spark's progress events."""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass(frozen=True)
class BatchRate:
    query: str
    batch_id: int
    rows: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0


class RateLog(StreamingQueryListener):
    """Rows and duration of the last ``keep`` micro-batches that had rows, and
    the sum of all rows, of every query while the log is attached."""

    def __init__(self, keep: int = 1000) -> None:
        self._keep, self._lock = keep, threading.Lock()
        self.batches: list[BatchRate] = []
        self.rows: dict[str, int] = {}

    def attach(self, spark: SparkSession) -> RateLog:
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> int:
        """Rows of ``query``, once the events of its known progress are in
        (they come some time after the micro-batch)."""
        known = sum(p.numInputRows for p in query.recentProgress)
        end = time.monotonic() + seconds
        while self.rows.get(str(query.id), 0) < known and time.monotonic() < end:
            time.sleep(0.05)
        return self.rows.get(str(query.id), 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            rate = BatchRate(str(p.id), p.batchId, p.numInputRows, p.durationMs.get("triggerExecution", 0) / 1000)
            with self._lock:
                self.batches = [*self.batches, rate][-self._keep:]
                self.rows[rate.query] = self.rows.get(rate.query, 0) + rate.rows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
