"""Trigger and checkpoint helpers shared by the streaming jobs."""

from __future__ import annotations

import threading

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def with_trigger(writer: DataStreamWriter, trigger_seconds: int | None = None,
                 available_now: bool = False) -> DataStreamWriter:
    """Processing-time trigger every ``trigger_seconds``; ``available_now``
    drains what is there and stops (tests, backfills)."""
    if available_now:
        return writer.trigger(availableNow=True)
    if trigger_seconds:
        return writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer


def require_checkpoint(checkpoint: str | None) -> str:
    """Every query keeps offsets and state in a durable checkpoint, so a
    restart resumes where it stopped and a retried batch keeps its id."""
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    return checkpoint


class RunTag:
    """The id of the streaming query a ``foreachBatch`` callback serves.

    Per-batch output goes to ``run=<query id>/batch_id=<n>``. The id is kept
    in the checkpoint, so a restart from it (and a retried batch) writes the
    same folders again, while a query started on a new checkpoint counts its
    batches from 0 in folders of its own instead of overwriting older ones.
    The id is known once ``start()`` returns; a first batch that runs
    earlier waits for it.
    """

    def __init__(self) -> None:
        self._ready = threading.Event()
        self._value: str | None = None

    def bind(self, query: StreamingQuery) -> StreamingQuery:
        self._value = str(query.id)
        self._ready.set()
        return query

    def get(self, timeout: float | None = None) -> str:
        if not self._ready.wait(timeout):
            raise RuntimeError("streaming query id not bound")
        return self._value
