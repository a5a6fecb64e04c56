"""Click jobs of the stream-processor side: page visits and page statistics.

Both decode strictly (a malformed record fails the query) and take the
event's own time as event time with a 200 ms out-of-orderness bound. The
statistics can instead be windowed on processing time (the original job's
time characteristic without its event-time flag): each record then takes the
time of the micro-batch that reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse.config import CLICK_TIME_PATTERN, CLICK_TIME_PATTERN_12H, OUT_OF_ORDERNESS_MS, PAGE_STATS_WINDOW_SECONDS
from clickpulse.functions.decode import parse_clicks_strict
from clickpulse.functions.encode import page_stats_json
from clickpulse.operators.visits import page_visits
from clickpulse.operators.windows import page_stats
from clickpulse.plans.speed import FILE_FORMATS
from clickpulse.sources.kafka import kafka_writer
from clickpulse.sources.sinks import append_rows, write_batch_folder
from clickpulse.streaming.triggers import RunTag, require_checkpoint, with_trigger
from clickpulse.streaming.updates import start_update_view


def visit_stream(records: DataFrame, pattern: str = CLICK_TIME_PATTERN) -> DataFrame:
    clicks = parse_clicks_strict(records, pattern)
    return page_visits(clicks.withWatermark("timestamp", f"{OUT_OF_ORDERNESS_MS} milliseconds"))


def start_page_visits(records: DataFrame, checkpoint: str, fmt: str = "parquet", path: str | None = None,
                      options: dict | None = None, pattern: str = CLICK_TIME_PATTERN,
                      trigger_seconds: int | None = None, available_now: bool = False) -> StreamingQuery:
    """(timestamp, page) rows to the visits table; nulls are written as nulls.

    File tables get one folder per batch id (retry-safe); connector tables
    (e.g. keyspace ``example``, table ``clickevent``) get appends.
    """
    visits = visit_stream(records, pattern)
    tag = RunTag()

    def write(batch: DataFrame, batch_id: int) -> None:
        if path and fmt in FILE_FORMATS:
            write_batch_folder(batch, path, batch_id, fmt=fmt, run=tag.get())
        else:
            append_rows(batch, fmt, path, options)

    w = visits.writeStream.foreachBatch(write).option("checkpointLocation", require_checkpoint(checkpoint))
    return tag.bind(with_trigger(w, trigger_seconds, available_now).start())


def with_processing_time(clicks: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Replace the event time by the time of the micro-batch (processing time)."""
    return clicks.withColumn(time_col, F.current_timestamp())


def start_page_stats_view(records: DataFrame, path: str, checkpoint: str, pattern: str = CLICK_TIME_PATTERN,
                          window_seconds: int = PAGE_STATS_WINDOW_SECONDS, processing_time: bool = False,
                          trigger_seconds: int | None = None, available_now: bool = False) -> StreamingQuery:
    """Statistics of open windows too, as a keyed view (``streaming.updates``).

    With ``processing_time`` a record takes the time that its micro-batch
    recorded in the checkpoint; a retried batch takes the same time again.
    """
    clicks = parse_clicks_strict(records, pattern)
    if processing_time:
        clicks = with_processing_time(clicks)
    stats = page_stats(clicks, window_seconds, watermark_ms=OUT_OF_ORDERNESS_MS)
    return start_update_view(stats, path, checkpoint, trigger_seconds, available_now)


def stats_stream(records: DataFrame, pattern: str = CLICK_TIME_PATTERN,
                 window_seconds: int = PAGE_STATS_WINDOW_SECONDS, json_pattern: str = CLICK_TIME_PATTERN_12H,
                 processing_time: bool = False) -> DataFrame:
    """Closed 15 s page windows as JSON records (``value``), keyed by page.

    ``processing_time`` windows on the micro-batch time instead of the
    event's own time.
    """
    clicks = parse_clicks_strict(records, pattern)
    if processing_time:
        clicks = with_processing_time(clicks)
    stats = page_stats(clicks, window_seconds, watermark_ms=OUT_OF_ORDERNESS_MS)
    return stats.select(
        F.col("page").cast("binary").alias("key"),
        page_stats_json("windowStart", "windowEnd", "page", "count", json_pattern).cast("binary").alias("value"),
    )


def start_page_stats(records: DataFrame, checkpoint: str, bootstrap_servers: str | None = None,
                     topic: str | None = None, path: str | None = None, trigger_seconds: int | None = None,
                     available_now: bool = False, **kw) -> StreamingQuery:
    """Statistics to a Kafka topic, or to Parquet files when ``path`` is given."""
    stats = stats_stream(records, **kw)
    if path:
        w = stats.writeStream.format("parquet").option("path", path)
    else:
        w = kafka_writer(stats, bootstrap_servers, topic)
    w = w.outputMode("append").option("checkpointLocation", require_checkpoint(checkpoint))
    return with_trigger(w, trigger_seconds, available_now).start()
