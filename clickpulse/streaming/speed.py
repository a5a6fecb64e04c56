"""Streaming speed layer.

Input: a streaming frame of Kafka-shaped records (``value`` holds click
JSON). Modes (see ``LayerConfig.speed_mode``):

* ``partials`` — one query; ``foreachBatch`` lands raw clicks and writes the
  batch's window counts to ``run=<query id>/batch_id=<n>``. No row is dropped; a window cut
  across micro-batches is stored once per batch and summed by readers. With
  ``batch_offsets`` a trigger's records are stored as several micro-batches.
* ``final`` — watermark + window on the streaming frame, append mode to a
  Parquet file sink: each window once, after the watermark passes its end;
  rows behind the watermark are dropped (and counted in the progress
  metrics). Raw landing, if configured, runs as a second query, which with
  ``partials_path`` also keeps the counts per micro-batch, so that
  ``plans.corrections`` can add what was dropped.
* ``update`` — the same aggregation in update mode: every micro-batch stores
  the windows it changed, the newest batch of a window counts
  (``streaming.updates``).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickpulse.config import LayerConfig
from clickpulse.functions.decode import parse_clicks
from clickpulse.operators.windows import window_counts
from clickpulse.plans.speed import land_raw, speed_batch_writer
from clickpulse.session import stable_dir
from clickpulse.sources.sinks import RECORD_KEY
from clickpulse.streaming.updates import start_update_view
from clickpulse.streaming.triggers import RunTag, require_checkpoint, with_trigger


def start_speed_layer(records: DataFrame, cfg: LayerConfig, checkpoint: str | None = None,
                      available_now: bool = False, query_name: str | None = None) -> list[StreamingQuery]:
    checkpoint = (checkpoint or cfg.streaming_checkpoint
                  or stable_dir(records.sparkSession, f"checkpoints/speed-{cfg.topic}")).rstrip("/")
    require_checkpoint(checkpoint)
    keep = RECORD_KEY if cfg.raw_identity else ("offset",) if cfg.batch_offsets else ()
    clicks = parse_clicks(records, cfg.time_pattern, keep=keep)
    if cfg.speed_mode == "partials":
        tag = RunTag()
        w = (clicks.writeStream.foreachBatch(speed_batch_writer(cfg, tag=tag))
             .option("checkpointLocation", f"{checkpoint}/speed"))
        if query_name:
            w = w.queryName(query_name)
        return [tag.bind(with_trigger(w, cfg.trigger_seconds, available_now).start())]

    queries = []
    counts = window_counts(clicks, cfg.window_seconds, cfg.watermark_seconds)
    if cfg.speed_mode == "update":
        queries.append(start_update_view(counts, cfg.speed_path, f"{checkpoint}/speed", cfg.trigger_seconds, available_now))
        return queries + _start_raw(clicks, cfg, checkpoint, available_now)
    if cfg.max_speed_files:
        # after the state store: the stateful work keeps all its partitions,
        # only the closed windows are shuffled into at most this many files
        counts = counts.repartition(cfg.max_speed_files)
    w = (counts.writeStream.format("parquet").outputMode("append")
         .option("path", cfg.speed_path)
         .option("checkpointLocation", f"{checkpoint}/speed"))
    if query_name:
        w = w.queryName(query_name)
    queries.append(with_trigger(w, cfg.trigger_seconds, available_now).start())
    return queries + _start_raw(clicks, cfg, checkpoint, available_now)


def _start_raw(clicks: DataFrame, cfg: LayerConfig, checkpoint: str, available_now: bool) -> list[StreamingQuery]:
    """Raw landing as a query of its own, and the counts per micro-batch where
    ``partials_path`` asks for them."""
    if not (cfg.raw_path or cfg.raw_options or cfg.partials_path):
        return []
    tag = RunTag()
    if cfg.partials_path:
        write = speed_batch_writer(replace(cfg, speed_path=cfg.partials_path), tag=tag)
    else:
        write = lambda b, i: land_raw(b, i, cfg, tag.get())
    w = clicks.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/raw")
    return [tag.bind(with_trigger(w, cfg.trigger_seconds, available_now).start())]


def start_console(df: DataFrame, output_mode: str = "update", trigger_seconds: int | None = None,
                  available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Print each micro-batch's rows, untruncated (debugging sink)."""
    w = df.writeStream.format("console").option("truncate", "false").outputMode(output_mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return with_trigger(w, trigger_seconds, available_now).start()


def start_parquet_sink(df: DataFrame, path: str, checkpoint: str, trigger_seconds: int | None = None,
                       available_now: bool = False) -> StreamingQuery:
    """Append a streaming frame to a Parquet file sink (exactly-once via its log)."""
    w = (df.writeStream.format("parquet").outputMode("append").option("path", path)
         .option("checkpointLocation", require_checkpoint(checkpoint)))
    return with_trigger(w, trigger_seconds, available_now).start()
