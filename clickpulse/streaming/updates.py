"""Results of update mode, stored per micro-batch and read as a keyed view.

In update mode a query emits each group that a micro-batch changed with its
whole result so far. Every micro-batch goes to its own ``run=<query id>/
batch_id=<n>`` folder; a reader takes each group's row from the newest batch
that has one. A retried batch writes its folder again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse.sources.sinks import write_batch_folder
from clickpulse.streaming.triggers import RunTag, require_checkpoint, with_trigger


def start_update_view(df: DataFrame, path: str, checkpoint: str, trigger_seconds: int | None = None,
                      available_now: bool = False) -> StreamingQuery:
    tag = RunTag()

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_folder(batch, path, batch_id, run=tag.get())

    w = (df.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", require_checkpoint(checkpoint)))
    return tag.bind(with_trigger(w, trigger_seconds, available_now).start())


def read_update_view(spark: SparkSession, path: str, keys: tuple[str, ...], value: str = "count") -> DataFrame:
    """``keys`` and ``value``: per run the newest batch of a group counts; a
    run (a checkpoint) counts its own records, so runs are summed."""
    rows = spark.read.option("basePath", path).parquet(path)
    newest = rows.groupBy("run", *keys).agg(F.max_by(value, "batch_id").alias(value))
    return newest.groupBy(*keys).agg(F.sum(value).cast("long").alias(value))
