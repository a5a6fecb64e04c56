"""Compaction of a speed view in the partials layout.

A speed layer leaves a folder and a marker per trigger. ``compact_speed``
copies the rows of finished batches, with their run and batch id, into one
segment below ``<speed>/_compacted``; a segment counts once its ``_SUCCESS``
file is there, and names how far it goes per run. Readers take a batch either
from its segment or from its folder, never both, and as rows keep their batch
id, incremental reports pick the same batches as before. Folders and markers
go one compaction later, so a reader that listed them still finds them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators.windows import window_zone
from clickpulse.plans.batch import committed_batches
from clickpulse.plans.speed import DONE_DIR
from clickpulse.schemas import SPEED_SCHEMA
from clickpulse.sources.sinks import batch_folder
from clickpulse.sources.storage import remove_folder, values
from clickpulse.sources.tables import COMPACT_DIR, SEGMENT_SCHEMA, compacted_through

KEEP_BATCHES = 720  # an hour of triggers of 5 s stays as written


def _remove_compacted(spark: SparkSession, speed_path: str, through: dict[str, int]) -> None:
    """Delete folders and markers of batches that a segment holds."""
    for run, last in through.items():
        for base in (speed_path, f"{speed_path}/{DONE_DIR}"):
            for n in values(spark, f"{base}/run={run}", "batch_id"):
                if int(n) <= last:
                    remove_folder(spark, batch_folder(base, int(n), run))


def compact_speed(spark: SparkSession, speed_path: str, keep_batches: int = KEEP_BATCHES) -> dict[str, int]:
    """Move all finished batches but the newest ``keep_batches`` of each run
    into a segment. Returns the new last compacted batch id of each run.

    One compaction runs at a time; the speed layer may write meanwhile.
    """
    speed_path = speed_path.rstrip("/")
    before = compacted_through(spark, speed_path)
    _remove_compacted(spark, speed_path, before)
    upto = {run: last - keep_batches for run, last in (committed_batches(spark, speed_path) or {}).items()
            if last - keep_batches > before.get(run, -1)}
    if not upto:
        return {}
    picks = [(F.col("run") == F.lit(run)) & (F.col("batch_id") > F.lit(before.get(run, -1)))
             & (F.col("batch_id") <= F.lit(last)) for run, last in upto.items()]
    rows = spark.read.parquet(speed_path).where(reduce(lambda a, b: a | b, picks))
    rows = rows.select("run", "batch_id", *SPEED_SCHEMA.fieldNames())
    zones = window_zone(rows, "run").select("run", "starts", F.struct(
        F.timestamp_micros("low").alias("start"), F.timestamp_micros("high").alias("end")).alias("window"))
    ends = spark.createDataFrame(sorted(upto.items()), "run string, batch_id int").join(zones, "run", "left")
    segment = rows.unionByName(ends, allowMissingColumns=True).select(*SEGMENT_SCHEMA.fieldNames())
    number = 1 + max(map(int, values(spark, f"{speed_path}/{COMPACT_DIR}", "segment")), default=-1)
    _sized(segment).write.parquet(f"{speed_path}/{COMPACT_DIR}/segment={number}")
    return upto


def _sized(segment: DataFrame) -> DataFrame:
    """Files of AQE's advisory size instead of one per folder, in batch order
    so that a filter on batches skips row groups."""
    return segment.hint("rebalance").sortWithinPartitions("run", "batch_id")
