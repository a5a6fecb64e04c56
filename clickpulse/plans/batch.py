"""Batch layer: speed view -> all-time totals -> report partitioned by date.

Two ways to the same totals:

* full (default): sum the whole speed view, as the original job does;
* incremental: an earlier state plus the speed-view batches written since. A
  state, ``<report>/_report_state/report_date=<d>``, holds the totals of a
  report date together with the highest batch id they cover per streaming run,
  in one write; it counts once its ``_SUCCESS`` file is there. Totals are
  computed from states and the speed view only, never from the report, so
  neither a full run of a date nor a run that died half-way can part totals and
  coverage. The new batches are picked by a filter on the ``run`` /
  ``batch_id`` partition columns, so only their folders are read. The cost
  follows the new data, not the whole history. Needs the ``partials`` layout
  (``run=<id>/batch_id=<n>``); other layouts fall back to full. The newest
  batch per run is taken from the speed layer's completion markers, read
  before the view is listed, so a batch whose files are still being
  committed is not counted half (it waits for the next report).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators.totals import all_time_totals, with_report_date
from clickpulse.operators.windows import SPEED_KEYS
from clickpulse.plans.speed import DONE_DIR
from clickpulse.sources.sinks import write_report
from clickpulse.sources.storage import exists, values, whole
from clickpulse.sources.tables import compacted_through, read_report, read_speed_view

STATE_DIR = "_report_state"  # leading underscore: hidden from report reads
# rows of totals (run null) and of coverage (run set)
STATE_DDL = "page string, trafficSource string, sum_count long, run string, through long"


def build_report(speed: DataFrame, report_date: str | dt.date | None = None) -> DataFrame:
    """Totals stamped with the report date (ordering is a reader's concern)."""
    return with_report_date(all_time_totals(speed), report_date)


def _previous_state(spark: SparkSession, report_base: str, report_date: str) -> DataFrame | None:
    """The newest whole state of an earlier report date."""
    base = f"{report_base.rstrip('/')}/{STATE_DIR}"
    dates = [d for d in values(spark, base, "report_date") if d < report_date and whole(spark, f"{base}/report_date={d}")]
    return spark.read.schema(STATE_DDL).parquet(f"{base}/report_date={max(dates)}") if dates else None


def committed_batches(spark: SparkSession, speed_path: str) -> dict | None:
    """Newest fully written batch id per streaming run, from the completion
    markers and from what is compacted (``None`` when the view has neither,
    e.g. written without them)."""
    newest = dict(compacted_through(spark, speed_path))
    markers = f"{speed_path.rstrip('/')}/{DONE_DIR}"
    if exists(spark, markers):
        done = spark.read.parquet(markers)
        if "run" in done.columns:
            for r in done.groupBy("run").agg(F.max("batch_id").alias("through")).collect():
                newest[r.run] = max(r.through, newest.get(r.run, -1))
    return newest or None


def incremental_totals(spark: SparkSession, speed: DataFrame, report_base: str, report_date: str,
                       snapshot: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(totals, coverage) for ``report_date`` from the newest earlier state and
    the speed batches it has not covered yet.

    The per-run snapshot (one row per streaming run, i.e. per checkpoint)
    fixes the upper batch id, so batches landing during the job wait for the
    next report instead of being half counted. Pass the snapshot from
    ``committed_batches``, taken before ``speed`` was listed; without it the
    newest batch ids of ``speed`` itself are used.
    """
    if snapshot is None:
        snapshot = {r.run: r.through for r in
                    speed.groupBy("run").agg(F.max("batch_id").alias("through")).collect()}
    before = _previous_state(spark, report_base, report_date)
    # one row per streaming run
    covered = {} if before is None else {r.run: r.through for r in before.where("run IS NOT NULL").collect()}
    picks = [(F.col("run") == F.lit(run)) & (F.col("batch_id") > F.lit(covered.get(run, -1)))
             & (F.col("batch_id") <= F.lit(through)) for run, through in snapshot.items()]
    new_rows = speed.where(reduce(lambda a, b: a | b, picks, F.lit(False)))
    fresh = all_time_totals(new_rows)
    if before is not None:
        fresh = (before.where("run IS NULL").select(*SPEED_KEYS, "sum_count").unionByName(fresh).groupBy(*SPEED_KEYS)
                 .agg(F.sum("sum_count").cast("long").alias("sum_count")))
    merged = {**covered, **{run: max(t, covered.get(run, -1)) for run, t in snapshot.items()}}
    coverage = spark.createDataFrame([(run, int(t)) for run, t in sorted(merged.items())], "run string, through long")
    return fresh, coverage


def _write_state(spark: SparkSession, totals: DataFrame, coverage: DataFrame, report_base: str, day: str) -> DataFrame:
    """Totals and coverage of a date in one write; returns the written totals."""
    path = f"{report_base.rstrip('/')}/{STATE_DIR}/report_date={day}"
    state = totals.unionByName(coverage, allowMissingColumns=True)
    state.select(*spark.createDataFrame([], STATE_DDL).columns).write.mode("overwrite").parquet(path)
    return spark.read.schema(STATE_DDL).parquet(path).where("run IS NULL").select(*SPEED_KEYS, "sum_count")


def run_batch_layer(spark: SparkSession, speed_path: str, report_base: str,
                    report_date: str | dt.date | None = None, overwrite_mode: str = "dynamic",
                    fmt: str = "orc", max_files: int | None = None, incremental: bool = False) -> DataFrame:
    """Read the speed view, write the report, return that date's rows read back."""
    if incremental and overwrite_mode == "static":
        raise ValueError("static overwrite would delete the states that an incremental report is computed from")
    # markers first: every batch they name is fully written before the view is listed
    snapshot = committed_batches(spark, speed_path) if incremental else None
    speed = read_speed_view(spark, speed_path)
    if report_date is None:  # the session's date, for both ways
        report_date = spark.sql("SELECT current_date()").first()[0]
    day = report_date if isinstance(report_date, str) else report_date.isoformat()
    if incremental and {"run", "batch_id"} <= set(speed.columns):
        totals, coverage = incremental_totals(spark, speed, report_base, day, snapshot)
        report = with_report_date(_write_state(spark, totals, coverage, report_base, day), day)
    else:
        report = build_report(speed, day)
    write_report(report, report_base, fmt=fmt, overwrite_mode=overwrite_mode, max_files=max_files)
    return read_report(spark, report_base, day, fmt=fmt)
