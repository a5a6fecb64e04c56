"""Read-back views of both layers (what an analyst looks at)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.config import TOP_ROWS
from clickpulse.operators.ordering import latest_windows, newest_window_rows, top_report
from clickpulse.operators.windows import reaggregate_speed
from clickpulse.plans.speed import DONE_DIR
from clickpulse.sources.storage import exists
from clickpulse.sources.tables import compacted_segments, compacted_through, read_report, read_speed_view, whole_segments


def report_view(spark: SparkSession, report_base: str, report_date: str | dt.date,
                n: int = TOP_ROWS, fmt: str = "orc") -> DataFrame:
    """Largest totals of one report date."""
    return top_report(read_report(spark, report_base, report_date, fmt=fmt), n)


@dataclass(frozen=True)
class Zone:
    """Window starts (microseconds) of a finished batch or of a segment."""

    low: int
    high: int
    starts: int
    run: str | None = None
    batch: int | None = None
    segment: str | None = None


def view_zones(spark: SparkSession, speed_path: str) -> list[Zone]:
    """The zones that markers and segments state: one row for each batch kept
    as written (compaction bounds them), one for each segment and run."""
    base = speed_path.rstrip("/")
    found = []
    numbers = whole_segments(spark, base)
    if numbers:
        through = compacted_segments(spark, base, numbers).where("count IS NULL AND starts IS NOT NULL")
        found += [Zone(r.low, r.high, r.starts, segment=str(r.segment)) for r in through.select(
            "segment", "starts", *(F.unix_micros(f"window.{e}").alias(n) for e, n in (("start", "low"), ("end", "high")))).collect()]
    if exists(spark, f"{base}/{DONE_DIR}"):
        done = spark.read.schema("low long, high long, starts long").parquet(f"{base}/{DONE_DIR}")
        if "run" in done.columns:
            through = compacted_through(spark, base)
            found += [Zone(r.low, r.high, r.starts, r.run, r.batch_id) for r in done.where("low IS NOT NULL").collect()
                      if r.batch_id > through.get(r.run, -1)]
    return found


def newest_cut(zones: list[Zone], n: int) -> int | None:
    """A window start with ``n`` different ones or more at or above it: from
    zones that lie apart, or one that holds enough. None if they hold too few."""
    cut = max((z.low for z in zones if z.starts >= n), default=None)
    total, floor = 0, None
    for z in sorted(zones, key=lambda z: -z.low):
        if floor is None or z.high < floor:
            total, floor = total + z.starts, z.low
            if total >= n:
                return floor if cut is None else max(cut, floor)
    return cut


def speed_view(spark: SparkSession, speed_path: str, n: int = TOP_ROWS, reaggregate: bool = True) -> DataFrame:
    """Newest windows of the speed view; partial rows summed first unless
    ``reaggregate`` is off (then the rows show as stored, one per batch).

    The ``n`` newest rows come from the ``n`` newest window starts. The zones
    of batches and segments give a cut with that many above it, so only those
    that reach above the cut are opened, and of them only the rows above it. A
    batch without a zone is always opened; a view whose zones hold too few
    windows is searched whole (``newest_window_rows``).
    """
    zones = view_zones(spark, speed_path)
    cut = newest_cut(zones, n)
    if cut is None:
        view = newest_window_rows(read_speed_view(spark, speed_path), n)
    else:
        old: dict[str, list[int]] = {}
        for z in zones:
            if z.high < cut and z.batch is not None:
                old.setdefault(z.run, []).append(z.batch)
        live = {z.segment for z in zones if z.high >= cut}
        segments = [s for s in {z.segment for z in zones if z.segment is not None} if s not in live]
        view = read_speed_view(spark, speed_path, old, segments).where(F.col("window.start") >= F.timestamp_micros(F.lit(cut)))
    return latest_windows(reaggregate_speed(view) if reaggregate else view, n)


def preview(df: DataFrame, n: int = TOP_ROWS) -> None:
    """Print the first ``n`` rows untruncated (the jobs' driver preview)."""
    df.show(n, truncate=False)
