"""Read-back ordering: newest windows and the largest totals.

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps its
own top n and only n rows per task reach the final merge, so no global sort
and no single task sees the whole input. Tie-breakers make the cut exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.config import TOP_ROWS


def latest_windows(speed: DataFrame, n: int = TOP_ROWS, flatten: bool = True) -> DataFrame:
    """The ``n`` newest windows (start, then end, descending), tie-broken by keys.

    On a speed view with partial rows, a ``batch_id`` column (if present)
    breaks the remaining ties.
    """
    extra = [F.col("batch_id").asc_nulls_first()] if "batch_id" in speed.columns else []
    ordered = speed.orderBy(
        F.col("window.start").desc(), F.col("window.end").desc(),
        F.col("page").asc_nulls_first(), F.col("trafficSource").asc_nulls_first(), *extra,
    ).limit(n)
    if flatten:
        rest = [c for c in ordered.columns if c != "window"]
        ordered = ordered.select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest,
        )
    return ordered


def _newest_bound(df: DataFrame, n: int) -> int | None:
    """A window start (epoch micros) with at least ``n`` distinct starts of
    ``df`` at or above it, or ``None`` when no such cut is worth making.

    One scan of the window column (partial min / max and a distinct-count
    sketch; no rows shuffled) gives the newest start and the mean spacing of
    distinct starts; the bound steps back about ``2 n`` spacings (at least
    ``n - 1`` window widths), doubling until an exact distinct count over the
    range reaches ``n``: usually one probe. Each probe carries the bound as a
    literal, which reaches the Parquet scan as a pushed filter.
    """
    start = F.unix_micros(F.col("window.start"))
    top = df.agg(F.max(start).alias("hi"), F.min(start).alias("lo"),
                 F.max(F.unix_micros(F.col("window.end")) - start).alias("width"),
                 F.approx_count_distinct(start).alias("starts")).first()
    if top.hi is None:
        return None
    spacing = (top.hi - top.lo) // max(int(top.starts or 1), 1)
    step = max(2 * n * spacing, int(top.width or 0) * (n - 1), 1)
    while top.hi - step > top.lo:
        bound = top.hi - step
        probe = df.where(F.col("window.start") >= F.timestamp_micros(F.lit(bound)))
        if probe.select("window.start").distinct().limit(n).count() >= n:
            return bound
        step *= 2
    return None


def newest_window_rows(speed: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """Only the rows of the ``n`` newest windows of a stored speed view.

    The ``n`` newest result rows (stored or re-aggregated) can only come
    from the ``n`` newest distinct window starts, since every window gives
    at least one row. So any bound with at least ``n`` distinct starts at or
    above it is an exact cut (``_newest_bound`` finds one). The view is
    filtered on it as a literal pushed into the Parquet scan: row groups of
    older micro-batches are skipped by their statistics, and only the newest
    windows' rows are shuffled and re-aggregated, instead of the whole
    history. A view of about ``2 n`` windows or fewer is read whole.
    """
    bound = _newest_bound(speed, n)
    if bound is None:
        return speed
    return speed.where(F.col("window.start") >= F.timestamp_micros(F.lit(bound)))


def top_report(report: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """The ``n`` largest ``sum_count`` rows, tie-broken by page and source."""
    return report.orderBy(
        F.col("sum_count").desc(), F.col("page").asc_nulls_first(), F.col("trafficSource").asc_nulls_first()
    ).limit(n)
