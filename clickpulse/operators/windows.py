"""Event-time window counts (speed layer) and page statistics.

``window()`` aligns tumbling windows to the Unix epoch, half-open
``[start, end)``, and drops rows with a null event time. The count is a
two-phase hash aggregate: each task collapses its rows per key before the
shuffle, so a hot page or source costs one row per task, not a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.config import DEFAULT_WINDOW_SECONDS, PAGE_STATS_WINDOW_SECONDS

SPEED_KEYS = ("page", "trafficSource")


def window_counts(clicks: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
                  watermark_seconds: int | None = None, time_col: str = "timestamp",
                  extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """``count(*)`` per (tumbling window, page, trafficSource).

    With ``watermark_seconds`` on a *streaming* frame, state is bounded and
    append mode emits each window once it is closed. On a static frame
    Spark ignores the watermark (every row counts).
    """
    src = clicks
    if watermark_seconds is not None:
        src = src.withWatermark(time_col, f"{watermark_seconds} seconds")
    return (
        src.groupBy(*extra_keys, F.window(F.col(time_col), f"{window_seconds} seconds").alias("window"),
                    *SPEED_KEYS)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def window_zone(speed: DataFrame, *keys: str) -> DataFrame:
    """``low``, ``high``: smallest and largest window start in microseconds;
    ``starts``: how many different ones there are; per ``keys``, if given."""
    start = F.unix_micros(F.col("window.start"))
    return speed.groupBy(*keys).agg(F.min(start).alias("low"), F.max(start).alias("high"),
                                    F.count_distinct(start).alias("starts"))


def reaggregate_speed(speed: DataFrame) -> DataFrame:
    """Exact per-window counts from a speed view holding partial rows.

    A window cut across k micro-batches is stored as k rows; summing them
    gives the same result in ``partials`` and ``final`` mode.
    """
    return speed.groupBy("window", *SPEED_KEYS).agg(F.sum("count").cast("long").alias("count"))


def page_stats(clicks: DataFrame, window_seconds: int = PAGE_STATS_WINDOW_SECONDS,
               watermark_ms: int | None = None, time_col: str = "timestamp") -> DataFrame:
    """Clicks per (tumbling window, page) as ``windowStart, windowEnd, page, count``."""
    src = clicks
    if watermark_ms is not None:
        src = src.withWatermark(time_col, f"{watermark_ms} milliseconds")
    counted = (src.groupBy(F.window(F.col(time_col), f"{window_seconds} seconds").alias("window"), "page")
               .agg(F.count(F.lit(1)).alias("count")))
    return counted.select(
        F.col("window.start").alias("windowStart"),
        F.col("window.end").alias("windowEnd"),
        "page",
        "count",
    )
