"""Batch layer: all-time totals per (page, trafficSource) and the report date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.operators.windows import SPEED_KEYS
from clickpulse.schemas import SPEED_SCHEMA, assert_schema


def all_time_totals(speed: DataFrame) -> DataFrame:
    """``sum(count)`` per (page, trafficSource) over the whole speed view.

    The speed view's real schema is checked first. The key space is tiny, so
    the partial aggregate leaves a handful of rows per task before the
    shuffle whatever the input size.
    """
    assert_schema(speed, SPEED_SCHEMA)
    return speed.groupBy(*SPEED_KEYS).agg(F.sum("count").cast("long").alias("sum_count"))


def with_report_date(df: DataFrame, report_date: str | dt.date | None = None) -> DataFrame:
    """Stamp the report date (ISO text; default: today's date in the session)."""
    if report_date is None:
        date_col = F.date_format(F.current_date(), "yyyy-MM-dd")
    else:
        date_col = F.lit(report_date.isoformat() if isinstance(report_date, dt.date) else str(report_date))
    return df.withColumn("report_date", date_col)
