"""Columns -> wire form: JSON clicks and statistics, CSV transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.config import CLICK_TIME_PATTERN, CLICK_TIME_PATTERN_12H, TRANSACTION_TIME_PATTERN

# Keep null fields in the JSON text, as an object mapper does.
_JSON_OPTIONS = {"ignoreNullFields": "false"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def click_json(timestamp: Column | str, page: Column | str, user_id: Column | str,
               duration: Column | str, traffic_source: Column | str,
               pattern: str = CLICK_TIME_PATTERN) -> Column:
    """One click as JSON text; the event time is formatted with ``pattern``."""
    return F.to_json(
        F.struct(
            F.date_format(_col(timestamp), pattern).alias("timestamp"),
            _col(page).alias("page"),
            _col(user_id).cast("long").alias("userId"),
            _col(duration).cast("long").alias("duration"),
            _col(traffic_source).alias("trafficSource"),
        ),
        _JSON_OPTIONS,
    )


def page_stats_json(window_start: Column | str, window_end: Column | str, page: Column | str,
                    count: Column | str, pattern: str = CLICK_TIME_PATTERN_12H) -> Column:
    """Page statistics as JSON text with formatted window bounds.

    The default pattern is the 12-hour one the statistics class declares.
    """
    return F.to_json(
        F.struct(
            F.date_format(_col(window_start), pattern).alias("windowStart"),
            F.date_format(_col(window_end), pattern).alias("windowEnd"),
            _col(page).alias("page"),
            _col(count).cast("long").alias("count"),
        ),
        _JSON_OPTIONS,
    )


def transaction_csv(account_id: Column | str, amount: Column | str, log_ts: Column | str,
                    pattern: str = TRANSACTION_TIME_PATTERN) -> Column:
    """``account_id, amount, time`` with a blank after each comma."""
    return F.concat_ws(
        ", ",
        _col(account_id).cast("string"),
        _col(amount).cast("string"),
        F.date_format(_col(log_ts), pattern),
    )


def clicks_to_records(clicks: DataFrame, pattern: str = CLICK_TIME_PATTERN) -> DataFrame:
    """Typed clicks -> Kafka key/value rows with JSON values (click topic sink)."""
    return clicks.select(
        F.lit(None).cast("binary").alias("key"),
        click_json("timestamp", "page", "userId", "duration", "trafficSource", pattern).cast("binary").alias("value"),
    )
