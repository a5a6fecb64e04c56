"""Page visits: each click reduced to (timestamp, page)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def page_visits(clicks: DataFrame) -> DataFrame:
    return clicks.select("timestamp", "page")
