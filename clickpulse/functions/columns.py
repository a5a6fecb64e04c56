"""Small projections shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.config import SPEND_BAND_RED_FROM


def flatten_window(df: DataFrame, window_col: str = "window", start: str = "window_start",
                   end: str = "window_end") -> DataFrame:
    """Replace the ``window`` struct by two timestamp columns."""
    rest = [c for c in df.columns if c != window_col]
    return df.select(F.col(f"{window_col}.start").alias(start), F.col(f"{window_col}.end").alias(end), *rest)


def value_band(value: Column | str, red_from: float = SPEND_BAND_RED_FROM) -> Column:
    """Threshold band of a value: base ``green``, ``red`` from ``red_from``."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v >= F.lit(red_from), F.lit("red")).otherwise(F.lit("green"))
