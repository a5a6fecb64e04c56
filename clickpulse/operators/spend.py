"""Spend report: keyed transaction rows and the per-account sum.

The report table has primary key (account_id, log_ts) and no nullable
column. ``dedupe_spend`` enforces that on any frame:

* ``policy="error"`` — a second row for a key fails the query (what a
  primary key does on insert);
* ``policy="last"`` — the row with the greatest ``order_col`` wins (upsert); a
  null there has no order and fails the query.

Null keys or amounts fail the query. Checks use ``raise_error`` inside the
plan, so they cost no extra pass. ``max_by`` is a declarative aggregate with
a partial phase: a key holding a large share of rows is collapsed per task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.columns import value_band

KEY = ("account_id", "log_ts")


def _not_null(col: str) -> F.Column:
    return F.when(F.col(col).isNull(), F.raise_error(F.lit(f"spend_report: NULL in NOT NULL column {col}"))) \
        .otherwise(F.col(col))


def dedupe_spend(tx: DataFrame, policy: str = "last", order_col: str = "offset",
                 keep_order: bool = False) -> DataFrame:
    """At most one row per (account_id, log_ts); columns as in the table.

    ``keep_order`` also returns the row's ``order_col``, computed in the same
    aggregate.
    """
    if policy not in ("last", "error"):
        raise ValueError("policy must be 'last' or 'error'")
    checked = tx.select(
        _not_null("account_id").cast("long").alias("account_id"),
        _not_null("log_ts").alias("log_ts"),
        _not_null("amount").cast("long").alias("amount"),
        *([_not_null(order_col).alias(order_col)] if policy == "last" else [order_col] if keep_order else []),
    )
    if policy == "last":
        aggs = [F.max_by("amount", order_col).alias("amount")]
        if keep_order:
            aggs.append(F.max(order_col).alias(order_col))
        return checked.groupBy(*KEY).agg(*aggs)
    kept = [F.first(order_col).alias(order_col)] if keep_order else []
    grouped = checked.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.first("amount").alias("amount"), *kept)
    return grouped.select(
        *KEY,
        F.when(F.col("n") > 1, F.raise_error(F.lit("spend_report: duplicate primary key (account_id, log_ts)")))
        .otherwise(F.col("amount")).alias("amount"),
        *([order_col] if keep_order else []),
    )


def spend_by_account(report: DataFrame, with_time: bool = False, with_band: bool = True) -> DataFrame:
    """``metric`` (account id as text), ``value`` = sum(amount), optional band.

    ``time`` (the query time) is added only on request: it is not repeatable.
    """
    out = report.groupBy("account_id").agg(F.sum("amount").cast("long").alias("value"))
    cols = [F.col("account_id").cast("string").alias("metric"), "value"]
    if with_band:
        cols.append(value_band("value").alias("band"))
    if with_time:
        cols.insert(0, F.current_timestamp().alias("time"))
    return out.select(*cols)
