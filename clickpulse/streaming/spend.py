"""Transactions topic -> spend_report table.

Each micro-batch is parsed (CSV), de-duplicated on the primary key and
written.

* JDBC table: Spark's JDBC writer appends, so only policy ``error`` is taken:
  the table's own primary key rejects a key that an earlier batch already
  wrote with another amount. Policy ``last`` needs a ``merge`` function of the
  caller's database. Rows already in the table unchanged are not sent again
  (``without_written``), so a micro-batch re-run after a crash between its
  insert and its commit does not trip the key and block the query.
* File table: one folder per run and batch id (a retry overwrites it) and
  ``read_spend_table`` resolves keys across batches, so ``last`` holds
  across the whole stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse.functions.decode import parse_transactions
from clickpulse.operators.spend import KEY, dedupe_spend
from clickpulse.plans.keyed import is_merged, read_merged
from clickpulse.sources.sinks import append_rows, write_batch_folder
from clickpulse.streaming.triggers import RunTag, require_checkpoint, with_trigger


def start_spend_report(records: DataFrame, checkpoint: str, fmt: str = "jdbc", path: str | None = None,
                       options: dict | None = None, policy: str = "last", trigger_seconds: int | None = None,
                       available_now: bool = False,
                       merge: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """``merge(rows, batch_id)`` writes a micro-batch to a keyed table in place
    of the JDBC append. Policy ``last`` needs it there: an append cannot
    replace a row of an earlier batch."""
    if policy == "last" and fmt == "jdbc" and not path and merge is None:
        raise ValueError("policy 'last' on a JDBC table needs a merge function; a JDBC append only inserts")
    tx = parse_transactions(records, keep=("offset",))
    tag = RunTag()

    def write(batch: DataFrame, batch_id: int) -> None:
        if path:
            # keep the offset so later batches and readers can order rows
            resolved = dedupe_spend(batch, policy, order_col="offset", keep_order=True)
            write_batch_folder(resolved, path, batch_id, fmt=fmt, run=tag.get())
        elif merge is not None:
            merge(dedupe_spend(batch, policy, order_col="offset"), batch_id)
        else:
            rows = dedupe_spend(batch, policy, order_col="offset").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                table = batch.sparkSession.read.format(fmt).options(**(options or {})).load()
                append_rows(without_written(rows, table), fmt, None, options)
            finally:
                rows.unpersist()

    w = tx.writeStream.foreachBatch(write).option("checkpointLocation", require_checkpoint(checkpoint))
    return tag.bind(with_trigger(w, trigger_seconds, available_now).start())


def without_written(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` minus those already in ``table`` with the same amount.

    Only the table's rows inside the batch's ``log_ts`` range are read: a
    literal range that a JDBC source sends to the database as its WHERE
    clause, so the cost follows the batch, not the table. A key written
    earlier with a different amount is kept and meets the table's primary
    key, as a conflict should.
    """
    lo, hi = rows.agg(F.min(F.unix_micros("log_ts")), F.max(F.unix_micros("log_ts"))).first()
    if lo is None:
        return rows
    in_range = F.col("log_ts").between(F.timestamp_micros(F.lit(lo)), F.timestamp_micros(F.lit(hi)))
    written = (table.where(in_range)
               .select(F.col("account_id").cast("long").alias("account_id"), "log_ts",
                       F.col("amount").cast("long").alias("amount")))
    return rows.join(written, on=[*KEY, "amount"], how="left_anti")


def read_spend_table(spark: SparkSession, path: str, fmt: str = "parquet", policy: str = "last") -> DataFrame:
    """Resolve the per-batch folders: one row per key, the greatest offset wins.
    Batches that were merged (``plans.keyed``) are read from the merged files.

    All records of one account share a topic partition (the account is the
    record key), so offset order is the order they arrived in, whichever
    micro-batch carried them.
    """
    if is_merged(spark, path):
        return read_merged(spark, path, policy)
    rows = spark.read.format(fmt).load(path)
    if policy == "last":
        return dedupe_spend(rows, "last", order_col="offset")
    return dedupe_spend(rows, "error")
