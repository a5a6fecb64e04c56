"""Batch writers used per micro-batch and by the batch layer.

None of them funnels its work through one task: file counts are bounded only
when asked, by a shuffle of the finished rows (``_capped``), and otherwise left
to AQE's partition sizing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.sources.storage import exists


def _capped(rows: DataFrame, max_files: int | None) -> DataFrame:
    """Rows in at most ``max_files`` partitions, so files. They are shuffled
    there: ``coalesce`` would draw the aggregation before it into those tasks,
    where each of its partitions adds a hash map to the task's memory."""
    return rows.repartition(max_files) if max_files else rows


def sized_batches(rows: DataFrame, max_files: int | None = None) -> DataFrame:
    """Rows of several micro-batches (column ``batch_id``), the rows of each in at
    most ``max_files`` partitions, so files. Without a cap AQE, where it may merge
    partitions, sizes them around whole micro-batches."""
    if max_files:
        rest = [c for c in rows.columns if c != "batch_id"]
        return rows.repartition("batch_id", F.pmod(F.hash(*rest), F.lit(max_files)))
    merges = rows.sparkSession.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true") == "true"
    return rows.hint("rebalance", "batch_id") if merges else rows


def append_rows(df: DataFrame, fmt: str = "parquet", path: str | None = None, options: dict | None = None) -> None:
    """Append rows to a table given by data source name and options.

    Production passes the wide-column connector (keyspace/table options);
    tests pass Parquet and a path. Null fields are written as nulls.
    """
    w = df.write.format(fmt).mode("append").options(**(options or {}))
    if path:
        w.save(path)
    else:
        w.save()


RECORD_KEY = ("topic", "partition", "offset")


def append_new_rows(df: DataFrame, fmt: str = "parquet", path: str | None = None, options: dict | None = None) -> None:
    """Append the rows of a micro-batch that the table does not hold yet, by
    RECORD_KEY, so writing a batch again is a no-op.

    A retried batch holds the same offsets, so only the table's rows of the
    batch's offset range are read (a filter that the source gets); a topic
    partition's range may hold rows of others, which the join tells apart.
    """
    rows = df.persist()
    try:
        low, high = rows.agg(F.min("offset"), F.max("offset")).first()
        if low is None:
            return
        reader = df.sparkSession.read.format(fmt).options(**(options or {}))
        if path and not exists(df.sparkSession, path):
            return append_rows(rows, fmt, path, options)
        table = reader.load(path) if path else reader.load()
        held = table.where(F.col("offset").between(low, high)).select(*RECORD_KEY)
        append_rows(rows.join(held, list(RECORD_KEY), "left_anti").select(*df.columns), fmt, path, options)
    finally:
        rows.unpersist()


def run_folder(path: str, run: str | None = None) -> str:
    return f"{path.rstrip('/')}/run={run}" if run else path.rstrip("/")


def batch_folder(path: str, batch_id: int, run: str | None = None) -> str:
    """``<path>[/run=<query id>]/batch_id=<n>``: one folder per micro-batch."""
    return f"{run_folder(path, run)}/batch_id={int(batch_id)}"


def write_batch_folders(rows: DataFrame, path: str, run: str | None = None) -> None:
    """Rows of several micro-batches to their folders, in one write that replaces
    these folders and no other."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
     .parquet(run_folder(path, run)))


def write_speed_batch(counts: DataFrame, speed_path: str, batch_id: int, max_files: int | None = None,
                      run: str | None = None) -> str:
    """Write one micro-batch's window counts to its own batch folder.

    Overwriting the batch's own folder makes a retried batch replace its
    earlier attempt instead of adding a second copy.
    """
    target = batch_folder(speed_path, batch_id, run)
    _capped(counts, max_files).write.mode("overwrite").parquet(target)
    return target


def write_report(report: DataFrame, base: str, fmt: str = "orc", overwrite_mode: str = "dynamic",
                 max_files: int | None = None) -> None:
    """Overwrite the report partitioned by ``report_date``.

    ``dynamic`` replaces only the dates present in ``report`` (history is
    kept); ``static`` replaces the whole table.
    """
    (_capped(report, max_files).write.mode("overwrite").option("partitionOverwriteMode", overwrite_mode)
     .partitionBy("report_date").format(fmt).save(base))


def write_batch_folder(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                       run: str | None = None) -> str:
    """Write one micro-batch of a file table to its own ``batch_id`` folder.

    A retried batch overwrites its folder instead of adding a second copy.
    File tables cannot upsert in place, so readers of keyed tables resolve
    keys across batches; keyed stores (JDBC, wide-column) take
    ``append_rows`` and their own key semantics instead.
    """
    target = batch_folder(path, batch_id, run)
    df.write.mode("overwrite").format(fmt).save(target)
    return target
