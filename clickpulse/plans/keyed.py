"""A keyed table of micro-batch folders, merged into files sorted by key range.

The spend job writes one folder per micro-batch; a key may be written again
later, and the row of the greatest offset counts. ``merge_batches`` moves the
rows of finished batches into files below ``<table>/_merged``: one row per key,
sorted by time, each file with its range of times in a manifest. It reads only
the new batches and the files whose range they touch, so its cost follows the
new data. A reader takes files that no newer batch touches as they are, and
resolves only the rest: reading does not go over all batches ever written.

A manifest is one small write and counts from its ``_SUCCESS`` on; it names
every file and, per streaming run, the last batch that the files hold. Folders
and files that a merge replaced go one merge later, so a reader that listed
them still finds them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators.spend import dedupe_spend
from clickpulse.sources.sinks import batch_folder
from clickpulse.sources.storage import exists, names, remove_folder, values, whole

MERGED_DIR = "_merged"  # hidden from plain reads of the table
KEEP_MERGED_BATCHES = 1  # the newest batch may still be written again
ROW_DDL = "account_id long, log_ts timestamp, amount long, offset long"
# rows of files (file set; times as microseconds) and of the last merged batch per run (run set)
MANIFEST_DDL = "file string, low long, high long, rows long, run string, through long"


class Manifest:
    """What the newest whole version says: files with their ranges, and the
    last merged batch of each run. One row per file and per run is held."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.base = f"{path.rstrip('/')}/{MERGED_DIR}"
        versions = [int(v) for v in values(spark, self.base, "version") if whole(spark, f"{self.base}/version={v}")]
        self.version = max(versions, default=-1)
        rows = [] if self.version < 0 else spark.read.schema(MANIFEST_DDL).parquet(f"{self.base}/version={self.version}").collect()
        self.files = [r for r in rows if r.file is not None]
        self.through = {r.run: r.through for r in rows if r.run is not None}

    def split(self, low: int | None, high: int | None) -> tuple[list, list]:
        """(files that touch low..high, the others)."""
        touched = [f for f in self.files if low is not None and f.low <= high and f.high >= low]
        return touched, [f for f in self.files if f not in touched]

    def read(self, spark: SparkSession, files: list) -> DataFrame:
        if not files:
            return spark.createDataFrame([], ROW_DDL)
        return spark.read.schema(ROW_DDL).parquet(*(f"{self.base}/{f.file}" for f in files))


def _newer(spark: SparkSession, path: str, manifest: Manifest, upto: dict[str, int] | None = None) -> DataFrame:
    """Rows of the batches that are not merged (with ``upto``: of run r up to
    ``upto[r]``). Their folders are named one by one; merges keep them few."""
    folders = [] if upto is not None else [batch_folder(path, int(n)) for n in values(spark, path, "batch_id")]
    for run in values(spark, path, "run") if upto is None else upto:
        for n in map(int, values(spark, f"{path}/run={run}", "batch_id")):
            if manifest.through.get(run, -1) < n and (upto is None or n <= upto[run]):
                folders.append(batch_folder(path, n, run))
    return spark.read.schema(ROW_DDL).parquet(*folders) if folders else spark.createDataFrame([], ROW_DDL)


def _bounds(rows: DataFrame) -> tuple:
    """Smallest and largest time; one row reaches the driver."""
    return tuple(rows.agg(F.min(F.unix_micros("log_ts")), F.max(F.unix_micros("log_ts"))).first())


def merge_batches(spark: SparkSession, path: str, policy: str = "last", keep_batches: int = KEEP_MERGED_BATCHES,
                  rows_per_file: int = 0) -> dict[str, int]:
    """Merge the finished batches but the newest ``keep_batches`` of each run.
    Returns the new last merged batch id of each run (empty: nothing to do).

    Under policy ``error`` a key that was written twice fails the merge.
    ``rows_per_file`` bounds files (0: AQE's advisory size alone). One merge
    runs at a time; the streaming job may write meanwhile.
    """
    path = path.rstrip("/")
    manifest = Manifest(spark, path)
    _remove_merged(spark, path, manifest)
    upto = {}
    for run in values(spark, path, "run"):
        done = sorted(int(b) for b in values(spark, f"{path}/run={run}", "batch_id") if whole(spark, batch_folder(path, int(b), run)))
        last = done[-1 - keep_batches] if len(done) > keep_batches else -1
        if last > manifest.through.get(run, -1):
            upto[run] = last
    if not upto:
        return {}
    fresh = dedupe_spend(_newer(spark, path, manifest, upto), policy, order_col="offset", keep_order=True)
    touched, rest = manifest.split(*_bounds(fresh))
    merged = dedupe_spend(fresh.unionByName(manifest.read(spark, touched)), policy, order_col="offset", keep_order=True)
    folder = f"data-{uuid.uuid4().hex[:12]}"
    # by ranges of time: one account may hold a third of the rows
    (merged.repartitionByRange("log_ts", "account_id").sortWithinPartitions("log_ts", "account_id")
     .write.option("maxRecordsPerFile", rows_per_file).parquet(f"{manifest.base}/{folder}"))
    written = spark.read.schema(ROW_DDL).parquet(f"{manifest.base}/{folder}")
    files = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(F.unix_micros("log_ts")).alias("low"), F.max(F.unix_micros("log_ts")).alias("high"), F.count(F.lit(1)).alias("rows"))
    files = files.withColumn("file", F.concat(F.lit(f"{folder}/"), F.col("file")))
    known = [(f.file, f.low, f.high, f.rows, None, None) for f in rest]
    known += [(None, None, None, None, run, n) for run, n in {**manifest.through, **upto}.items()]
    (spark.createDataFrame(known, MANIFEST_DDL).unionByName(files, allowMissingColumns=True).coalesce(1)  # one row per file
     .write.parquet(f"{manifest.base}/version={manifest.version + 1}"))  # fails if another merge was first
    return upto


def _remove_merged(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Delete what an earlier merge replaced: batch folders that the files
    hold, files and manifests that the newest manifest does not name."""
    for run, last in manifest.through.items():
        for n in values(spark, f"{path}/run={run}", "batch_id"):
            if int(n) <= last:
                remove_folder(spark, batch_folder(path, int(n), run))
    if manifest.version < 0:
        return
    live: dict[str, set[str]] = {}
    for f in manifest.files:
        folder, file = f.file.split("/")
        live.setdefault(folder, set()).add(file)
    for folder in names(spark, manifest.base):
        if folder.startswith("data-") and folder not in live:
            remove_folder(spark, f"{manifest.base}/{folder}")
        for file in names(spark, f"{manifest.base}/{folder}") if folder in live else []:
            if file.startswith("part-") and file not in live[folder]:
                remove_folder(spark, f"{manifest.base}/{folder}/{file}")
    for v in values(spark, manifest.base, "version"):
        if int(v) < manifest.version:
            remove_folder(spark, f"{manifest.base}/version={v}")


def read_merged(spark: SparkSession, path: str, policy: str = "last", low: dt.datetime | None = None,
                high: dt.datetime | None = None) -> DataFrame:
    """One row per key: account_id, log_ts, amount; with ``low`` and ``high``
    only keys of these times, from the files and rows of that range.

    Files that no batch after the last merge touches are only scanned.
    """
    path = path.rstrip("/")
    manifest = Manifest(spark, path)
    lo, hi = (None if t is None else round(t.timestamp() * 1e6) for t in (low, high))
    within = lambda df: df if lo is None else df.where(
        F.col("log_ts").between(F.timestamp_micros(F.lit(lo)), F.timestamp_micros(F.lit(hi))))
    if lo is not None:
        manifest.files = manifest.split(lo, hi)[0]
    newer = within(_newer(spark, path, manifest))
    touched, rest = manifest.split(*_bounds(newer))
    resolved = dedupe_spend(newer.unionByName(within(manifest.read(spark, touched))), policy, order_col="offset")
    columns = ["account_id", "log_ts", "amount"]
    return resolved.select(*columns).unionByName(within(manifest.read(spark, rest)).select(*columns))


def is_merged(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{MERGED_DIR}")
