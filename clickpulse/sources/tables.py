"""Readers of the stored views: speed view, batch report, spend table."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.schemas import REPORT_SCHEMA, SPEED_SCHEMA, assert_schema
from clickpulse.sources.storage import values, whole


COMPACT_DIR = "_compacted"  # hidden from plain reads, like the markers
# a segment: stored rows with their run and batch, and (count null) how far it goes
# per run, with the zone of the run's rows (window: smallest and largest start)
SEGMENT_SCHEMA = T.StructType([T.StructField("run", T.StringType()), T.StructField("batch_id", T.IntegerType()),
                               *SPEED_SCHEMA.fields, T.StructField("starts", T.LongType())])


def compacted_segments(spark: SparkSession, path: str, numbers: list[str] | None = None) -> DataFrame | None:
    """The rows of all whole segments of a speed view, or of some."""
    base = f"{path.rstrip('/')}/{COMPACT_DIR}"
    numbers = whole_segments(spark, path) if numbers is None else numbers
    found = [f"{base}/segment={n}" for n in numbers]
    return spark.read.schema(SEGMENT_SCHEMA).option("basePath", base).parquet(*found) if found else None


def whole_segments(spark: SparkSession, path: str) -> list[str]:
    base = f"{path.rstrip('/')}/{COMPACT_DIR}"
    return [n for n in values(spark, base, "segment") if whole(spark, f"{base}/segment={n}")]


def compacted_through(spark: SparkSession, path: str) -> dict[str, int]:
    """The last compacted batch id of each streaming run."""
    rows = compacted_segments(spark, path)
    if rows is None:
        return {}
    through = rows.where("count IS NULL").groupBy("run").agg(F.max("batch_id").alias("through"))
    return {r.run: r.through for r in through.collect()}  # one row per streaming run


def _named(batches: dict[str, list[int]]) -> Column:
    """True for rows of these batches; ids from the first on as a range."""
    out = F.lit(False)
    for run, ids in batches.items():
        last = max((n for n, i in enumerate(sorted(ids)) if i == n), default=-1)
        rest = [n for n in ids if n > last]
        inside = F.col("batch_id") <= F.lit(last)
        out = out | ((F.col("run") == F.lit(run)) & (inside | F.col("batch_id").isin(rest) if rest else inside))
    return out


def read_speed_view(spark: SparkSession, path: str, skip: dict[str, list[int]] | None = None,
                    skip_segments: list[str] = ()) -> DataFrame:
    """The speed view as written: Parquet, with ``run`` / ``batch_id``
    partition columns in partials mode, and the batches that were compacted
    from their segments.

    Its real schema is checked against the window-count row. ``skip`` names
    batches per run, and ``skip_segments`` segments, whose rows are not wanted:
    their files are not opened.
    """
    through = compacted_through(spark, path)  # before the folders are listed
    view = assert_schema(spark.read.parquet(path), SPEED_SCHEMA)
    if skip:
        view = view.where(~_named(skip))
    if not through:
        return view
    newer = [(F.col("run") == F.lit(run)) & (F.col("batch_id") > F.lit(last)) for run, last in through.items()]
    rest = view.where(reduce(lambda a, b: a | b, newer, ~F.col("run").isin(list(through))))
    old = [(F.col("run") == F.lit(run)) & (F.col("batch_id") <= F.lit(last)) for run, last in through.items()]
    stored = compacted_segments(spark, path, [n for n in whole_segments(spark, path) if n not in skip_segments])
    if stored is None:
        return rest
    stored = stored.where("count IS NOT NULL").where(reduce(lambda a, b: a | b, old))
    return rest.unionByName(stored.select(*rest.columns))


def read_report(spark: SparkSession, base: str, report_date: str | dt.date | None = None,
                fmt: str = "orc", keep_date: bool = True) -> DataFrame:
    """The batch report, optionally one ``report_date``.

    Reads the table root and filters on the partition column, so Spark
    prunes to that date's folder (``PartitionFilters`` in the scan) and the
    column stays available.
    """
    df = spark.read.format(fmt).load(base)
    assert_schema(df, REPORT_SCHEMA)
    if report_date is not None:
        d = report_date if isinstance(report_date, dt.date) else dt.date.fromisoformat(str(report_date))
        df = df.where(F.col("report_date") == F.lit(d))
    if not keep_date:
        df = df.drop("report_date")
    return df


def jdbc_options(url: str, table: str = "spend_report", user: str | None = None, password: str | None = None,
                 fetch_size: int = 10000, extra: dict | None = None) -> dict:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    opts.update(extra or {})
    return opts


def jdbc_range_options(options: dict, column: str, lower, upper, num_partitions: int) -> dict:
    """Options that split a JDBC read into ``num_partitions`` ranges of
    ``column`` (one query and one task each) instead of one query read by one
    task. The bounds only shape the ranges; rows outside them still go to the
    first and last range."""
    return {**options, "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(num_partitions)}


def read_spend_report(spark: SparkSession, fmt: str = "jdbc", path: str | None = None,
                      options: dict | None = None, num_partitions: int | None = None,
                      range_column: str = "log_ts") -> DataFrame:
    """The spend table: a relational table over JDBC, or files in tests.

    With ``num_partitions`` a JDBC read is split into ranges of
    ``range_column`` (default the event time, which spreads evenly even when
    one account holds a large share of the rows); its bounds come from one
    ``min`` / ``max`` query answered by the database.
    """
    opts = dict(options or {})
    if fmt == "jdbc" and num_partitions and num_partitions > 1:
        table = opts["dbtable"]
        probe = {k: v for k, v in opts.items() if k != "dbtable"}
        lo, hi = (spark.read.format("jdbc").options(**probe)
                  .option("query", f"SELECT min({range_column}) AS lo, max({range_column}) AS hi FROM {table}")
                  .load().first())
        if lo is not None:
            opts = jdbc_range_options(opts, range_column, lo, hi, num_partitions)
    reader = spark.read.format(fmt).options(**opts)
    return reader.load(path) if path else reader.load()
