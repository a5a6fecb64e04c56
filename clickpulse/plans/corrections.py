"""Late rows of the final mode: signed corrections for windows already emitted.

In final mode a window is emitted once, when the watermark has passed it; rows
that come later are dropped. The second query of the mode keeps the counts of
every micro-batch (``partials_path``), which miss nothing. ``correct_final``
compares the two and stores signed rows, so that for every closed window

    emitted count + corrections = counts of the finished micro-batches.

A run looks at windows that closed since the run before it (all their counts),
and, of older windows, at the counts of new micro-batches only. Rows, the
micro-batches they cover and the newest closed window are one write, which
counts from its ``_SUCCESS`` file on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators.windows import SPEED_KEYS, reaggregate_speed
from clickpulse.plans.batch import committed_batches
from clickpulse.sources.storage import values, whole
from clickpulse.sources.tables import read_speed_view

CORRECTIONS_DIR = "_corrections"  # below the final view, hidden from plain reads
# signed rows (run null) and coverage (run set): last micro-batch, newest closed window end
_DDL = ("window struct<start:timestamp,end:timestamp>, page string, trafficSource string, count long, "
        "run string, through long, closed long")
_ROW = ("window", *SPEED_KEYS, "count")


def _runs(spark: SparkSession, final_path: str) -> list[int]:
    base = f"{final_path.rstrip('/')}/{CORRECTIONS_DIR}"
    return sorted(int(n) for n in values(spark, base, "number") if whole(spark, f"{base}/number={n}"))


def _read(spark: SparkSession, final_path: str, numbers: list[int]) -> DataFrame:
    base = f"{final_path.rstrip('/')}/{CORRECTIONS_DIR}"
    return spark.read.schema(_DDL).parquet(*(f"{base}/number={n}" for n in numbers))


def correct_final(spark: SparkSession, final_path: str, partials_path: str) -> int | None:
    """Store the corrections for all windows closed so far. Returns the number
    of the run, None if there is nothing to cover yet. One run at a time."""
    newest = committed_batches(spark, partials_path)
    final = read_speed_view(spark, final_path)
    end = F.unix_micros(F.col("window.end"))
    closed = final.agg(F.max(end)).first()[0]
    if not newest or closed is None:
        return None
    done = _runs(spark, final_path)
    # one row per streaming run
    before = _read(spark, final_path, done[-1:]).where("run IS NOT NULL").collect() if done else []
    covered, last = {r.run: r.through for r in before}, max((r.closed for r in before), default=None)

    def batches(low: dict[str, int]) -> Column:
        picks = [(F.col("run") == F.lit(run)) & (F.col("batch_id") > F.lit(low.get(run, -1))) & (F.col("batch_id") <= F.lit(n))
                 for run, n in newest.items()]
        return reduce(lambda a, b: a | b, picks)

    at = lambda micros: F.timestamp_micros(F.lit(micros))
    fresh = F.col("window.end") <= at(closed)
    if last is not None:
        fresh = fresh & (F.col("window.end") > at(last))
    partials = read_speed_view(spark, partials_path)
    signed = partials.where(batches({})).where(fresh).select(*_ROW).unionByName(
        final.where(fresh).select(*_ROW).withColumn("count", -F.col("count")))
    if last is not None:
        signed = signed.unionByName(partials.where(batches(covered)).where(F.col("window.end") <= at(last)).select(*_ROW))
    rows = reaggregate_speed(signed).where("count <> 0")
    coverage = spark.createDataFrame([(run, n, closed) for run, n in sorted({**covered, **newest}.items())],
                                     "run string, through long, closed long")
    number = done[-1] + 1 if done else 0
    state = rows.unionByName(coverage, allowMissingColumns=True).select(*_ROW, "run", "through", "closed")
    state.write.mode("overwrite").parquet(f"{final_path.rstrip('/')}/{CORRECTIONS_DIR}/number={number}")
    return number


def corrected_counts(spark: SparkSession, final_path: str) -> DataFrame:
    """Counts of the final view with all corrections added."""
    rows = read_speed_view(spark, final_path).select(*_ROW)
    done = _runs(spark, final_path)
    if done:
        rows = rows.unionByName(_read(spark, final_path, done).where("run IS NULL").select(*_ROW))
    return reaggregate_speed(rows).where("count <> 0")
