"""Skewed replica of the events table, and how the aggregations hold up on it.

    python tools/skew_check.py [sf_dir] [copies] [scratch_dir]

Writes ``copies`` copies of ``<sf_dir>/events.parquet`` to the scratch folder
(each copy its own event id range, made with ``explode(sequence(...))``, no
cross join). In every third copy the event type, user and so the page,
traffic source and account are forced to one value: one key then holds a
third of all rows. The catalogue's window counts, all-time totals, spend
de-duplication and per-account sum then run over the replica with an event
log, and the per-stage figures of ``tools/stage_metrics.py`` are printed.
With map-side partial aggregation the hot key costs one partial row per
task: the largest reduce task stays near an even share of the shuffled
records, and the shuffles are far smaller than the input.
"""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clickpulse.plans.catalog import BY_NAME  # noqa: E402

QUERIES = ("speed_window_counts", "all_time_totals", "spend_rows", "spend_by_account")
HOT_EVERY = 3  # one copy in three goes to the hot key


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 30
    scratch = sys.argv[3] if len(sys.argv) > 3 else tempfile.mkdtemp(prefix="skew-check-")
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir, exist_ok=True)
    spark = (SparkSession.builder.master("local[8]").appName("clickpulse-skew-check")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    stride = events.agg(F.max("event_id")).first()[0] + 1
    copy = F.col("copy")
    hot = copy % HOT_EVERY == 0
    replica = (events.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
               .select((copy * stride + F.col("event_id")).alias("event_id"), "ts",
                       F.when(hot, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
                       F.when(hot, F.lit("view")).otherwise(F.col("event_type")).alias("event_type"),
                       "value", "props"))
    replica.repartition(8 * copies // 10 + 8).write.mode("overwrite").parquet(f"{scratch}/events.parquet")

    sc = spark.sparkContext
    for name in QUERIES:
        sc.setJobGroup(name, name)
        BY_NAME[name].build(spark, scratch).write.format("noop").mode("overwrite").save()
    spark.stop()
    tool = os.path.join(os.path.dirname(os.path.abspath(__file__)), "stage_metrics.py")
    subprocess.run([sys.executable, tool, log_dir], check=True)


if __name__ == "__main__":
    main()
