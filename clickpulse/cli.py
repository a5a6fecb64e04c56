"""Command line entry points, one per job of the original project.

    python -m clickpulse.cli speed  --topic input --bootstrap localhost:29092 ...
    python -m clickpulse.cli batch  --speed-path ... --report-path ... [--report-date 2022-08-27]
    python -m clickpulse.cli compact --speed-path ... [--keep-batches 720]
    python -m clickpulse.cli check  --speed-path ... --report-path ... --report-date 2022-08-27
    python -m clickpulse.cli visits --input-topic input --bootstrap.servers localhost:9092 ...
    python -m clickpulse.cli stats  --input-topic input --output-topic stats ...
    python -m clickpulse.cli spend  --topic transactions --jdbc-url jdbc:<driver>://host/db ...
    python -m clickpulse.cli correct --speed-path ... --partials-path ...
    python -m clickpulse.cli merge  --path ... [--keep-batches 1]
    python -m clickpulse.cli dashboard --jdbc-url jdbc:<driver>://host/db [--partitions 16]

The session comes from ``spark-submit`` (master, memory, checkpoint dir).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from clickpulse.config import (
    CLICK_TIME_PATTERN,
    DEFAULT_GROUP_ID,
    DEFAULT_TOPIC,
    DEFAULT_TRIGGER_SECONDS,
    DEFAULT_WATERMARK_SECONDS,
    DEFAULT_WINDOW_SECONDS,
    TOP_ROWS,
    VISITS_GROUP_ID,
    LayerConfig,
)
from clickpulse.operators.ordering import top_report
from clickpulse.operators.spend import spend_by_account
from clickpulse.plans.batch import run_batch_layer
from clickpulse.plans.check import preview, report_view, speed_view
from clickpulse.plans.compact import KEEP_BATCHES, compact_speed
from clickpulse.plans.corrections import correct_final
from clickpulse.plans.keyed import KEEP_MERGED_BATCHES, merge_batches
from clickpulse.sources.kafka import read_kafka, read_record_files, starting_offsets
from clickpulse.sources.tables import jdbc_options, read_spend_report
from clickpulse.streaming.clicks import start_page_stats, start_page_visits
from clickpulse.streaming.spend import read_spend_table, start_spend_report
from clickpulse.streaming.speed import start_speed_layer


WIDE_COLUMN_FORMAT = "org.apache.spark.sql.cassandra"
STREAMING_JOBS = {"speed", "visits", "stats", "spend"}
# Tables of the raw-click and page-visit sinks.
RAW_SINK_OPTIONS = ["keyspace=public", "table=click"]
VISITS_SINK_OPTIONS = ["keyspace=example", "table=clickevent"]
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
INITIAL_PARTITIONS_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
TIMESTAMP_TYPE_KEY = "spark.sql.parquet.outputTimestampType"


def _session(name: str, streaming: bool = False) -> SparkSession:
    spark = SparkSession.builder.appName(name).getOrCreate()
    # record times have no zone: read them alike wherever the cluster runs
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if not spark.sparkContext.getConf().contains(INITIAL_PARTITIONS_KEY):
        # a large shuffle starts with about three partitions per core, so no
        # reducer gets more than its share; AQE merges small ones back up to
        # its advisory size, so a tiny aggregate still ends in a few tasks
        spark.conf.set(INITIAL_PARTITIONS_KEY, str(max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                                       3 * spark.sparkContext.defaultParallelism)))
    if not spark.sparkContext.getConf().contains(TIMESTAMP_TYPE_KEY):
        # Parquet timestamps with min/max statistics (legacy INT96 has none):
        # the check job's filter on window times then skips old row groups
        spark.conf.set(TIMESTAMP_TYPE_KEY, "TIMESTAMP_MICROS")
    if streaming and not spark.conf.get("spark.sql.streaming.stateStore.providerClass", None):
        # window state off the JVM heap; a new checkpoint records the choice
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return spark


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickpulse")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("speed", help="Kafka clicks -> raw table + window counts")
    s.add_argument("--topic", default=DEFAULT_TOPIC)
    s.add_argument("--bootstrap", default="localhost:29092")
    s.add_argument("--speed-path", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--window-seconds", type=int, default=DEFAULT_WINDOW_SECONDS)
    s.add_argument("--watermark-seconds", type=int, default=DEFAULT_WATERMARK_SECONDS)
    s.add_argument("--mode", choices=["partials", "final", "update"], default="partials")
    s.add_argument("--partials-path", help="final mode: counts per micro-batch, which late rows are corrected from")
    s.add_argument("--raw-identity", action="store_true",
                   help="raw rows carry topic, partition and offset; a retried batch appends nothing twice")
    s.add_argument("--time-pattern", default=CLICK_TIME_PATTERN)
    s.add_argument("--raw-format", help="default: Parquet with --raw-path, else the wide-column connector")
    s.add_argument("--raw-option", action="append",
                   help="key=value option of the raw sink (repeatable; default keyspace=public, table=click)")
    s.add_argument("--raw-path")
    s.add_argument("--max-speed-files", type=int)

    b = sub.add_parser("batch", help="speed view -> all-time report partitioned by date")
    b.add_argument("--speed-path", required=True)
    b.add_argument("--report-path", required=True)
    b.add_argument("--report-date", default=dt.date.today().isoformat())
    b.add_argument("--overwrite-mode", choices=["dynamic", "static"], default="dynamic")
    b.add_argument("--format", default="orc")
    b.add_argument("--show", type=int, default=TOP_ROWS)
    b.add_argument("--incremental", action="store_true",
                   help="previous report + speed batches written since (partials layout)")

    k = sub.add_parser("compact", help="merge the folders of finished micro-batches of the speed view")
    k.add_argument("--speed-path", required=True)
    k.add_argument("--keep-batches", type=int, default=KEEP_BATCHES)

    c = sub.add_parser("check", help="print the read-back views of both layers")
    c.add_argument("--speed-path", required=True)
    c.add_argument("--report-path", required=True)
    c.add_argument("--report-date", required=True)
    c.add_argument("--rows", type=int, default=TOP_ROWS)
    c.add_argument("--as-stored", action="store_true",
                   help="speed view rows as stored, one per micro-batch (no re-aggregation)")

    v = sub.add_parser("visits", help="Kafka clicks -> (timestamp, page) table")
    v.add_argument("--input-topic", default=DEFAULT_TOPIC)
    v.add_argument("--bootstrap.servers", dest="bootstrap", default="localhost:9092")
    v.add_argument("--group-id", default=VISITS_GROUP_ID)
    v.add_argument("--checkpoint", required=True)
    v.add_argument("--format", help="default: Parquet with --path, else the wide-column connector")
    v.add_argument("--option", action="append",
                   help="key=value option of the visits sink (repeatable; default keyspace=example, table=clickevent)")
    v.add_argument("--path")
    v.add_argument("--time-pattern", default=CLICK_TIME_PATTERN)

    st = sub.add_parser("stats", help="Kafka clicks -> 15 s page statistics as JSON")
    st.add_argument("--input-topic", default=DEFAULT_TOPIC)
    st.add_argument("--output-topic", default="output")
    st.add_argument("--bootstrap.servers", dest="bootstrap", default="localhost:9092")
    st.add_argument("--group-id", default=DEFAULT_GROUP_ID)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--path", help="Parquet files instead of the output topic")
    st.add_argument("--time-pattern", default=CLICK_TIME_PATTERN)
    st.add_argument("--processing-time", action="store_true",
                    help="window on the micro-batch time instead of the event time")

    sp = sub.add_parser("spend", help="transactions topic -> spend_report table")
    sp.add_argument("--topic", default="transactions")
    sp.add_argument("--bootstrap", default="localhost:9092")
    sp.add_argument("--checkpoint", required=True)
    sp.add_argument("--jdbc-url")
    sp.add_argument("--jdbc-user")
    sp.add_argument("--jdbc-password")
    sp.add_argument("--path", help="file table instead of JDBC")
    sp.add_argument("--policy", choices=["last", "error"],
                    help="default: last for files, error over JDBC (an insert cannot replace a row)")

    x = sub.add_parser("correct", help="add late rows to the windows that the final mode has emitted")
    x.add_argument("--speed-path", required=True)
    x.add_argument("--partials-path", required=True)

    m = sub.add_parser("merge", help="merge the micro-batch folders of the spend file table by key range")
    m.add_argument("--path", required=True)
    m.add_argument("--keep-batches", type=int, default=KEEP_MERGED_BATCHES)
    m.add_argument("--policy", choices=["last", "error"], default="last")

    d = sub.add_parser("dashboard", help="spend per account from the spend_report table (the dashboard query)")
    d.add_argument("--jdbc-url")
    d.add_argument("--jdbc-user")
    d.add_argument("--jdbc-password")
    d.add_argument("--partitions", type=int, help="split the JDBC read into this many log_ts ranges")
    d.add_argument("--path", help="file table written by the spend job instead of JDBC")
    d.add_argument("--policy", choices=["last", "error"], default="last")

    for streaming in (s, v, st, sp):
        streaming.add_argument("--source-path",
                               help="replay Kafka-shaped records from Parquet files instead of the topic")
        streaming.add_argument("--max-files-per-trigger", type=int)
        streaming.add_argument("--trigger-seconds", type=int, default=DEFAULT_TRIGGER_SECONDS)
        streaming.add_argument("--starting-offsets", help="default: latest, with --available-now earliest")
        streaming.add_argument("--max-offsets-per-trigger", type=int)
        streaming.add_argument("--min-partitions", type=int)
        streaming.add_argument("--available-now", action="store_true",
                               help="process what is there, then stop")
    return p


def _source(spark: SparkSession, a, topic: str, group_id: str | None = None):
    if a.source_path:
        return read_record_files(spark, a.source_path, a.max_files_per_trigger)
    return read_kafka(spark, a.bootstrap, topic, group_id=group_id,
                      starting_offsets=starting_offsets(a.starting_offsets, a.available_now),
                      max_offsets_per_trigger=a.max_offsets_per_trigger, min_partitions=a.min_partitions)


def _format(asked: str | None, path: str | None) -> str:
    return asked or ("parquet" if path else WIDE_COLUMN_FORMAT)


def _wait(spark: SparkSession, queries, available_now: bool) -> None:
    if available_now:
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def _options(pairs: list[str]) -> dict:
    return dict(p.split("=", 1) for p in pairs)


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = _session(f"clickpulse-{a.job}", a.job in STREAMING_JOBS)
    if a.job == "speed":
        cfg = LayerConfig(topic=a.topic, kafka_bootstrap_servers=a.bootstrap, speed_path=a.speed_path,
                          streaming_checkpoint=a.checkpoint, window_seconds=a.window_seconds,
                          watermark_seconds=a.watermark_seconds, trigger_seconds=a.trigger_seconds,
                          time_pattern=a.time_pattern, speed_mode=a.mode,
                          raw_format=_format(a.raw_format, a.raw_path),
                          raw_options={} if a.raw_path else _options(a.raw_option or RAW_SINK_OPTIONS),
                          raw_path=a.raw_path, raw_identity=a.raw_identity, partials_path=a.partials_path,
                          max_speed_files=a.max_speed_files)
        src = _source(spark, a, a.topic)
        _wait(spark, start_speed_layer(src, cfg, a.checkpoint, available_now=a.available_now), a.available_now)
    elif a.job == "batch":
        out = run_batch_layer(spark, a.speed_path, a.report_path, a.report_date, a.overwrite_mode, a.format,
                              incremental=a.incremental)
        preview(top_report(out, a.show), a.show)
    elif a.job == "compact":
        compact_speed(spark, a.speed_path, a.keep_batches)
    elif a.job == "correct":
        correct_final(spark, a.speed_path, a.partials_path)
    elif a.job == "merge":
        merge_batches(spark, a.path, a.policy, a.keep_batches)
    elif a.job == "check":
        preview(report_view(spark, a.report_path, a.report_date, a.rows), a.rows)
        preview(speed_view(spark, a.speed_path, a.rows, reaggregate=not a.as_stored), a.rows)
    elif a.job == "visits":
        src = _source(spark, a, a.input_topic, group_id=a.group_id)
        q = start_page_visits(src, a.checkpoint, fmt=_format(a.format, a.path), path=a.path,
                              trigger_seconds=a.trigger_seconds,
                              options=_options(a.option or VISITS_SINK_OPTIONS),
                              pattern=a.time_pattern, available_now=a.available_now)
        _wait(spark, [q], a.available_now)
    elif a.job == "stats":
        src = _source(spark, a, a.input_topic, group_id=a.group_id)
        q = start_page_stats(src, a.checkpoint, bootstrap_servers=a.bootstrap, topic=a.output_topic,
                             path=a.path, trigger_seconds=a.trigger_seconds, available_now=a.available_now,
                             processing_time=a.processing_time, pattern=a.time_pattern)
        _wait(spark, [q], a.available_now)
    elif a.job == "spend":
        src = _source(spark, a, a.topic)
        if a.path:
            q = start_spend_report(src, a.checkpoint, fmt="parquet", path=a.path, policy=a.policy or "last",
                                   trigger_seconds=a.trigger_seconds, available_now=a.available_now)
        else:
            q = start_spend_report(src, a.checkpoint, fmt="jdbc", policy=a.policy or "error",
                                   trigger_seconds=a.trigger_seconds, available_now=a.available_now,
                                   options=jdbc_options(a.jdbc_url, user=a.jdbc_user, password=a.jdbc_password))
        _wait(spark, [q], a.available_now)
    elif a.job == "dashboard":
        if a.path:
            table = read_spend_table(spark, a.path, policy=a.policy)
        else:
            table = read_spend_report(spark, options=jdbc_options(a.jdbc_url, user=a.jdbc_user,
                                                                  password=a.jdbc_password),
                                      num_partitions=a.partitions)
        preview(spend_by_account(table, with_time=True).orderBy("metric"))


if __name__ == "__main__":
    main()
