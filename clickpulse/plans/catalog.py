"""Query catalogue: every operator of the click, report and spend jobs run on
the stored ``events`` table, each with an equivalent DuckDB SQL text.

Inputs are replayed through the wire form (JSON / CSV records, then the real
decoders), so the parse path is always exercised. The SQL works from the
table's columns directly. Streaming queries stage the replayed records as
files in the shared folder, one for each ``RECORDS_PER_TRIGGER`` records, run
the real streaming job with ``availableNow``, remove the staged input and the
checkpoint, and return what the job wrote. Queries over the stored speed view
share one, written by the real speed layer once per session and table, in
micro-batches of ``RECORDS_PER_STORED_BATCH`` records; a trigger takes as many of
them as ``RECORDS_PER_TRIGGER`` records are and stores each on its own.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.config import (
    ACCOUNTS,
    CLICK_TIME_PATTERN,
    CLICK_TIME_PATTERN_12H,
    DEFAULT_TOPIC,
    DEFAULT_WATERMARK_SECONDS,
    DEFAULT_WINDOW_SECONDS,
    FIRST_USER_ID,
    OUT_OF_ORDERNESS_MS,
    PAGE_STATS_WINDOW_SECONDS,
    TRAFFIC_SOURCES,
    LayerConfig,
)
from clickpulse.functions.columns import flatten_window
from clickpulse.functions.decode import parse_clicks, parse_clicks_strict, parse_transactions
from clickpulse.functions.encode import click_json, page_stats_json
from clickpulse.operators.ordering import latest_windows, top_report
from clickpulse.operators.spend import dedupe_spend, spend_by_account
from clickpulse.operators.totals import all_time_totals, with_report_date
from clickpulse.operators.visits import page_visits
from clickpulse.operators.windows import SPEED_KEYS, page_stats, reaggregate_speed, window_counts
from clickpulse.plans.batch import build_report, run_batch_layer
from clickpulse.plans.check import speed_view
from clickpulse.plans.corrections import correct_final, corrected_counts
from clickpulse.plans.keyed import merge_batches
from clickpulse.plans.speed import land_raw, speed_batch_writer
from clickpulse.session import fresh_dir, materialize
from clickpulse.sources.kafka import read_record_files
from clickpulse.sources.replay import (
    click_records,
    event_time,
    read_events,
    stage_micro_batches,
    traffic_source,
    transaction_records,
)
from clickpulse.sources.sinks import RECORD_KEY, write_report, write_speed_batch
from clickpulse.sources.storage import files_below, remove_folder
from clickpulse.sources.tables import read_report, read_speed_view
from clickpulse.streaming.clicks import start_page_stats, start_page_stats_view, start_page_visits
from clickpulse.streaming.progress import RateLog
from clickpulse.streaming.spend import read_spend_table, start_spend_report
from clickpulse.streaming.speed import start_speed_layer
from clickpulse.streaming.triggers import RunTag
from clickpulse.streaming.updates import read_update_view

# Fixed query parameters.
# Offsets per trigger of a replayed stream: as much as a trigger would take from a
# topic, so the number of micro-batches grows with the table. A parameter, as the
# Kafka source's maxOffsetsPerTrigger; tests set it low to get many micro-batches.
RECORDS_PER_TRIGGER = int(os.environ.get("CLICKPULSE_RECORDS_PER_TRIGGER", 1_000_000))
# Offsets per micro-batch where rows or files of each one are returned (the stored
# speed view, the file cap): the size is part of those queries' results and SQL, so a
# larger trigger does not raise it: the trigger stores several.
RECORDS_PER_STORED_BATCH = min(int(os.environ.get("CLICKPULSE_RECORDS_PER_TRIGGER", 5000)), 5000)
FILES_PER_TRIGGER = 8  # splits of such a trigger, each of whole micro-batches
LATE_EVERY = 97  # every so many records of the watermark queries arrive last
HOUR_WINDOW_SECONDS = 3600
REPORT_DATE = "2022-08-27"
PREVIOUS_REPORT_DATE = "2022-08-26"
REPORT_TOP_N = 10  # the replay has 20 (page, source) groups; 10 makes the cut bite


@dataclass(frozen=True)
class CatalogQuery:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


# --------------------------------------------------------------------- inputs

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, sf_dir)


def _clicks(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return parse_clicks(click_records(_events(spark, sf_dir)), CLICK_TIME_PATTERN, keep=keep)


def _strict_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_clicks_strict(click_records(_events(spark, sf_dir)), CLICK_TIME_PATTERN)


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored speed view: one row per (micro-batch, window, page, source)."""
    view = read_speed_view(spark, _stored_view(spark, sf_dir))
    return view.select(F.col("batch_id").cast("long").alias("batch_id"), "window", *SPEED_KEYS, "count")


_STORED: dict[tuple, tuple] = {}


def _stored_view(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the speed view of a table, written by the speed layer with its
    sink and completion markers. It is kept for the session as long as the
    table's files stay the same (names, lengths, times of all of them); a view
    of files that changed is removed and written anew."""
    files = tuple(files_below(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    table = (spark.sparkContext.applicationId, sf_dir)
    if _STORED.get(table, (None,))[0] != files:
        forget_stored_view(spark, sf_dir)
        cfg = _run_partials_stream(spark, sf_dir, land=False, stored=RECORDS_PER_STORED_BATCH)
        _STORED[table] = (files, cfg.speed_path)
    return _STORED[table][1]


def forget_stored_view(spark: SparkSession, sf_dir: str) -> None:
    """Remove the kept view of a table; the next query writes it again."""
    old = _STORED.pop((spark.sparkContext.applicationId, sf_dir), None)
    if old is not None:
        remove_folder(spark, old[1])


def _spend_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = parse_transactions(transaction_records(_events(spark, sf_dir)), keep=("offset",))
    return dedupe_spend(tx, policy="last", order_col="offset")


def _per_trigger() -> F.Column:
    return F.expr(f"offset div {RECORDS_PER_TRIGGER}")


def _files_of_batches(stored: int) -> tuple[F.Column, int]:
    """Staged files of whole micro-batches of ``stored`` offsets, and how many of
    them a trigger takes: RECORDS_PER_TRIGGER offsets, but one file at least."""
    size = stored * max(1, RECORDS_PER_TRIGGER // (FILES_PER_TRIGGER * stored))
    return F.expr(f"offset div {size}"), max(1, RECORDS_PER_TRIGGER // size)


def _late() -> F.Column:
    return F.col("offset") % LATE_EVERY == 0


def _replay(spark: SparkSession, records: DataFrame, name: str, batch: F.Column,
            start: Callable[[DataFrame, str], list], files_per_trigger: int = 1) -> None:
    """Stage the records as files by ``batch``, run the queries that ``start``
    makes from (source, checkpoint) to their end, so many files a trigger, and
    remove input and checkpoint."""
    stage, checkpoint = fresh_dir(spark, f"{name}-input"), fresh_dir(spark, f"{name}-checkpoint")
    files = stage_micro_batches(records, batch, stage)
    _await(start(read_record_files(spark, files, max_files_per_trigger=files_per_trigger), checkpoint))
    for path in (stage, checkpoint):
        remove_folder(spark, path)


def _await(queries: list) -> None:
    """Wait for every query; when one fails, the others are stopped."""
    try:
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


# -------------------------------------------------------------- batch queries

def raw_clicks(spark, sf_dir):
    return _clicks(spark, sf_dir)


def permissive_parse(spark, sf_dir):
    """Malformed records must become nulls, never errors.

    ``error`` events arrive without their closing brace (all five fields
    null); ``signup`` events carry an ISO time (only the time is null).
    """
    events = _events(spark, sf_dir)

    def corrupt(text):
        iso = click_json(event_time(F.col("ts")), F.concat(F.lit("/"), F.col("event_type")),
                         F.lit(FIRST_USER_ID) + F.col("user_id"), F.floor(F.col("value")),
                         traffic_source(F.col("user_id")), "yyyy-MM-dd HH:mm:ss.SSS")
        return (F.when(F.col("event_type") == "error", F.regexp_replace(text, r"\}$", ""))
                .when(F.col("event_type") == "signup", iso)
                .otherwise(text))

    records = click_records(events, value_override=corrupt)
    return parse_clicks(records, CLICK_TIME_PATTERN, keep=("offset",)).withColumnRenamed("offset", "event_id")


def speed_window_counts(spark, sf_dir):
    return flatten_window(window_counts(_clicks(spark, sf_dir), DEFAULT_WINDOW_SECONDS))


def speed_window_counts_1h(spark, sf_dir):
    return flatten_window(window_counts(_clicks(spark, sf_dir), HOUR_WINDOW_SECONDS))


def speed_partials(spark, sf_dir):
    return flatten_window(_partials(spark, sf_dir))


def latest_windows_q(spark, sf_dir):
    return latest_windows(reaggregate_speed(_partials(spark, sf_dir)), 30)


def latest_partials(spark, sf_dir):
    """The newest stored speed-view rows as they are, one per micro-batch."""
    return latest_windows(_partials(spark, sf_dir), 30)


def check_speed_view(spark, sf_dir):
    """The check job on a stored speed view: only the rows of the newest
    windows are read back and summed (filter pushed into the scan)."""
    return speed_view(spark, _stored_view(spark, sf_dir), 30)


def check_stored_rows(spark, sf_dir):
    """The check job's view of the stored rows as they are (one per
    micro-batch and window), newest first; only the newest windows are read."""
    rows = speed_view(spark, _stored_view(spark, sf_dir), 30, reaggregate=False)
    return rows.withColumn("batch_id", F.col("batch_id").cast("long")).drop("run")


def all_time_totals_q(spark, sf_dir):
    return all_time_totals(_partials(spark, sf_dir))


def batch_report(spark, sf_dir):
    base = fresh_dir(spark, "report")
    write_report(build_report(_partials(spark, sf_dir), REPORT_DATE), base, overwrite_mode="dynamic")
    return read_report(spark, base, REPORT_DATE)


def report_top(spark, sf_dir):
    return top_report(batch_report(spark, sf_dir), REPORT_TOP_N)


def _two_reports(spark, sf_dir, mode: str) -> DataFrame:
    """Write the report for two dates, one after the other, then read all."""
    base = fresh_dir(spark, f"report-{mode}")
    # computed once (full scan), then both writes read the 20 written rows
    totals = materialize(all_time_totals(_partials(spark, sf_dir)), "totals")
    for d in (PREVIOUS_REPORT_DATE, REPORT_DATE):
        write_report(with_report_date(totals, d), base, overwrite_mode=mode)
    return read_report(spark, base)


def report_history(spark, sf_dir):
    """Dynamic overwrite: the earlier date survives the later write."""
    return _two_reports(spark, sf_dir, "dynamic")


def report_static_overwrite(spark, sf_dir):
    """Static overwrite: the later write replaces every date."""
    return _two_reports(spark, sf_dir, "static")


def speed_counts_12h_wire(spark, sf_dir):
    """Clicks written with the producer's 12-hour pattern, read by the speed
    layer's 24-hour pattern: 00:xx reads as 12:xx, 13:00-23:59 as 01-11."""
    records = click_records(_events(spark, sf_dir), CLICK_TIME_PATTERN_12H)
    return flatten_window(window_counts(parse_clicks(records, CLICK_TIME_PATTERN), DEFAULT_WINDOW_SECONDS))


def page_visits_12h_wire(spark, sf_dir):
    """Written and read with the 12-hour pattern and no AM/PM marker: every
    time folds into the first half of its day."""
    records = click_records(_events(spark, sf_dir), CLICK_TIME_PATTERN_12H)
    return page_visits(parse_clicks_strict(records, CLICK_TIME_PATTERN_12H))


def page_stats_15s(spark, sf_dir):
    return page_stats(_strict_clicks(spark, sf_dir), PAGE_STATS_WINDOW_SECONDS)


def page_stats_json_q(spark, sf_dir):
    stats = page_stats(_strict_clicks(spark, sf_dir), PAGE_STATS_WINDOW_SECONDS)
    return stats.select(page_stats_json("windowStart", "windowEnd", "page", "count").alias("value"))


def page_visits_q(spark, sf_dir):
    return page_visits(_strict_clicks(spark, sf_dir))


def spend_rows(spark, sf_dir):
    return _spend_rows(spark, sf_dir)


def spend_by_account_q(spark, sf_dir):
    return spend_by_account(_spend_rows(spark, sf_dir))


# ---------------------------------------------------------- streaming queries

def _on_time_then_late(events: DataFrame) -> F.Column:
    """Micro-batches in event order, then the last record alone, then the
    records that are late, in batches as large as the others (a batch drops by
    the watermark that the batch before the last one left, so the last record's
    batch puts it into force). A late record newer than the last one on time is
    in the last batch, so it moves the watermark for no other."""
    last = events.where(F.col("event_id") % LATE_EVERY != 0).agg(F.max("event_id")).first()[0] or 0
    after = last // RECORDS_PER_TRIGGER + 1
    late = F.lit(after + 1) + F.expr(f"offset div {LATE_EVERY * RECORDS_PER_TRIGGER}")
    return (F.when(_late(), late).when(F.col("offset") == last, F.lit(after)).otherwise(_per_trigger()))


def stream_final_counts(spark, sf_dir):
    """Watermarked window counts in append mode: closed windows only; late
    records count while their window is open."""
    events, out = _events(spark, sf_dir), fresh_dir(spark, "final-speed")
    cfg = LayerConfig(speed_path=out, speed_mode="final", window_seconds=DEFAULT_WINDOW_SECONDS,
                      watermark_seconds=DEFAULT_WATERMARK_SECONDS)
    _replay(spark, click_records(events), "final", _on_time_then_late(events),
            lambda source, checkpoint: start_speed_layer(source, cfg, checkpoint, available_now=True))
    return flatten_window(read_speed_view(spark, out))


def _run_partials_stream(spark, sf_dir, land: bool = True, max_files: int | None = None,
                         stored: int | None = None) -> LayerConfig:
    """The partials job over the replayed clicks. A trigger is one micro-batch, or
    with ``stored`` holds several of so many offsets, each stored on its own."""
    cfg = LayerConfig(speed_path=fresh_dir(spark, "speed-view"), raw_path=fresh_dir(spark, "raw-clicks") if land else None,
                      speed_mode="partials", max_speed_files=max_files, batch_offsets=stored)
    batch, files = _files_of_batches(stored) if stored else (_per_trigger(), 1)
    _replay(spark, click_records(_events(spark, sf_dir)), "speed", batch,
            lambda source, checkpoint: start_speed_layer(source, cfg, checkpoint, available_now=True), files)
    return cfg


def speed_stream_windows(spark, sf_dir):
    cfg = _run_partials_stream(spark, sf_dir)
    return flatten_window(reaggregate_speed(read_speed_view(spark, cfg.speed_path)))


def speed_stream_totals(spark, sf_dir):
    cfg = _run_partials_stream(spark, sf_dir)
    return run_batch_layer(spark, cfg.speed_path, fresh_dir(spark, "stream-report"), REPORT_DATE) \
        .drop("report_date")


def speed_files_capped(spark, sf_dir):
    """Files of each micro-batch's window counts under a cap of one, with
    shuffle partitions that would otherwise each leave a file."""
    own = spark.newSession()  # the setting is no other query's
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    cfg = _run_partials_stream(own, sf_dir, land=False, max_files=1, stored=RECORDS_PER_STORED_BATCH)
    rows = spark.read.parquet(cfg.speed_path).select("batch_id", "count", F.input_file_name().alias("file"))
    return rows.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.countDistinct("file").alias("files"), F.sum("count").alias("clicks"))


def report_incremental(spark, sf_dir):
    """Three reports while the stream goes on: incremental and then full for
    one date over the first half of the records, incremental for the next date
    over all. Each date is read on its own."""
    events = _events(spark, sf_dir)
    half = events.count() // 2
    stage, checkpoint, base = (fresh_dir(spark, f"incremental-{n}") for n in ("input", "checkpoint", "report"))
    cfg = LayerConfig(speed_path=fresh_dir(spark, "incremental-view"), speed_mode="partials")

    def run(part: DataFrame, name: str) -> None:
        stage_micro_batches(click_records(part), _per_trigger(), f"{stage}/{name}")
        source = read_record_files(spark, f"{stage}/*/*", max_files_per_trigger=1)
        _await(start_speed_layer(source, cfg, checkpoint, available_now=True))

    run(events.where(F.col("event_id") < half), "first")
    run_batch_layer(spark, cfg.speed_path, base, PREVIOUS_REPORT_DATE, incremental=True)
    run_batch_layer(spark, cfg.speed_path, base, PREVIOUS_REPORT_DATE)
    run(events.where(F.col("event_id") >= half), "second")
    run_batch_layer(spark, cfg.speed_path, base, REPORT_DATE, incremental=True)
    for path in (stage, checkpoint):
        remove_folder(spark, path)
    return read_report(spark, base, PREVIOUS_REPORT_DATE).unionByName(read_report(spark, base, REPORT_DATE))


def _run_restarted(spark, sf_dir, cfg: LayerConfig) -> None:
    """The partials job, stopped in a micro-batch that has landed its raw rows
    and about half of its counts but no marker, then started again from its
    checkpoint and run to the end."""
    events = _events(spark, sf_dir)
    stage, checkpoint = fresh_dir(spark, "restart-input"), fresh_dir(spark, "restart-checkpoint")
    files = stage_micro_batches(click_records(events), _per_trigger(), stage)
    stop_at = min(1, (events.agg(F.max("event_id")).first()[0] or 0) // RECORDS_PER_TRIGGER)
    tag = RunTag()
    whole = speed_batch_writer(cfg, tag=tag)

    def stops(batch: DataFrame, batch_id: int) -> None:
        if batch_id < stop_at:
            return whole(batch, batch_id)
        land_raw(batch, batch_id, cfg, tag.get())
        some = window_counts(batch, cfg.window_seconds).where(F.pmod(F.hash("page"), F.lit(2)) == 0)
        write_speed_batch(some, cfg.speed_path, batch_id, run=tag.get())
        raise InterruptedError("stopped half-way")

    clicks = parse_clicks(read_record_files(spark, files, max_files_per_trigger=1), cfg.time_pattern,
                          keep=RECORD_KEY if cfg.raw_identity else ())
    broken = tag.bind(clicks.writeStream.foreachBatch(stops).option("checkpointLocation", f"{checkpoint}/speed")
                      .trigger(availableNow=True).start())
    try:
        broken.awaitTermination()
    except StreamingQueryException as e:
        if "stopped half-way" not in str(e):
            raise
    _await(start_speed_layer(read_record_files(spark, files, max_files_per_trigger=1), cfg, checkpoint, available_now=True))
    for path in (stage, checkpoint):
        remove_folder(spark, path)


def speed_restarted(spark, sf_dir):
    """Totals of the speed view and raw rows after a restart: once each."""
    cfg = LayerConfig(speed_path=fresh_dir(spark, "restart-view"), raw_path=fresh_dir(spark, "restart-raw"))
    _run_restarted(spark, sf_dir, cfg)
    none = F.lit(0).cast("long")
    totals = all_time_totals(read_speed_view(spark, cfg.speed_path)).withColumn("raw_rows", none)
    raw = spark.read.parquet(cfg.raw_path).groupBy(*SPEED_KEYS).agg(F.count(F.lit(1)).alias("raw_rows"))
    both = totals.unionByName(raw.withColumn("sum_count", none))
    return both.groupBy(*SPEED_KEYS).agg(F.sum("sum_count").alias("sum_count"), F.sum("raw_rows").alias("raw_rows"))


# Spark's other name of its Parquet source: taken for a connector, which is given appends
APPENDED_FORMAT = "org.apache.spark.sql.parquet"


def raw_landing_restarted(spark, sf_dir):
    """Raw rows of a table that only takes appends, after a restart: the batch
    that is written again adds nothing twice."""
    cfg = LayerConfig(speed_path=fresh_dir(spark, "identity-view"), raw_path=fresh_dir(spark, "identity-raw"),
                      raw_format=APPENDED_FORMAT, raw_identity=True)
    _run_restarted(spark, sf_dir, cfg)
    return spark.read.parquet(cfg.raw_path)


def stream_final_corrected(spark, sf_dir):
    """Final counts, corrected once before the late records come and once
    after: all records of every window that was emitted."""
    events, out = _events(spark, sf_dir), fresh_dir(spark, "corrected")
    stage, checkpoint = fresh_dir(spark, "corrected-input"), fresh_dir(spark, "corrected-checkpoint")
    cfg = LayerConfig(speed_path=f"{out}/final", partials_path=f"{out}/partials", speed_mode="final")
    for name, part in (("on-time", ~_late()), ("late", _late())):
        stage_micro_batches(click_records(events).where(part), _per_trigger(), f"{stage}/{name}")
        source = read_record_files(spark, f"{stage}/*/*", max_files_per_trigger=1)
        _await(start_speed_layer(source, cfg, checkpoint, available_now=True))
        correct_final(spark, cfg.speed_path, cfg.partials_path)
    for path in (stage, checkpoint):
        remove_folder(spark, path)
    return flatten_window(corrected_counts(spark, cfg.speed_path))


def speed_update_counts(spark, sf_dir):
    """Window counts in update mode: the newest micro-batch of a window counts."""
    cfg = LayerConfig(speed_path=fresh_dir(spark, "update-view"), speed_mode="update")
    _replay(spark, click_records(_events(spark, sf_dir)), "update", _per_trigger(),
            lambda source, checkpoint: start_speed_layer(source, cfg, checkpoint, available_now=True))
    return flatten_window(read_update_view(spark, cfg.speed_path, ("window", *SPEED_KEYS)))


def page_stats_processing_time(spark, sf_dir):
    """Statistics by the time that each micro-batch recorded; which windows
    there are depends on when the query runs, their sums by page do not."""
    out = fresh_dir(spark, "processing-stats")
    _replay(spark, click_records(_events(spark, sf_dir)), "processing", _per_trigger(),
            lambda source, checkpoint: [start_page_stats_view(source, out, checkpoint, processing_time=True, available_now=True)])
    view = read_update_view(spark, out, ("windowStart", "windowEnd", "page"))
    return view.groupBy("page").agg(F.sum("count").alias("count"))


def speed_triggered_totals(spark, sf_dir):
    """The running job under its trigger, stopped once all is processed, with
    the records that its progress events report."""
    cfg = LayerConfig(speed_path=fresh_dir(spark, "triggered-view"))
    stage, checkpoint = fresh_dir(spark, "triggered-input"), fresh_dir(spark, "triggered-checkpoint")
    files = stage_micro_batches(click_records(_events(spark, sf_dir)), _per_trigger(), stage)
    log = RateLog().attach(spark)
    try:
        [query] = start_speed_layer(read_record_files(spark, files), cfg, checkpoint)
        try:
            query.processAllAvailable()
            records = log.wait(query)
        finally:
            query.stop()
    finally:
        log.detach(spark)
    for path in (stage, checkpoint):
        remove_folder(spark, path)
    return all_time_totals(read_speed_view(spark, cfg.speed_path)).withColumn("records", F.lit(records).cast("long"))


def raw_landing(spark, sf_dir):
    cfg = _run_partials_stream(spark, sf_dir)
    return spark.read.parquet(cfg.raw_path).drop("run", "batch_id")


def page_visits_stream(spark, sf_dir):
    out = fresh_dir(spark, "visits")
    _replay(spark, click_records(_events(spark, sf_dir)), "visits", _per_trigger(),
            lambda source, checkpoint: [start_page_visits(source, checkpoint, fmt="parquet", path=out, available_now=True)])
    return spark.read.parquet(out).drop("run", "batch_id")


def page_stats_stream(spark, sf_dir):
    """Closed 15 s windows; late records count while their window is open."""
    events, out = _events(spark, sf_dir), fresh_dir(spark, "stats")
    _replay(spark, click_records(events), "stats", _on_time_then_late(events),
            lambda source, checkpoint: [start_page_stats(source, checkpoint, path=out, available_now=True)])
    return spark.read.parquet(out).select(F.col("value").cast("string").alias("value"))


def _spend_stream(spark, records: DataFrame, policy: str) -> DataFrame:
    out = fresh_dir(spark, f"spend-{policy}")
    _replay(spark, records, f"spend-{policy}", _per_trigger(),
            lambda source, checkpoint: [start_spend_report(source, checkpoint, fmt="parquet", path=out, policy=policy,
                                                           available_now=True)])
    return read_spend_table(spark, out)


def spend_stream_report(spark, sf_dir):
    return _spend_stream(spark, transaction_records(_events(spark, sf_dir)), "last")


def spend_stream_report_error(spark, sf_dir):
    """No two records of a key: written under policy ``error``, read with the
    reader's default."""
    return _spend_stream(spark, _single_transactions(_events(spark, sf_dir)), "error")


def _single_transactions(events: DataFrame) -> DataFrame:
    """Each event as the only transaction of an account of its own."""
    return transaction_records(events, account=F.col("event_id"))


REWRITES = 3  # times that the spend table's records come, each time of fewer accounts


def spend_merged(spark, sf_dir):
    """Keys written again over three merges: every account, then all but the
    last, then all but the last two, each time with other amounts. The newest
    batch of each time stays unmerged until the next."""
    events, out = _events(spark, sf_dir), fresh_dir(spark, "spend-merged")
    stage, checkpoint = fresh_dir(spark, "merged-input"), fresh_dir(spark, "merged-checkpoint")
    total = events.agg(F.max("event_id")).first()[0] + 1
    for time in range(REWRITES):
        part = events.withColumn("value", F.col("value") + time).where(
            F.pmod(F.col("user_id"), F.lit(ACCOUNTS)) < ACCOUNTS - time).withColumn("event_id", F.col("event_id") + time * total)
        stage_micro_batches(transaction_records(part), _per_trigger(), f"{stage}/{time}")
        source = read_record_files(spark, f"{stage}/*/*", max_files_per_trigger=1)
        _await([start_spend_report(source, checkpoint, fmt="parquet", path=out, available_now=True)])
        merge_batches(spark, out)
    for path in (stage, checkpoint):
        remove_folder(spark, path)
    return read_spend_table(spark, out)


def spend_bands(spark, sf_dir):
    """Accounts below and above the band limit."""
    tx = parse_transactions(_single_transactions(_events(spark, sf_dir)), keep=("offset",))
    return spend_by_account(dedupe_spend(tx, policy="last", order_col="offset"))


def speed_counts_odd_records(spark, sf_dir):
    """Records whose time is null or unreadable leave the window counts; a
    null page is a group of its own."""
    def odd(text):
        return (F.when(F.col("event_type") == "error", F.regexp_replace(text, r"\}$", ""))
                .when(F.col("event_type") == "signup", F.regexp_replace(text, '"timestamp":"[^"]*",', ""))
                .when(F.col("event_type") == "view", F.regexp_replace(text, '"page":"[^"]*",', ""))
                .otherwise(text))

    records = click_records(_events(spark, sf_dir), value_override=odd)
    return flatten_window(window_counts(parse_clicks(records, CLICK_TIME_PATTERN), HOUR_WINDOW_SECONDS))


# ------------------------------------------------------------------ oracle SQL

_N_SOURCES = len(TRAFFIC_SOURCES)
_SOURCE_CASE = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(TRAFFIC_SOURCES))
_TS_MS = "date_trunc('milliseconds', ts)"
# 12-hour text read back: with the 24-hour pattern the clock hour 12 stays
# 12 and 13-23 lose 12 hours; with the 12-hour pattern every time is AM.
_HH_OF_HH12 = f"{_TS_MS} + to_hours(CASE WHEN hour(ts) = 0 THEN 12 WHEN hour(ts) > 12 THEN -12 ELSE 0 END)"
_AM_FOLD = f"{_TS_MS} - to_hours(CASE WHEN hour(ts) >= 12 THEN 12 ELSE 0 END)"


def _clicks_cte(time_expr: str = _TS_MS) -> str:
    return f"""clicks AS (
  SELECT event_id AS "offset", event_type,
         {time_expr} AS "timestamp",
         '/' || event_type AS page,
         CAST({FIRST_USER_ID} + user_id AS VARCHAR) AS userId,
         CAST(CAST(floor("value") AS BIGINT) AS VARCHAR) AS duration,
         CASE ((user_id % {_N_SOURCES}) + {_N_SOURCES}) % {_N_SOURCES} {_SOURCE_CASE} END AS trafficSource
  FROM events)"""


_CLICKS_CTE = _clicks_cte()


def _bucket(seconds: int, col: str = '"timestamp"') -> str:
    return f"time_bucket(INTERVAL '{seconds} seconds', {col}, TIMESTAMP '1970-01-01 00:00:00')"


def _window_counts_sql(seconds: int, extra: str = "") -> str:
    return f"""SELECT {extra}{_bucket(seconds)} AS window_start,
       {_bucket(seconds)} + INTERVAL '{seconds} seconds' AS window_end,
       page, trafficSource, count(*) AS "count"
FROM clicks WHERE "timestamp" IS NOT NULL
GROUP BY ALL"""


def _stats_sql(seconds: int) -> str:
    return f"""SELECT {_bucket(seconds)} AS windowStart,
       {_bucket(seconds)} + INTERVAL '{seconds} seconds' AS windowEnd,
       page, count(*) AS "count"
FROM clicks WHERE "timestamp" IS NOT NULL
GROUP BY ALL"""


_BATCH_SQL = f'"offset" // {RECORDS_PER_STORED_BATCH} AS batch_id, '

_TOTALS_SQL = f"""WITH {_CLICKS_CTE}
SELECT page, trafficSource, CAST(count(*) AS BIGINT) AS sum_count
FROM clicks WHERE "timestamp" IS NOT NULL GROUP BY ALL"""

_RAW_SQL = f"""WITH {_CLICKS_CTE}
SELECT "timestamp", page, userId, duration, trafficSource FROM clicks"""

_SPEED_SQL = f"WITH {_CLICKS_CTE}\n{_window_counts_sql(DEFAULT_WINDOW_SECONDS)}"

_SPEND_CTE = f"""tx AS (
  SELECT event_id AS "offset", ((user_id % {ACCOUNTS}) + {ACCOUNTS}) % {ACCOUNTS} + 1 AS account_id,
         CAST(floor("value") AS BIGINT) AS amount, date_trunc('second', ts) AS log_ts
  FROM events),
spend AS (
  SELECT account_id, log_ts, arg_max(amount, "offset") AS amount FROM tx GROUP BY account_id, log_ts)"""

_SPEND_ROWS_SQL = f"WITH {_SPEND_CTE}\nSELECT account_id, log_ts, amount FROM spend"

_VISITS_SQL = f'WITH {_CLICKS_CTE}\nSELECT "timestamp", page FROM clicks'


def _in_time_cte(seconds: int, delay_ms: int) -> str:
    """Without the late records whose window the on-time ones (but the last,
    which comes in a batch of its own) have closed."""
    return f"""on_time AS (SELECT * FROM all_clicks WHERE "offset" % {LATE_EVERY} <> 0),
clicks AS (
  SELECT * FROM all_clicks WHERE "offset" % {LATE_EVERY} <> 0
    OR {_bucket(seconds)} + INTERVAL '{seconds} seconds' > (
      SELECT max("timestamp") - INTERVAL '{delay_ms} milliseconds' FROM on_time
      WHERE "offset" < (SELECT max("offset") FROM on_time)))"""


def _stats_json_sql(filter_sql: str = "", late_ms: int | None = None) -> str:
    fmt = "'%d-%m-%Y %I:%M:%S:%g'"
    clicks = _CLICKS_CTE if late_ms is None else f"all_{_CLICKS_CTE}, {_in_time_cte(PAGE_STATS_WINDOW_SECONDS, late_ms)}"
    return f"""WITH {clicks}, stats AS ({_stats_sql(PAGE_STATS_WINDOW_SECONDS)})
SELECT '{{"windowStart":"' || strftime(windowStart, {fmt}) || '","windowEnd":"' || strftime(windowEnd, {fmt})
       || '","page":"' || page || '","count":' || CAST("count" AS VARCHAR) || '}}' AS "value"
FROM stats {filter_sql}"""


SQL = {
    "raw_clicks": _RAW_SQL,
    "permissive_parse": f"""WITH {_CLICKS_CTE}
SELECT "offset" AS event_id,
       CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE "timestamp" END AS "timestamp",
       CASE WHEN event_type = 'error' THEN NULL ELSE page END AS page,
       CASE WHEN event_type = 'error' THEN NULL ELSE userId END AS userId,
       CASE WHEN event_type = 'error' THEN NULL ELSE duration END AS duration,
       CASE WHEN event_type = 'error' THEN NULL ELSE trafficSource END AS trafficSource
FROM clicks""",
    "speed_window_counts": _SPEED_SQL,
    "speed_window_counts_1h": f"WITH {_CLICKS_CTE}\n{_window_counts_sql(HOUR_WINDOW_SECONDS)}",
    "speed_partials": f"""WITH {_CLICKS_CTE}
{_window_counts_sql(DEFAULT_WINDOW_SECONDS, _BATCH_SQL)}""",
    "latest_windows": f"""WITH {_CLICKS_CTE}, counts AS ({_window_counts_sql(DEFAULT_WINDOW_SECONDS)})
SELECT * FROM counts
ORDER BY window_start DESC, window_end DESC, page NULLS FIRST, trafficSource NULLS FIRST LIMIT 30""",
    "latest_partials": f"""WITH {_CLICKS_CTE}, partials AS (
{_window_counts_sql(DEFAULT_WINDOW_SECONDS, _BATCH_SQL)})
SELECT * FROM partials
ORDER BY window_start DESC, window_end DESC, page NULLS FIRST, trafficSource NULLS FIRST, batch_id LIMIT 30""",
    "check_speed_view": f"""WITH {_CLICKS_CTE}, counts AS ({_window_counts_sql(DEFAULT_WINDOW_SECONDS)})
SELECT * FROM counts
ORDER BY window_start DESC, window_end DESC, page NULLS FIRST, trafficSource NULLS FIRST LIMIT 30""",
    "check_stored_rows": f"""WITH {_CLICKS_CTE}, partials AS (
{_window_counts_sql(DEFAULT_WINDOW_SECONDS, _BATCH_SQL)})
SELECT * FROM partials
ORDER BY window_start DESC, window_end DESC, page NULLS FIRST, trafficSource NULLS FIRST, batch_id LIMIT 30""",
    "all_time_totals": _TOTALS_SQL,
    "batch_report": f"""WITH totals AS ({_TOTALS_SQL})
SELECT page, trafficSource, sum_count, DATE '{REPORT_DATE}' AS report_date FROM totals""",
    "report_top": f"""WITH totals AS ({_TOTALS_SQL})
SELECT page, trafficSource, sum_count, DATE '{REPORT_DATE}' AS report_date FROM totals
ORDER BY sum_count DESC, page NULLS FIRST, trafficSource NULLS FIRST LIMIT {REPORT_TOP_N}""",
    "report_history": f"""WITH totals AS ({_TOTALS_SQL})
SELECT page, trafficSource, sum_count, DATE '{PREVIOUS_REPORT_DATE}' AS report_date FROM totals
UNION ALL
SELECT page, trafficSource, sum_count, DATE '{REPORT_DATE}' AS report_date FROM totals""",
    "report_static_overwrite": f"""WITH totals AS ({_TOTALS_SQL})
SELECT page, trafficSource, sum_count, DATE '{REPORT_DATE}' AS report_date FROM totals""",
    "speed_counts_12h_wire": f"WITH {_clicks_cte(_HH_OF_HH12)}\n{_window_counts_sql(DEFAULT_WINDOW_SECONDS)}",
    "page_visits_12h_wire": f'WITH {_clicks_cte(_AM_FOLD)}\nSELECT "timestamp", page FROM clicks',
    "page_stats_15s": f"WITH {_CLICKS_CTE}\n{_stats_sql(PAGE_STATS_WINDOW_SECONDS)}",
    "page_stats_json": _stats_json_sql(),
    "page_visits": _VISITS_SQL,
    "spend_rows": _SPEND_ROWS_SQL,
    "spend_by_account": f"""WITH {_SPEND_CTE}
SELECT CAST(account_id AS VARCHAR) AS metric, CAST(sum(amount) AS BIGINT) AS "value",
       CASE WHEN sum(amount) >= 80 THEN 'red' ELSE 'green' END AS band
FROM spend GROUP BY account_id""",
    "stream_final_counts": f"""WITH all_{_CLICKS_CTE}, {_in_time_cte(DEFAULT_WINDOW_SECONDS, DEFAULT_WATERMARK_SECONDS * 1000)},
counts AS ({_window_counts_sql(DEFAULT_WINDOW_SECONDS)})
SELECT * FROM counts
WHERE window_end <= (SELECT max("timestamp") FROM all_clicks) - INTERVAL '{DEFAULT_WATERMARK_SECONDS} seconds'""",
    "speed_files_capped": f"""SELECT event_id // {RECORDS_PER_STORED_BATCH} AS batch_id, 1::BIGINT AS files, count(*)::BIGINT AS clicks
FROM events GROUP BY ALL""",
    "report_incremental": f"""WITH {_CLICKS_CTE}, halves AS (SELECT count(*) // 2 AS half FROM events)
SELECT page, trafficSource, count(*)::BIGINT AS sum_count, DATE '{PREVIOUS_REPORT_DATE}' AS report_date
FROM clicks, halves WHERE "offset" < half GROUP BY ALL
UNION ALL
SELECT page, trafficSource, count(*)::BIGINT AS sum_count, DATE '{REPORT_DATE}' AS report_date FROM clicks GROUP BY ALL""",
    "spend_stream_report_error": f"""SELECT event_id AS account_id, date_trunc('second', ts) AS log_ts,
       CAST(floor("value") AS BIGINT) AS amount FROM events""",
    "speed_restarted": f"""WITH {_CLICKS_CTE}
SELECT page, trafficSource, count(*)::BIGINT AS sum_count, count(*)::BIGINT AS raw_rows FROM clicks GROUP BY ALL""",
    "raw_landing_restarted": f"""WITH {_CLICKS_CTE}
SELECT "timestamp", page, userId, duration, trafficSource, '{DEFAULT_TOPIC}' AS topic, 0 AS partition, "offset" FROM clicks""",
    "stream_final_corrected": f"""WITH {_CLICKS_CTE},
on_time AS (SELECT max("timestamp") AS newest FROM clicks WHERE "offset" % {LATE_EVERY} <> 0),
emitted AS (
  SELECT max({_bucket(DEFAULT_WINDOW_SECONDS)} + INTERVAL '{DEFAULT_WINDOW_SECONDS} seconds') AS closed FROM clicks, on_time
  WHERE {_bucket(DEFAULT_WINDOW_SECONDS)} + INTERVAL '{DEFAULT_WINDOW_SECONDS} seconds'
        <= (SELECT max("timestamp") FROM clicks) - INTERVAL '{DEFAULT_WATERMARK_SECONDS} seconds'
    AND ("offset" % {LATE_EVERY} <> 0 OR {_bucket(DEFAULT_WINDOW_SECONDS)} + INTERVAL '{DEFAULT_WINDOW_SECONDS} seconds'
         > newest - INTERVAL '{DEFAULT_WATERMARK_SECONDS} seconds')),
counts AS ({_window_counts_sql(DEFAULT_WINDOW_SECONDS)})
SELECT counts.* FROM counts, emitted WHERE window_end <= closed""",
    "speed_update_counts": _SPEED_SQL,
    "page_stats_processing_time": f"""WITH {_CLICKS_CTE}
SELECT page, count(*)::BIGINT AS "count" FROM clicks GROUP BY page""",
    "speed_triggered_totals": f"""WITH totals AS ({_TOTALS_SQL})
SELECT totals.*, (SELECT count(*) FROM events)::BIGINT AS records FROM totals""",
    "spend_merged": f"""WITH times AS (SELECT unnest(range({REWRITES})) AS time),
rows AS (
  SELECT ((user_id % {ACCOUNTS}) + {ACCOUNTS}) % {ACCOUNTS} AS account, date_trunc('second', ts) AS log_ts, event_id, time,
         CAST(floor("value" + time) AS BIGINT) AS amount
  FROM events, times)
SELECT account + 1 AS account_id, log_ts, arg_max(amount, (time, event_id)) AS amount
FROM rows WHERE account < {ACCOUNTS} - time GROUP BY account, log_ts""",
    "spend_bands": f"""SELECT CAST(event_id AS VARCHAR) AS metric, CAST(floor("value") AS BIGINT) AS "value",
       CASE WHEN floor("value") >= 80 THEN 'red' ELSE 'green' END AS band FROM events""",
    "speed_counts_odd_records": f"""WITH all_{_CLICKS_CTE}, clicks AS (
  SELECT "timestamp", CASE WHEN event_type = 'view' THEN NULL ELSE page END AS page, trafficSource
  FROM all_clicks WHERE event_type NOT IN ('error', 'signup'))
{_window_counts_sql(HOUR_WINDOW_SECONDS)}""",
    "speed_stream_windows": _SPEED_SQL,
    "speed_stream_totals": _TOTALS_SQL,
    "raw_landing": _RAW_SQL,
    "page_visits_stream": _VISITS_SQL,
    "page_stats_stream": _stats_json_sql(
        """WHERE windowEnd <= (SELECT max("timestamp") FROM all_clicks) - INTERVAL '200 milliseconds'""",
        late_ms=OUT_OF_ORDERNESS_MS),
    "spend_stream_report": _SPEND_ROWS_SQL,
}


CATALOG: tuple[CatalogQuery, ...] = (
    CatalogQuery("raw_clicks", raw_clicks, SQL["raw_clicks"], ("P1", "P2", "P3", "P4")),
    CatalogQuery("permissive_parse", permissive_parse, SQL["permissive_parse"], ("P2", "P4")),
    CatalogQuery("speed_window_counts", speed_window_counts, SQL["speed_window_counts"], ("A1", "W1", "F1")),
    CatalogQuery("speed_window_counts_1h", speed_window_counts_1h, SQL["speed_window_counts_1h"], ("A1", "W1")),
    CatalogQuery("speed_partials", speed_partials, SQL["speed_partials"], ("A1", "W7", "K2")),
    CatalogQuery("latest_windows", latest_windows_q, SQL["latest_windows"], ("O2", "O3")),
    CatalogQuery("latest_partials", latest_partials, SQL["latest_partials"], ("O2", "O3", "S3")),
    CatalogQuery("check_speed_view", check_speed_view, SQL["check_speed_view"], ("S3", "O2", "O3")),
    CatalogQuery("check_stored_rows", check_stored_rows, SQL["check_stored_rows"], ("S3", "O2", "O3")),
    CatalogQuery("all_time_totals", all_time_totals_q, SQL["all_time_totals"], ("A2", "P14")),
    CatalogQuery("batch_report", batch_report, SQL["batch_report"], ("K3", "P5", "S4", "R3")),
    CatalogQuery("report_top", report_top, SQL["report_top"], ("O1", "O3", "F2")),
    CatalogQuery("report_history", report_history, SQL["report_history"], ("K3", "R3")),
    CatalogQuery("report_static_overwrite", report_static_overwrite, SQL["report_static_overwrite"], ("K3",)),
    CatalogQuery("speed_counts_12h_wire", speed_counts_12h_wire, SQL["speed_counts_12h_wire"], ("P4", "A1")),
    CatalogQuery("page_visits_12h_wire", page_visits_12h_wire, SQL["page_visits_12h_wire"], ("P7", "P6")),
    CatalogQuery("page_stats_15s", page_stats_15s, SQL["page_stats_15s"], ("W2", "P11", "A3", "P7")),
    CatalogQuery("page_stats_json", page_stats_json_q, SQL["page_stats_json"], ("P8",)),
    CatalogQuery("page_visits", page_visits_q, SQL["page_visits"], ("P6", "P7")),
    CatalogQuery("spend_rows", spend_rows, SQL["spend_rows"], ("P9", "A5")),
    CatalogQuery("spend_by_account", spend_by_account_q, SQL["spend_by_account"], ("A4", "P12", "P13")),
    CatalogQuery("stream_final_counts", stream_final_counts, SQL["stream_final_counts"],
                 ("W1", "W3", "W6", "K4", "W8")),
    CatalogQuery("speed_stream_windows", speed_stream_windows, SQL["speed_stream_windows"],
                 ("K11", "K2", "R2", "W8", "S3")),
    CatalogQuery("speed_stream_totals", speed_stream_totals, SQL["speed_stream_totals"], ("K11", "A2", "K3")),
    CatalogQuery("raw_landing", raw_landing, SQL["raw_landing"], ("K1", "K11")),
    CatalogQuery("page_visits_stream", page_visits_stream, SQL["page_visits_stream"], ("K6", "W4")),
    CatalogQuery("page_stats_stream", page_stats_stream, SQL["page_stats_stream"], ("K7", "W2", "W4")),
    CatalogQuery("spend_stream_report", spend_stream_report, SQL["spend_stream_report"], ("K9", "S5", "A5")),
    CatalogQuery("spend_stream_report_error", spend_stream_report_error, SQL["spend_stream_report_error"], ("K9", "A5")),
    CatalogQuery("speed_restarted", speed_restarted, SQL["speed_restarted"], ("W8", "K11", "K1", "K2")),
    CatalogQuery("raw_landing_restarted", raw_landing_restarted, SQL["raw_landing_restarted"], ("K1", "W8")),
    CatalogQuery("stream_final_corrected", stream_final_corrected, SQL["stream_final_corrected"], ("W3", "W7", "W6")),
    CatalogQuery("speed_update_counts", speed_update_counts, SQL["speed_update_counts"], ("W6", "A1")),
    CatalogQuery("page_stats_processing_time", page_stats_processing_time, SQL["page_stats_processing_time"], ("W9", "W6")),
    CatalogQuery("speed_triggered_totals", speed_triggered_totals, SQL["speed_triggered_totals"], ("W5", "W8")),
    CatalogQuery("spend_merged", spend_merged, SQL["spend_merged"], ("K9", "A5")),
    CatalogQuery("spend_bands", spend_bands, SQL["spend_bands"], ("P13", "A4")),
    CatalogQuery("speed_counts_odd_records", speed_counts_odd_records, SQL["speed_counts_odd_records"], ("F1", "P2")),
    CatalogQuery("speed_files_capped", speed_files_capped, SQL["speed_files_capped"], ("R1", "K2")),
    CatalogQuery("report_incremental", report_incremental, SQL["report_incremental"], ("A2", "F2", "K3")),
)

BY_NAME = {q.name: q for q in CATALOG}
