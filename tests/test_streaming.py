"""Streaming = batch: file sources stand in for the topics."""

import json

from pyspark.sql import functions as F

from clickpulse.config import LayerConfig
from clickpulse.functions.decode import parse_clicks
from clickpulse.operators.totals import all_time_totals
from clickpulse.operators.windows import reaggregate_speed, window_counts
from clickpulse.sources.kafka import kafka_source_options, read_record_files, to_records
from clickpulse.sources.replay import click_records, read_events, transaction_records
from clickpulse.sources.tables import read_speed_view
from clickpulse.streaming.clicks import start_page_stats, start_page_visits
from clickpulse.streaming.spend import read_spend_table, start_spend_report
from clickpulse.streaming.speed import start_console, start_speed_layer
from tests.conftest import SF_SMALL
from tests.helpers import click, records, ts


def _stage(spark, df, path, per_file=300):
    df.write.option("maxRecordsPerFile", per_file).parquet(path)
    return path


def _wait(qs):
    for q in qs:
        assert q.awaitTermination(300)
        assert q.exception() is None


def test_partials_stream_sums_to_batch(spark, workdir):
    rec = click_records(read_events(spark, SF_SMALL))
    stage = _stage(spark, rec, f"{workdir}/in")
    cfg = LayerConfig(speed_path=f"{workdir}/speed", raw_path=f"{workdir}/raw", max_speed_files=None)
    _wait(start_speed_layer(read_record_files(spark, stage, 1), cfg, f"{workdir}/ckpt", available_now=True))
    view = read_speed_view(spark, cfg.speed_path)
    assert view.select("batch_id").distinct().count() > 1  # several micro-batches ran
    batch = window_counts(parse_clicks(rec), 10)
    key = ["window", "page", "trafficSource", "count"]
    assert sorted(reaggregate_speed(view).select(key).collect()) == sorted(batch.select(key).collect())
    assert sorted(all_time_totals(view).collect()) == sorted(all_time_totals(batch).collect())
    assert spark.read.parquet(cfg.raw_path).count() == rec.count()


def test_final_mode_emits_closed_windows_and_drops_late_rows(spark, workdir):
    src = f"{workdir}/in"
    cfg = LayerConfig(speed_path=f"{workdir}/speed", speed_mode="final", trigger_seconds=0)
    first = [click("01-01-2024 00:00:01:000"), click("01-01-2024 00:05:00:000")]
    records(spark, first).coalesce(1).write.mode("append").parquet(src)
    (q,) = start_speed_layer(read_record_files(spark, src, 1), cfg, f"{workdir}/ckpt")
    try:
        q.processAllAvailable()
        # watermark is now 00:04:00; 00:00:02 is late, 00:07:00 moves it to 00:06:00
        late = [click("01-01-2024 00:00:02:000"), click("01-01-2024 00:07:00:000")]
        records(spark, late, start_offset=2).coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
        dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                      if p.get("stateOperators"))
        plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    finally:
        q.stop()
    out = read_speed_view(spark, cfg.speed_path)
    got = sorted((r.window.start.strftime("%H:%M:%S"), r["count"]) for r in out.collect())
    assert got == [("00:00:00", 1), ("00:05:00", 1)]
    assert dropped == 1
    # the state store is fed by per-task partial counts, not by raw rows
    lines = [line.strip() for line in plan.split("\n")]
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert "partial_count" in lines[exchange + 1]
    assert any("StateStoreRestore" in line for line in lines[:exchange])


def test_console_sink_runs(spark, workdir):
    src = f"{workdir}/in"
    records(spark, [click("01-01-2024 00:00:01:000")]).write.parquet(src)
    counts = window_counts(parse_clicks(read_record_files(spark, src)), 10)
    q = start_console(counts, "update", available_now=True, checkpoint=f"{workdir}/ckpt")
    assert q.awaitTermination(120)


def test_page_visits_stream(spark, workdir):
    rec = click_records(read_events(spark, SF_SMALL))
    stage = _stage(spark, rec, f"{workdir}/in")
    _wait([start_page_visits(read_record_files(spark, stage, 2), f"{workdir}/ckpt", path=f"{workdir}/visits",
                             available_now=True)])
    visits = spark.read.parquet(f"{workdir}/visits")
    assert visits.count() == rec.count()
    assert set(visits.columns) == {"timestamp", "page", "run", "batch_id"}


def test_page_stats_stream_json(spark, workdir):
    src = f"{workdir}/in"
    records(spark, [click("01-01-2024 01:03:50:000", page="/click"), click("01-01-2024 01:05:00:000")]) \
        .write.parquet(src)
    _wait([start_page_stats(read_record_files(spark, src), f"{workdir}/ckpt", path=f"{workdir}/stats",
                            available_now=True)])
    out = [json.loads(r.value.decode()) for r in spark.read.parquet(f"{workdir}/stats").collect()]
    assert out == [{"windowStart": "01-01-2024 01:03:45:000", "windowEnd": "01-01-2024 01:04:00:000",
                    "page": "/click", "count": 1}]


def test_spend_stream_resolves_keys_across_batches(spark, workdir):
    lines = ["1, 10, 2000-01-01 01:00:00", "2, 5, 2000-01-01 01:00:00", "1, 99, 2000-01-01 01:00:00"]
    src = f"{workdir}/in"
    records(spark, lines[:2], keys=[1, 2]).coalesce(1).write.mode("append").parquet(src)
    records(spark, lines[2:], start_offset=2, keys=[1]).coalesce(1).write.mode("append").parquet(src)
    _wait([start_spend_report(read_record_files(spark, src, 1), f"{workdir}/ckpt", fmt="parquet",
                              path=f"{workdir}/spend", available_now=True)])
    got = sorted((r.account_id, r.amount) for r in read_spend_table(spark, f"{workdir}/spend").collect())
    assert got == [(1, 99), (2, 5)]


def test_spend_stream_matches_batch(spark, workdir):
    rec = transaction_records(read_events(spark, SF_SMALL))
    stage = _stage(spark, rec, f"{workdir}/in")
    _wait([start_spend_report(read_record_files(spark, stage, 1), f"{workdir}/ckpt", fmt="parquet",
                              path=f"{workdir}/spend", available_now=True)])
    n_keys = rec.select(F.split(F.col("value").cast("string"), ", ").alias("p")) \
        .select(F.col("p")[0], F.col("p")[2]).distinct().count()
    assert read_spend_table(spark, f"{workdir}/spend").count() == n_keys


def test_kafka_options_and_record_shape(spark):
    opts = kafka_source_options("b:9092", "input", group_id="click-event-count", max_offsets_per_trigger=100)
    assert opts["subscribe"] == "input" and opts["kafka.group.id"] == "click-event-count"
    assert opts["maxOffsetsPerTrigger"] == "100"
    df = to_records(spark.createDataFrame([("x", 1)], "value string, k long"), key="k")
    assert df.dtypes == [("key", "binary"), ("value", "binary")]


def test_parquet_sink_appends(spark, workdir):
    from clickpulse.streaming.speed import start_parquet_sink
    src = f"{workdir}/in"
    records(spark, [click("01-01-2024 00:00:01:000"), click("01-01-2024 00:00:02:000")]).write.parquet(src)
    q = start_parquet_sink(parse_clicks(read_record_files(spark, src)), f"{workdir}/out", f"{workdir}/ckpt",
                           available_now=True)
    assert q.awaitTermination(120)
    assert spark.read.parquet(f"{workdir}/out").count() == 2


def test_spend_report_reader_on_file_table(spark, workdir):
    from clickpulse.operators.spend import spend_by_account
    from clickpulse.sources.tables import jdbc_options, read_spend_report
    spark.createDataFrame([(1, None, 10), (1, None, 5)], "account_id long, log_ts timestamp, amount long") \
        .write.parquet(f"{workdir}/t")
    got = spend_by_account(read_spend_report(spark, "parquet", f"{workdir}/t")).collect()
    assert [(r.metric, r.value) for r in got] == [("1", 15)]
    opts = jdbc_options("jdbc:x://h/db", user="u", password="p")
    assert opts["dbtable"] == "spend_report" and opts["user"] == "u"


def test_jdbc_range_options():
    from clickpulse.sources.tables import jdbc_options, jdbc_range_options
    opts = jdbc_range_options(jdbc_options("jdbc:x://h/db"), "log_ts", ts("2000-01-01 01:00:00"),
                              ts("2000-02-01 00:00:00"), 16)
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == \
        ("log_ts", "2000-01-01 01:00:00", "2000-02-01 00:00:00", "16")
    assert opts["dbtable"] == "spend_report"


def test_spend_stream_greatest_offset_wins_whatever_the_batch(spark, workdir):
    """A later micro-batch may carry an earlier offset; the offset decides."""
    src = f"{workdir}/in"
    records(spark, ["1, 50, 2000-01-01 01:00:00"], start_offset=5, keys=[1]).coalesce(1) \
        .write.mode("append").parquet(src)
    records(spark, ["1, 10, 2000-01-01 01:00:00"], start_offset=1, keys=[1]).coalesce(1) \
        .write.mode("append").parquet(src)
    _wait([start_spend_report(read_record_files(spark, src, 1), f"{workdir}/ckpt", fmt="parquet",
                              path=f"{workdir}/spend", available_now=True)])
    assert [(r.account_id, r.amount) for r in read_spend_table(spark, f"{workdir}/spend").collect()] == [(1, 50)]


def test_new_checkpoint_does_not_overwrite_earlier_run(spark, workdir):
    """A query on a fresh checkpoint counts batches from 0 again; its output
    lands in its own run folder, so the earlier run's rows stay."""
    src = f"{workdir}/in"
    records(spark, [click("01-01-2024 00:00:01:000")]).write.parquet(src)
    cfg = LayerConfig(speed_path=f"{workdir}/speed")
    for ckpt in ("ckpt-a", "ckpt-b"):
        _wait(start_speed_layer(read_record_files(spark, src), cfg, f"{workdir}/{ckpt}", available_now=True))
    view = read_speed_view(spark, cfg.speed_path)
    assert view.select("run").distinct().count() == 2
    assert view.agg(F.sum("count")).first()[0] == 2
    # restarting from an existing checkpoint finds nothing new and adds nothing
    _wait(start_speed_layer(read_record_files(spark, src), cfg, f"{workdir}/ckpt-a", available_now=True))
    assert read_speed_view(spark, cfg.speed_path).agg(F.sum("count")).first()[0] == 2


def test_restart_and_rerun_batch_count_each_click_once(spark, workdir):
    """The driver dies after a micro-batch wrote its output but before Spark
    committed it; the query restarts from its checkpoint, re-runs that batch
    (same id, same offsets), then takes new input. Every click is counted
    and landed exactly once."""
    import glob
    import os

    rec = click_records(read_events(spark, SF_SMALL))
    src, ckpt = f"{workdir}/in", f"{workdir}/ckpt"
    cfg = LayerConfig(speed_path=f"{workdir}/speed", raw_path=f"{workdir}/raw")
    rec.where("offset < 500").write.option("maxRecordsPerFile", 300).parquet(src)
    _wait(start_speed_layer(read_record_files(spark, src, 1), cfg, ckpt, available_now=True))
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{ckpt}/speed/commits/[0-9]*"))
    lost = glob.glob(f"{ckpt}/speed/commits/{last}") + glob.glob(f"{ckpt}/speed/commits/.{last}.crc")
    assert last >= 1 and f"{ckpt}/speed/commits/{last}" in lost
    for p in lost:
        os.remove(p)  # the crash: batch `last` wrote its folders, its commit is lost
    rec.where("offset >= 500").write.mode("append").option("maxRecordsPerFile", 300).parquet(src)
    _wait(start_speed_layer(read_record_files(spark, src, 1), cfg, ckpt, available_now=True))

    view = read_speed_view(spark, cfg.speed_path)
    assert view.select("run").distinct().count() == 1  # the restart wrote into the same run
    key = ["window", "page", "trafficSource", "count"]
    assert sorted(reaggregate_speed(view).select(key).collect()) == \
        sorted(window_counts(parse_clicks(rec), 10).select(key).collect())
    assert spark.read.parquet(cfg.raw_path).count() == rec.count()


def test_keyed_spend_sink_survives_a_rerun_batch(spark, workdir):
    """Keyed (JDBC-style) spend sink: a micro-batch re-run after its insert
    but before its commit sends nothing twice; each key is in the table once."""
    import glob
    import os

    from clickpulse.schemas import SPEND_REPORT_SCHEMA

    rec = transaction_records(read_events(spark, SF_SMALL))
    src, ckpt, table = f"{workdir}/in", f"{workdir}/ckpt", f"{workdir}/spend_report"
    spark.createDataFrame([], SPEND_REPORT_SCHEMA).write.parquet(table)  # the table exists, as its DDL makes it
    opts = {"path": table}
    rec.write.option("maxRecordsPerFile", 300).parquet(src)

    def run():
        _wait([start_spend_report(read_record_files(spark, src, 1), ckpt, fmt="parquet", options=opts,
                                  available_now=True)])

    run()
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{ckpt}/commits/[0-9]*"))
    lost = glob.glob(f"{ckpt}/commits/{last}") + glob.glob(f"{ckpt}/commits/.{last}.crc")
    assert last >= 1 and f"{ckpt}/commits/{last}" in lost
    for p in lost:
        os.remove(p)
    run()  # re-runs batch `last`
    from clickpulse.functions.decode import parse_transactions
    from clickpulse.operators.spend import dedupe_spend

    got = sorted(spark.read.parquet(table).collect())
    assert len(got) > 0 and got == sorted(dedupe_spend(parse_transactions(rec, keep=("offset",))).collect())


def test_without_written_keeps_conflicts(spark):
    from clickpulse.streaming.spend import without_written
    ddl = "account_id long, log_ts timestamp, amount long"
    table = spark.createDataFrame([(1, ts("2000-01-01 01:00:00"), 10), (2, ts("2000-01-01 01:00:00"), 5),
                                   (3, ts("1999-01-01 00:00:00"), 7)], ddl)
    rows = spark.createDataFrame([(1, ts("2000-01-01 01:00:00"), 10), (2, ts("2000-01-01 01:00:00"), 6),
                                  (3, ts("2000-01-01 02:00:00"), 7)], ddl)
    got = sorted((r.account_id, r.amount) for r in without_written(rows, table).collect())
    assert got == [(2, 6), (3, 7)]  # the unchanged row is dropped; a changed amount still meets the key


def test_without_written_reads_only_the_batch_range(spark, workdir):
    from clickpulse.streaming.spend import without_written
    ddl = "account_id long, log_ts timestamp, amount long"
    spark.createDataFrame([(1, ts("1999-01-01 00:00:00"), 7)], ddl).write.parquet(f"{workdir}/t")
    rows = spark.createDataFrame([(1, ts("2000-01-01 01:00:00"), 10), (2, ts("2000-01-01 02:00:00"), 6)], ddl)
    plan = without_written(rows, spark.read.parquet(f"{workdir}/t"))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "GreaterThanOrEqual(log_ts,2000-01-01 01:00:00.0)" in pushed
    assert "LessThanOrEqual(log_ts," in pushed  # the plan text truncates its literal


def test_processing_time_windows(spark, workdir):
    """Without the event-time switch, statistics window on the time of the
    micro-batch: an old event lands in the window of 'now'."""
    import datetime as dt

    from clickpulse.functions.decode import parse_clicks_strict
    from clickpulse.operators.windows import page_stats
    from clickpulse.streaming.clicks import with_processing_time

    clicks = parse_clicks_strict(records(spark, [click("01-01-2024 00:00:01:000"), click("01-01-2024 00:00:02:000")]))
    before = dt.datetime.now()
    (row,) = page_stats(with_processing_time(clicks), 15).collect()
    assert row["count"] == 2 and row.windowEnd > before - dt.timedelta(seconds=1)
    assert (row.windowEnd - row.windowStart) == dt.timedelta(seconds=15)
    # the streaming job accepts it (watermark on the batch time, append mode)
    src = f"{workdir}/in"
    records(spark, [click("01-01-2024 00:00:01:000")]).write.parquet(src)
    _wait([start_page_stats(read_record_files(spark, src), f"{workdir}/ckpt", path=f"{workdir}/stats",
                            available_now=True, processing_time=True)])


def test_final_mode_file_cap(spark, workdir):
    """Final mode with a file cap: each trigger writes at most that many
    files, while the state store keeps all its partitions."""
    import glob

    src = f"{workdir}/in"
    lines = [click(f"01-01-2024 00:{m:02d}:01:000", page=f"/p{m % 6}") for m in range(30)]
    records(spark, lines).coalesce(1).write.parquet(src)
    cfg = LayerConfig(speed_path=f"{workdir}/speed", speed_mode="final", max_speed_files=1)
    (q,) = start_speed_layer(read_record_files(spark, src), cfg, f"{workdir}/ckpt", available_now=True)
    _wait([q])
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    out = read_speed_view(spark, cfg.speed_path)
    # newest event 00:29:01, watermark 60 s behind: windows ending by 00:28:01 are closed
    assert out.count() == 28
    batches = max(1, len([p for p in q.recentProgress if p["numInputRows"] or p.get("stateOperators")]))
    assert len(glob.glob(f"{workdir}/speed/*.parquet")) <= batches
    top = [line.strip() for line in plan.split("\n")[:2]]
    # the repartition sits on the aggregate's output, above the stateful work
    assert "REPARTITION_BY_NUM" in top[0] and "HashAggregate" in top[1]
