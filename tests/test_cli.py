from clickpulse.cli import main
from clickpulse.functions.decode import parse_clicks_strict
from clickpulse.functions.encode import clicks_to_records
from clickpulse.schemas import SPEED_SCHEMA
from tests.helpers import click, records, ts


def test_batch_and_check_jobs(spark, workdir, capsys):
    rows = [((ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:10")), "/a", "g", 2),
            ((ts("2024-01-01 00:00:10"), ts("2024-01-01 00:00:20")), "/b", "y", 5)]
    spark.createDataFrame(rows, SPEED_SCHEMA).write.parquet(f"{workdir}/speed")
    main(["batch", "--speed-path", f"{workdir}/speed", "--report-path", f"{workdir}/report",
          "--report-date", "2022-08-27"])
    main(["check", "--speed-path", f"{workdir}/speed", "--report-path", f"{workdir}/report",
          "--report-date", "2022-08-27"])
    out = capsys.readouterr().out
    assert "sum_count" in out and "2022-08-27" in out and "window_start" in out
    main(["check", "--speed-path", f"{workdir}/speed", "--report-path", f"{workdir}/report",
          "--report-date", "2022-08-27", "--as-stored"])
    assert "window_start" in capsys.readouterr().out


def test_click_records_round_trip(spark):
    typed = parse_clicks_strict(records(spark, [click("01-01-2024 15:00:00:250", page="/jobs", user=2013000004)]))
    back = parse_clicks_strict(clicks_to_records(typed)).collect()[0]
    assert (back.timestamp, back.page, back.userId, back.duration) == (ts("2024-01-01 15:00:00.250"), "/jobs",
                                                                      2013000004, 17)


def test_streaming_jobs_from_files(spark, workdir, capsys):
    from clickpulse.sources.replay import click_records, read_events, transaction_records
    from clickpulse.sources.tables import read_speed_view
    from clickpulse.streaming.spend import read_spend_table
    from tests.conftest import SF_SMALL

    had_provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    events = read_events(spark, SF_SMALL)
    click_records(events).write.parquet(f"{workdir}/clicks")
    transaction_records(events).write.parquet(f"{workdir}/tx")
    main(["speed", "--source-path", f"{workdir}/clicks", "--available-now", "--speed-path", f"{workdir}/speed",
          "--checkpoint", f"{workdir}/ck1", "--raw-format", "parquet", "--raw-path", f"{workdir}/raw"])
    assert read_speed_view(spark, f"{workdir}/speed").groupBy().sum("count").first()[0] == 1000
    assert spark.read.parquet(f"{workdir}/raw").count() == 1000
    main(["spend", "--source-path", f"{workdir}/tx", "--available-now", "--checkpoint", f"{workdir}/ck2",
          "--path", f"{workdir}/spend"])
    assert read_spend_table(spark, f"{workdir}/spend").count() > 0
    capsys.readouterr()
    main(["dashboard", "--path", f"{workdir}/spend"])
    out = capsys.readouterr().out
    assert all(word in out for word in ("metric", "value", "band", "time"))
    main(["batch", "--speed-path", f"{workdir}/speed", "--report-path", f"{workdir}/report",
          "--report-date", "2024-02-01", "--incremental"])
    if had_provider is None:  # the streaming jobs chose RocksDB for this session
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_sink_option_defaults():
    from clickpulse.cli import _parser
    a = _parser().parse_args(["speed", "--speed-path", "s", "--checkpoint", "c", "--raw-option", "table=x"])
    assert a.raw_option == ["table=x"]


def test_every_streaming_job_takes_rates_and_offsets():
    from clickpulse.cli import _format, _parser
    from clickpulse.config import DEFAULT_TRIGGER_SECONDS

    need = {"speed": ["--speed-path", "s"], "visits": [], "stats": ["--time-pattern", "dd-MM-yyyy hh:mm:ss:SSS"], "spend": []}
    for job, extra in need.items():
        a = _parser().parse_args([job, "--checkpoint", "c", "--max-offsets-per-trigger", "9", "--min-partitions", "4",
                                  "--starting-offsets", "earliest", *extra])
        assert (a.trigger_seconds, a.max_offsets_per_trigger, a.min_partitions) == (DEFAULT_TRIGGER_SECONDS, 9, 4)
    visits, stats = (_parser().parse_args([j, "--checkpoint", "c"]) for j in ("visits", "stats"))
    assert visits.group_id != stats.group_id
    assert _format(None, "/x") == "parquet" and _format("orc", "/x") == "orc" and "cassandra" in _format(None, None)


def test_drained_topic_starts_at_its_beginning():
    from clickpulse.sources.kafka import starting_offsets
    assert starting_offsets(None, False) == "latest" and starting_offsets(None, True) == "earliest"
    assert starting_offsets("latest", True) == "latest"


def test_jobs_read_times_as_utc(spark):
    from clickpulse.cli import _session
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert _session("zone").conf.get("spark.sql.session.timeZone") == "UTC"
