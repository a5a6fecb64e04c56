import datetime as dt
import re

import pytest

from clickpulse.operators.ordering import top_report
from clickpulse.operators.totals import all_time_totals, with_report_date
from clickpulse.plans.batch import run_batch_layer
from clickpulse.plans.check import report_view, speed_view
from clickpulse.schemas import SPEED_SCHEMA, SchemaMismatch, assert_schema
from clickpulse.sources.sinks import write_report
from clickpulse.sources.tables import read_report
from tests.helpers import ts


def speed_rows(spark, rows):
    data = [((ts(s), ts(e)), p, src, c) for s, e, p, src, c in rows]
    return spark.createDataFrame(data, SPEED_SCHEMA)


@pytest.fixture
def speed(spark):
    return speed_rows(spark, [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", "/a", "g", 2),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", "/a", "g", 3),  # partial of the same window
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", "/a", "y", 4),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", "/b", "g", 5),
    ])


def test_totals(spark, speed):
    got = {(r.page, r.trafficSource): r.sum_count for r in all_time_totals(speed).collect()}
    assert got == {("/a", "g"): 5, ("/a", "y"): 4, ("/b", "g"): 5}
    assert dict(all_time_totals(speed).dtypes)["sum_count"] == "bigint"


def test_schema_is_checked_on_read(spark):
    wrong = spark.createDataFrame([("x", "/a", "g", 1)], "window string, page string, trafficSource string, count long")
    with pytest.raises(SchemaMismatch):
        all_time_totals(wrong)
    with pytest.raises(SchemaMismatch):
        assert_schema(spark.createDataFrame([(1,)], "page long"), SPEED_SCHEMA)


def test_report_dates_dynamic_keeps_history(spark, speed, workdir):
    base = f"{workdir}/report"
    write_report(with_report_date(all_time_totals(speed), "2024-01-01"), base)
    write_report(with_report_date(all_time_totals(speed), "2024-01-02"), base)
    dates = {r.report_date for r in read_report(spark, base).select("report_date").distinct().collect()}
    assert dates == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}
    # rewriting a date replaces only that date
    write_report(with_report_date(all_time_totals(speed).limit(1), "2024-01-02"), base)
    assert read_report(spark, base, "2024-01-02").count() == 1
    assert read_report(spark, base, "2024-01-01").count() == 3


def test_report_dates_static_drops_history(spark, speed, workdir):
    base = f"{workdir}/report"
    write_report(with_report_date(all_time_totals(speed), "2024-01-01"), base, overwrite_mode="static")
    write_report(with_report_date(all_time_totals(speed), "2024-01-02"), base, overwrite_mode="static")
    dates = {r.report_date for r in read_report(spark, base).select("report_date").distinct().collect()}
    assert dates == {dt.date(2024, 1, 2)}


def test_read_one_date_prunes_partitions(spark, speed, workdir):
    base = f"{workdir}/report"
    write_report(with_report_date(all_time_totals(speed), "2024-01-01"), base)
    df = read_report(spark, base, "2024-01-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_date" in plan
    assert df.schema["report_date"].dataType.simpleString() == "date"
    assert "report_date" not in read_report(spark, base, "2024-01-01", keep_date=False).columns


def test_top_report_ties(spark):
    rep = spark.createDataFrame([("/b", "g", 5), ("/a", "y", 5), ("/a", "g", 5), ("/c", "g", 9)],
                                "page string, trafficSource string, sum_count long")
    got = [(r.page, r.trafficSource) for r in top_report(rep, 3).collect()]
    assert got == [("/c", "g"), ("/a", "g"), ("/a", "y")]


def test_batch_layer_end_to_end(spark, speed, workdir):
    speed.write.parquet(f"{workdir}/speed")
    out = run_batch_layer(spark, f"{workdir}/speed", f"{workdir}/report", "2022-08-27")
    assert sorted((r.page, r.trafficSource, r.sum_count) for r in out.collect()) == [
        ("/a", "g", 5), ("/a", "y", 4), ("/b", "g", 5)]
    top = report_view(spark, f"{workdir}/report", "2022-08-27", n=1).collect()
    assert (top[0].page, top[0].sum_count) == ("/a", 5)
    newest = speed_view(spark, f"{workdir}/speed", n=2).collect()
    assert [(r.page, r["count"]) for r in newest] == [("/a", 4), ("/b", 5)]


def test_default_report_date_is_today(spark, speed):
    d = with_report_date(all_time_totals(speed)).select("report_date").first()[0]
    assert d == spark.sql("select date_format(current_date(), 'yyyy-MM-dd')").first()[0]


def test_incremental_report_equals_full(spark, workdir):
    from clickpulse.config import LayerConfig
    from clickpulse.plans.speed import speed_batch

    cdl = "timestamp timestamp, page string, trafficSource string"

    def clicks(rows):
        return spark.createDataFrame([(ts(t), p, s) for t, p, s in rows], cdl)

    cfg = LayerConfig(speed_path=f"{workdir}/speed")
    speed_batch(clicks([("2024-01-01 00:00:01", "/a", "g"), ("2024-01-01 00:00:02", "/b", "g")]), 0, cfg, run="r1")
    speed_batch(clicks([("2024-01-01 00:00:05", "/a", "g")]), 1, cfg, run="r1")
    base = f"{workdir}/report"
    first = run_batch_layer(spark, cfg.speed_path, base, "2024-01-01", incremental=True)
    assert sorted((r.page, r.sum_count) for r in first.collect()) == [("/a", 2), ("/b", 1)]

    # more batches of the same run, a new run, and a retried (rewritten) old batch
    speed_batch(clicks([("2024-01-01 00:00:09", "/a", "y")]), 2, cfg, run="r1")
    speed_batch(clicks([("2024-01-02 00:00:09", "/b", "g")] * 3), 0, cfg, run="r2")
    speed_batch(clicks([("2024-01-01 00:00:05", "/a", "g")]), 1, cfg, run="r1")
    inc = run_batch_layer(spark, cfg.speed_path, base, "2024-01-02", incremental=True)
    full = run_batch_layer(spark, cfg.speed_path, f"{workdir}/full", "2024-01-02")
    key = lambda r: (r.page, r.trafficSource, r.sum_count)
    assert sorted(map(key, inc.collect())) == sorted(map(key, full.collect())) == [
        ("/a", "g", 2), ("/a", "y", 1), ("/b", "g", 4)]
    # the earlier date is kept and unchanged
    assert sorted((r.page, r.sum_count) for r in read_report(spark, base, "2024-01-01").collect()) == [
        ("/a", 2), ("/b", 1)]


def test_incremental_reads_only_new_batches(spark, workdir):
    from clickpulse.config import LayerConfig
    from clickpulse.plans.batch import incremental_totals
    from clickpulse.plans.speed import speed_batch
    from clickpulse.sources.tables import read_speed_view

    cfg = LayerConfig(speed_path=f"{workdir}/speed", max_speed_files=1)
    one = spark.createDataFrame([(ts("2024-01-01 00:00:01"), "/a", "g")],
                                "timestamp timestamp, page string, trafficSource string")
    for b in range(4):
        speed_batch(one, b, cfg, run="r1")
    base = f"{workdir}/report"
    run_batch_layer(spark, cfg.speed_path, base, "2024-01-01", incremental=True)
    speed_batch(one, 4, cfg, run="r1")
    totals, coverage = incremental_totals(spark, read_speed_view(spark, cfg.speed_path), base, "2024-01-02")
    plan = totals._jdf.queryExecution().executedPlan().toString()
    # only the new batch folder is read from the speed view
    assert re.search(r"PartitionFilters: \[[^\]]*\(batch_id#\d+ > 3\)", plan)
    assert totals.collect()[0].sum_count == 5
    assert [(r.run, r.through) for r in coverage.collect()] == [("r1", 4)]


def test_incremental_skips_a_batch_still_being_written(spark, workdir):
    """A batch folder without its completion marker (files still being
    committed when the report lists the view) is left for the next report,
    not counted half and then skipped for good."""
    from clickpulse.config import LayerConfig
    from clickpulse.operators.windows import window_counts
    from clickpulse.plans.speed import mark_done, speed_batch
    from clickpulse.sources.sinks import write_speed_batch

    cfg = LayerConfig(speed_path=f"{workdir}/speed", max_speed_files=1)
    one = spark.createDataFrame([(ts("2024-01-01 00:00:01"), "/a", "g")],
                                "timestamp timestamp, page string, trafficSource string")
    speed_batch(one, 0, cfg, run="r1")
    write_speed_batch(window_counts(one, 10), cfg.speed_path, 1, 1, "r1")  # in flight: no marker yet
    base = f"{workdir}/report"
    first = run_batch_layer(spark, cfg.speed_path, base, "2024-01-01", incremental=True)
    assert [r.sum_count for r in first.collect()] == [1]
    mark_done(spark, cfg.speed_path, 1, "r1")  # the batch's commit finished
    second = run_batch_layer(spark, cfg.speed_path, base, "2024-01-02", incremental=True)
    assert [r.sum_count for r in second.collect()] == [2]


def _speed_with(spark, workdir, sizes, first=0):
    """Micro-batches of so many clicks each, as the speed layer writes them."""
    from clickpulse.config import LayerConfig
    from clickpulse.plans.speed import speed_batch

    cfg = LayerConfig(speed_path=f"{workdir}/speed", max_speed_files=1)
    for b, n in enumerate(sizes, first):
        rows = spark.createDataFrame([(ts("2024-01-01 00:00:01"), "/a", "g")] * n,
                                     "timestamp timestamp, page string, trafficSource string")
        speed_batch(rows, b, cfg, run="r1")
    return cfg.speed_path


def test_full_rerun_between_incremental_runs_counts_nothing_twice(spark, workdir):
    base = f"{workdir}/report"
    path = _speed_with(spark, workdir, [5])
    run_batch_layer(spark, path, base, "2024-01-01", incremental=True)
    _speed_with(spark, workdir, [7], first=1)
    full = run_batch_layer(spark, path, base, "2024-01-01")
    assert [r.sum_count for r in full.collect()] == [12]
    _speed_with(spark, workdir, [11], first=2)
    second = run_batch_layer(spark, path, base, "2024-01-02", incremental=True)
    assert [r.sum_count for r in second.collect()] == [23]


@pytest.mark.parametrize("died_before", ["_write_state", "write_report"])
def test_rerun_that_died_leaves_totals_and_coverage_together(spark, workdir, monkeypatch, died_before):
    from clickpulse.plans import batch

    base = f"{workdir}/report"
    path = _speed_with(spark, workdir, [5])
    run_batch_layer(spark, path, base, "2024-01-01", incremental=True)
    _speed_with(spark, workdir, [7], first=1)
    with monkeypatch.context() as m:
        def die(*_, **__):
            raise RuntimeError("lost")
        m.setattr(batch, died_before, die)
        with pytest.raises(RuntimeError):
            run_batch_layer(spark, path, base, "2024-01-01", incremental=True)
    again = run_batch_layer(spark, path, base, "2024-01-02", incremental=True)
    assert [r.sum_count for r in again.collect()] == [12]


def test_state_without_success_file_is_ignored(spark, workdir):
    import os

    base = f"{workdir}/report"
    path = _speed_with(spark, workdir, [5])
    run_batch_layer(spark, path, base, "2024-01-01", incremental=True)
    os.remove(f"{base}/_report_state/report_date=2024-01-01/_SUCCESS")
    _speed_with(spark, workdir, [7], first=1)
    out = run_batch_layer(spark, path, base, "2024-01-02", incremental=True)
    assert [r.sum_count for r in out.collect()] == [12]


def test_incremental_static_is_rejected(spark, workdir):
    with pytest.raises(ValueError, match="static"):
        run_batch_layer(spark, _speed_with(spark, workdir, [1]), f"{workdir}/report", "2024-01-01", "static",
                        incremental=True)
