from pyspark.sql import functions as F

from clickpulse.functions.columns import flatten_window
from clickpulse.operators.ordering import latest_windows
from clickpulse.operators.windows import page_stats, reaggregate_speed, window_counts
from clickpulse.plans.speed import speed_batch
from clickpulse.config import LayerConfig
from clickpulse.sources.tables import read_speed_view
from tests.helpers import ts

CLICK_DDL = "timestamp timestamp, page string, trafficSource string"


def clicks(spark, rows):
    return spark.createDataFrame([(ts(t) if t else None, p, s) for t, p, s in rows], CLICK_DDL)


def test_window_edges_align_to_epoch(spark):
    df = clicks(spark, [("1969-12-31 23:59:57", "/a", "g"), ("1970-01-01 00:00:10", "/a", "g")])
    got = sorted((r.window_start, r.window_end) for r in flatten_window(window_counts(df, 10)).collect())
    assert got == [(ts("1969-12-31 23:59:50"), ts("1970-01-01 00:00:00")),
                   (ts("1970-01-01 00:00:10"), ts("1970-01-01 00:00:20"))]


def test_fifteen_second_edge(spark):
    df = clicks(spark, [("1970-01-01 00:00:14.999", "/a", "g")])
    r = page_stats(df, 15).collect()[0]
    assert (r.windowStart, r.windowEnd, r.page, r["count"]) == (
        ts("1970-01-01 00:00:00"), ts("1970-01-01 00:00:15"), "/a", 1)


def test_null_time_dropped_null_page_grouped(spark):
    df = clicks(spark, [(None, "/a", "g"), ("2024-01-01 00:00:01", None, "g"),
                        ("2024-01-01 00:00:02", None, "g"), ("2024-01-01 00:00:03", "/a", None)])
    got = {(r.page, r.trafficSource): r["count"] for r in window_counts(df, 10).collect()}
    assert got == {(None, "g"): 2, ("/a", None): 1}


def test_count_schema(spark):
    df = window_counts(clicks(spark, [("2024-01-01 00:00:01", "/a", "g")]), 10)
    assert df.schema.simpleString() == \
        "struct<window:struct<start:timestamp,end:timestamp>,page:string,trafficSource:string,count:bigint>"


def test_window_cut_across_batches_gives_two_rows(spark, workdir):
    """partials mode: one row per micro-batch; readers sum them."""
    cfg = LayerConfig(speed_path=f"{workdir}/speed", max_speed_files=1)
    speed_batch(clicks(spark, [("2024-01-01 00:00:01", "/a", "g")]), 0, cfg, land=False)
    speed_batch(clicks(spark, [("2024-01-01 00:00:05", "/a", "g"), ("2024-01-01 00:00:06", "/a", "g")]),
                1, cfg, land=False)
    view = read_speed_view(spark, cfg.speed_path)
    assert sorted(r["count"] for r in view.collect()) == [1, 2]
    assert [r["count"] for r in reaggregate_speed(view).collect()] == [3]


def test_retried_batch_replaces_itself(spark, workdir):
    cfg = LayerConfig(speed_path=f"{workdir}/speed", raw_path=f"{workdir}/raw")
    batch = clicks(spark, [("2024-01-01 00:00:01", "/a", "g")])
    speed_batch(batch, 7, cfg)
    speed_batch(batch, 7, cfg)  # same batch id again (retry)
    assert read_speed_view(spark, cfg.speed_path).agg(F.sum("count")).collect()[0][0] == 1
    assert spark.read.parquet(cfg.raw_path).count() == 1


def test_latest_windows_order_and_ties(spark):
    df = clicks(spark, [("2024-01-01 00:00:01", "/b", "g"), ("2024-01-01 00:00:02", "/a", "g"),
                        ("2024-01-01 00:00:21", "/z", "g"), ("2024-01-01 00:00:11", "/c", "y")])
    got = [(r.window_start.second, r.page) for r in latest_windows(window_counts(df, 10), 3).collect()]
    assert got == [(20, "/z"), (10, "/c"), (0, "/a")]


def _stored_partials(spark, workdir):
    """Three micro-batches; window [00:10, 00:20) is cut across two of them."""
    cfg = LayerConfig(speed_path=f"{workdir}/speed", max_speed_files=1)
    batches = [
        [("2024-01-01 00:00:01", "/a", "g"), ("2024-01-01 00:00:02", "/b", "g"), ("2024-01-01 00:00:11", "/a", "g")],
        [("2024-01-01 00:00:12", "/a", "g"), ("2024-01-01 00:00:15", "/c", "y"), ("2024-01-01 00:00:21", "/a", "g")],
        [("2024-01-01 00:00:31", "/b", None), ("2024-01-01 00:00:33", None, "g")],
    ]
    for i, rows in enumerate(batches):
        speed_batch(clicks(spark, rows), i, cfg, land=False)
    return cfg.speed_path


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_check_view_reads_only_newest_windows(spark, workdir):
    """Pruned read == full re-aggregation, for every n (cut inside a window,
    at its edge, and more than there are windows)."""
    from clickpulse.plans.check import speed_view

    path = _stored_partials(spark, workdir)
    view = read_speed_view(spark, path)
    for n in range(1, 9):
        for reagg in (True, False):
            full = latest_windows(reaggregate_speed(view) if reagg else view, n)
            assert _rows(speed_view(spark, path, n, reaggregate=reagg)) == _rows(full), (n, reagg)


def test_newest_window_filter_reaches_scan(spark, workdir):
    from clickpulse.operators.ordering import newest_window_rows

    path = _stored_partials(spark, workdir)
    # n small against the four stored windows, so that a cut is worth making
    # (a view of at most 2 n windows is read whole)
    pruned = newest_window_rows(read_speed_view(spark, path), 1)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "window.start" in scan and "GreaterThanOrEqual" in scan
    kept = {r.window.start.second for r in pruned.collect()}
    assert 30 in kept and 0 not in kept


def test_speed_view_times_carry_statistics(spark, workdir):
    """Window times are written as INT64 micros with min/max statistics
    (legacy INT96 has none), so the newest-window filter can skip row groups."""
    import glob

    import pyarrow.parquet as pq

    from clickpulse.cli import TIMESTAMP_TYPE_KEY, _session

    assert _session("stats-check").conf.get(TIMESTAMP_TYPE_KEY) == "TIMESTAMP_MICROS"
    cfg = LayerConfig(speed_path=f"{workdir}/speed", max_speed_files=1)
    speed_batch(clicks(spark, [("2024-01-01 00:00:01", "/a", "g"), ("2024-01-01 00:00:31", "/b", "g")]), 0, cfg,
                land=False)
    meta = pq.ParquetFile(glob.glob(f"{workdir}/speed/batch_id=0/*.parquet")[0]).metadata
    col = next(meta.row_group(0).column(i) for i in range(meta.num_columns)
               if meta.row_group(0).column(i).path_in_schema == "window.start")
    assert col.physical_type == "INT64" and col.statistics.has_min_max
    assert (col.statistics.min.second, col.statistics.max.second) == (0, 30)


def test_speed_file_cap_and_report_file_cap(spark, workdir):
    """R1: at most ``max_speed_files`` files per micro-batch folder; the report
    writer takes its own cap."""
    import glob

    from clickpulse.operators.totals import all_time_totals, with_report_date
    from clickpulse.sources.sinks import write_report

    rows = [(f"2024-01-01 00:{m:02d}:01", f"/p{m % 6}", "g") for m in range(60)]
    batch = clicks(spark, rows).repartition(8)
    cfg = LayerConfig(speed_path=f"{workdir}/speed", max_speed_files=2)
    speed_batch(batch, 0, cfg, land=False)
    assert 1 <= len(glob.glob(f"{workdir}/speed/batch_id=0/*.parquet")) <= 2
    report = with_report_date(all_time_totals(read_speed_view(spark, cfg.speed_path)).repartition(4), "2024-01-02")
    write_report(report, f"{workdir}/report", max_files=1)
    assert len(glob.glob(f"{workdir}/report/report_date=2024-01-02/*.orc")) == 1


def test_two_sinks_read_the_batch_once(spark, workdir):
    """R2: raw landing and window counts share one evaluation of the
    micro-batch (persisted), instead of reading and parsing it twice."""
    from pyspark.sql.types import StringType

    seen = spark.sparkContext.accumulator(0)

    def tap(page):  # test-only probe: counts evaluations of each row
        seen.add(1)
        return page

    probe = F.udf(tap, StringType())
    rows = [(f"2024-01-01 00:00:{s:02d}", "/a", "g") for s in range(20)]
    batch = clicks(spark, rows).withColumn("page", probe("page"))
    cfg = LayerConfig(speed_path=f"{workdir}/speed", raw_path=f"{workdir}/raw")
    speed_batch(batch, 0, cfg)
    assert spark.read.parquet(f"{workdir}/raw").count() == 20
    assert seen.value == 20


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_check_view_opens_only_batches_above_the_cut(spark, workdir):
    """The zones in markers and segments give the cut; results equal the full
    re-aggregation, with old batches compacted or not, and with a batch whose
    marker is missing."""
    from clickpulse.plans.check import newest_cut, speed_view, view_zones
    from clickpulse.plans.compact import compact_speed

    cfg = LayerConfig(speed_path=f"{workdir}/speed", max_speed_files=1)
    for b in range(8):  # run r1: two windows per batch, a late click in batch 5
        rows = [(f"2024-01-01 00:0{b}:01", "/a", "g"), (f"2024-01-01 00:0{b}:31", "/a", "g")]
        if b == 5:
            rows.append(("2024-01-01 00:02:12", "/b", "y"))
        speed_batch(clicks(spark, rows), b, cfg, land=False, run="r1")
    speed_batch(clicks(spark, [("2023-12-31 23:59:59", "/c", "g")]), 0, cfg, land=False, run="r0")
    speed_batch(clicks(spark, []), 8, cfg, land=False, run="r1")

    def same():
        view = read_speed_view(spark, cfg.speed_path)
        for n in (1, 2, 3, 5, 8, 30):
            for reagg in (True, False):
                full = latest_windows(reaggregate_speed(view) if reagg else view, n)
                assert _rows(speed_view(spark, cfg.speed_path, n, reaggregate=reagg)) == _rows(full), (n, reagg)

    same()
    zones = view_zones(spark, cfg.speed_path)
    assert sorted((z.run, z.batch, z.starts) for z in zones) == [("r0", 0, 1), *(("r1", b, 3 if b == 5 else 2) for b in range(8))]
    assert newest_cut(zones, 100) is None and newest_cut([], 1) is None
    # batches 6 and 7 hold three windows and more; the older ones are left out by their folders' names
    assert "(batch_id#" in _plan(speed_view(spark, cfg.speed_path, 3)) and "<= 5)" in _plan(speed_view(spark, cfg.speed_path, 3))
    compact_speed(spark, cfg.speed_path, keep_batches=4)
    compact_speed(spark, cfg.speed_path, keep_batches=4)  # folders go
    same()
    assert not any("_compacted" in f for f in speed_view(spark, cfg.speed_path, 2).inputFiles())
    spark.createDataFrame([], "done int").write.mode("overwrite").parquet(f"{cfg.speed_path}/_batches/run=r1/batch_id=7")
    same()


def test_cut_from_zones_that_overlap():
    from clickpulse.plans.check import Zone, newest_cut

    zones = [Zone(10, 40, 3), Zone(30, 60, 3), Zone(50, 60, 2), Zone(0, 5, 2)]
    assert [newest_cut(zones, n) for n in (1, 2, 3, 4, 5, 6, 7, 8)] == [50, 50, 30, 10, 10, 0, 0, None]


def test_file_cap_leaves_the_counts_their_tasks(spark, workdir):
    """The capped files are written by few tasks, the counts before them by as
    many as without a cap; also of a batch without rows."""
    import glob
    import re

    from clickpulse.sources.sinks import _capped, write_speed_batch

    rows = [(f"2024-01-01 00:{m:02d}:01", f"/p{m % 6}", "g") for m in range(60)]
    counts = window_counts(clicks(spark, rows), 10)
    for n in (1, 3):
        capped = _capped(counts, n)
        nodes = re.findall(r"Coalesce|Exchange \w+|HashAggregate", _plan(capped).split("== Physical Plan ==")[1])
        assert "Coalesce" not in nodes and nodes.index("HashAggregate") > 0 and nodes[0].startswith("Exchange"), nodes
        assert capped.rdd.getNumPartitions() <= n and sorted(_rows(capped)) == sorted(_rows(counts))
    for b, batch in enumerate((rows, [])):
        folder = write_speed_batch(window_counts(clicks(spark, batch), 10), f"{workdir}/speed", b, 1)
        assert len(glob.glob(f"{folder}/*.parquet")) == 1
        assert spark.read.parquet(folder).count() == len(batch)
