"""Triggers that take several micro-batches at once (``batch_offsets``): each is
stored on its own, as if it had been a trigger of its own."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from clickpulse.config import LayerConfig
from clickpulse.functions.decode import parse_clicks
from clickpulse.plans import catalog
from clickpulse.plans import speed as plan
from clickpulse.plans.check import view_zones
from clickpulse.sources.kafka import read_record_files
from clickpulse.sources.storage import files_below, values
from clickpulse.sources.tables import read_speed_view
from clickpulse.streaming.speed import start_speed_layer
from tests.helpers import click, records
from tests.test_catalog import _canon

SIZE, PER_TRIGGER = catalog.RECORDS_PER_STORED_BATCH, 4
ROWS = 10 * SIZE + 7  # eleven micro-batches
QUERIES = ("all_time_totals", "speed_partials", "speed_files_capped", "check_speed_view", "batch_report", "latest_partials",
           "latest_windows", "report_top", "report_static_overwrite", "report_history", "check_stored_rows")


@pytest.fixture(scope="module")
def events(tmp_path_factory):
    folder = tmp_path_factory.mktemp("events")
    # every window holds records of all micro-batches
    duckdb.sql(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds((i * 7) % 600) AS ts, i % 13 AS user_id,
                         ['click', 'view', 'error'][i % 3 + 1] AS event_type, (i % 90)::DOUBLE AS value, '{{}}' AS props
                         FROM range({ROWS}) t(i)) TO '{folder}/events.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.fixture
def triggers(monkeypatch):
    """Numbers of the triggers that the speed layer ran, four micro-batches each."""
    ran, one = [], plan.speed_batch
    monkeypatch.setattr(plan, "speed_batch", lambda batch, n, *rest: (ran.append(n), one(batch, n, *rest)))
    monkeypatch.setattr(catalog, "RECORDS_PER_TRIGGER", PER_TRIGGER * SIZE)
    return ran


@pytest.mark.parametrize("name", QUERIES)
def test_query_over_triggers_of_several_micro_batches(spark, events, triggers, name):
    catalog.forget_stored_view(spark, events)
    df = entry_mod.queries()[name](spark, events)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{events}/events.parquet')")
    res = con.execute(entry_mod.oracle_sql()[name])
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon([d[0] for d in res.description], res.fetchall())
    assert triggers == [0, 1, 2]  # not eleven


def _stored(spark, path):
    rows = read_speed_view(spark, path).select(F.col("batch_id").cast("long"), "window", "page", "trafficSource", "count")
    return sorted(map(repr, rows.collect())), sorted((z.batch, z.low, z.high, z.starts) for z in view_zones(spark, path))


def _clicks(spark, first, last, unreadable=()):
    texts = [click("never" if i in unreadable else f"01-01-2024 00:{i % 7:02d}:{i % 60:02d}:000", page=f"/p{i % 3}")
             for i in range(first, last)]
    return records(spark, texts, start_offset=first)


def test_stored_as_by_triggers_of_one_micro_batch_each(spark, workdir):
    for i in range(4):  # files in the order of their times
        _clicks(spark, 10 * i, min(10 * i + 10, 35), unreadable=(3, 12)).coalesce(1).write.parquet(f"{workdir}/in/{i}")
    found = {}
    for name, size, files in (("one", None, 1), ("several", 10, 4)):
        cfg = LayerConfig(speed_path=f"{workdir}/{name}", raw_path=f"{workdir}/{name}-raw", batch_offsets=size)
        source = read_record_files(spark, f"{workdir}/in/*", max_files_per_trigger=files)
        for q in start_speed_layer(source, cfg, f"{workdir}/{name}-checkpoint", available_now=True):
            q.awaitTermination()
        raw = spark.read.parquet(cfg.raw_path).drop("run", "batch_id")
        found[name] = (*_stored(spark, cfg.speed_path), raw.columns, raw.count())
    assert found["several"] == found["one"] and len(found["one"][1]) == 4


def _batch(spark, first, last, unreadable=()):
    return parse_clicks(_clicks(spark, first, last, unreadable), keep=("offset",))


def test_a_trigger_run_again_adds_nothing(spark, workdir):
    cfg = LayerConfig(speed_path=f"{workdir}/view", batch_offsets=10)
    plan.speed_batch(_batch(spark, 0, 20), 0, cfg, run="r")
    plan.speed_batch(_batch(spark, 20, 40), 1, cfg, run="r")
    before = _stored(spark, cfg.speed_path)
    plan.speed_batch(_batch(spark, 20, 40), 1, cfg, run="r")
    assert _stored(spark, cfg.speed_path) == before and [z[0] for z in before[1]] == [0, 1, 2, 3]


def test_a_micro_batch_cut_by_two_triggers_is_an_error(spark, workdir):
    cfg = LayerConfig(speed_path=f"{workdir}/view", batch_offsets=10)
    plan.speed_batch(_batch(spark, 0, 15), 0, cfg, run="r")
    before = _stored(spark, cfg.speed_path)
    with pytest.raises(ValueError, match="micro-batch 1 is cut by two triggers"):
        plan.speed_batch(_batch(spark, 15, 30), 1, cfg, run="r")
    assert _stored(spark, cfg.speed_path) == before


def test_a_trigger_without_readable_times_leaves_an_empty_view(spark, workdir):
    cfg = LayerConfig(speed_path=f"{workdir}/view", batch_offsets=10)
    plan.speed_batch(_batch(spark, 0, 25, unreadable=range(25)), 0, cfg, run="r")
    assert _stored(spark, cfg.speed_path) == ([], [])
    assert values(spark, f"{cfg.speed_path}/run=r", "batch_id") == ["2"]


def test_ids_of_micro_batches_where_offsets_have_gaps(spark, tmp_path, triggers):
    # offsets of micro-batches 0, 3, 4 and 9
    duckdb.sql(f"""COPY (SELECT b * {SIZE} + i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i * 30) AS ts, i AS user_id,
                         'click' AS event_type, 1.0::DOUBLE AS value, '{{}}' AS props
                         FROM range(5) t(i), (VALUES (0), (3), (4), (9)) c(b)) TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    rows = entry_mod.queries()["speed_partials"](spark, str(tmp_path)).groupBy("batch_id").agg(F.sum("count")).collect()
    assert sorted(map(tuple, rows)) == [(0, 5), (3, 5), (4, 5), (9, 5)]


@pytest.mark.parametrize("cap", (1, 3, None))
def test_files_of_each_micro_batch_under_a_cap(spark, workdir, cap):
    own = spark.newSession()
    for key, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.shuffle.partitions", "8"),
                       ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        own.conf.set(key, value)
    cfg = LayerConfig(speed_path=f"{workdir}/view", batch_offsets=50, max_speed_files=cap)
    plan.speed_batch(_batch(own, 0, 200), 0, cfg, run="r")
    files = [len([f for f, _, _ in files_below(spark, f"{cfg.speed_path}/run=r/batch_id={n}") if f.endswith(".parquet")])
             for n in range(4)]
    # each shuffle partition leaves a file of each micro-batch, unless there is a cap
    assert all(n > 3 for n in files) if cap is None else max(files) == cap
    assert spark.read.parquet(cfg.speed_path).agg(F.sum("count")).first()[0] == 200


def test_without_a_cap_merged_partitions_leave_one_file(spark, workdir):
    cfg = LayerConfig(speed_path=f"{workdir}/view", batch_offsets=50)
    plan.speed_batch(_batch(spark, 0, 200), 0, cfg, run="r")
    for n in range(4):
        assert len([f for f, _, _ in files_below(spark, f"{cfg.speed_path}/run=r/batch_id={n}") if f.endswith(".parquet")]) == 1
