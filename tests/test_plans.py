"""Plan checks: shuffles, pruning, single parse, no Python in the plan."""

import pytest

from clickpulse.functions.decode import parse_clicks
from clickpulse.operators.windows import window_counts
from clickpulse.plans.catalog import CATALOG
from clickpulse.sources.replay import click_records, read_events
from tests.conftest import SF_SMALL

STREAMING = {"stream_final_counts", "speed_stream_windows", "speed_stream_totals", "raw_landing",
             "page_visits_stream", "page_stats_stream", "spend_stream_report", "spend_stream_report_error",
             "speed_files_capped", "report_incremental"}
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_window_count_has_one_exchange(spark):
    df = window_counts(parse_clicks(click_records(read_events(spark, SF_SMALL))), 10)
    plan = executed(df)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan


def test_json_is_parsed_once(spark):
    df = window_counts(parse_clicks(click_records(read_events(spark, SF_SMALL))), 10)
    assert optimized(df).count("from_json") == 1


def test_scan_reads_only_needed_columns(spark):
    by_name = {q.name: q for q in CATALOG}
    plan = executed(by_name["spend_rows"].build(spark, SF_SMALL))
    read_schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "props" not in read_schema and "event_type" not in read_schema


@pytest.mark.parametrize("q", [q for q in CATALOG if q.name not in STREAMING], ids=lambda q: q.name)
def test_no_python_in_plan(spark, q):
    plan = executed(q.build(spark, SF_SMALL))
    assert not any(node in plan for node in PYTHON_NODES)


def test_top_k_not_global_sort(spark):
    by_name = {q.name: q for q in CATALOG}
    plan = executed(by_name["latest_windows"].build(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("q", [q for q in CATALOG if q.name not in STREAMING], ids=lambda q: q.name)
def test_every_shuffle_is_pre_aggregated(spark, q):
    """A key holding a third of all rows must cross a shuffle as one partial
    row per task: every exchange is a hash exchange on a partial aggregate."""
    lines = [line.strip() for line in executed(q.build(spark, SF_SMALL)).split("\n")]
    for i, line in enumerate(lines):
        if "Exchange" not in line:
            continue
        child = lines[i + 1]
        assert "hashpartitioning" in line and "Aggregate" in child and "partial_" in child, (line, child)
