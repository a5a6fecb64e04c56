"""Size of the micro-batches behind the queries whose rows are per micro-batch:
run as they are registered, without the small size that the other tests set."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PATH = os.pathsep.join(filter(None, (ROOT, os.environ.get("PYTHONPATH"))))
SIZE, ROWS = 5000, 10_007  # three micro-batches, the last one of seven records
BY_BATCH = ("speed_partials", "latest_partials", "check_stored_rows", "speed_files_capped")

RUN = """
import json, sys
import duckdb
from clickpulse.session import local_session
import __spark_entry__ as e

folder, names = sys.argv[1], sys.argv[2].split(",")
spark = local_session(4, 4, app="stored-batches")
plain = lambda rows: sorted(repr([str(v.replace(tzinfo=None)) if hasattr(v, "tzinfo") else v for v in r]) for r in rows)
found = {}
for name in names:
    df, sql = e.queries()[name](spark, folder), e.oracle_sql()[name]
    asked = duckdb.sql(sql.replace("FROM events", f"FROM '{folder}/events.parquet'"))
    found[name] = {"sql": sql, "batches": sorted({r.batch_id for r in df.collect()}), "rows": df.count(),
                   "same": plain(df.select(asked.columns).collect()) == plain(asked.fetchall())}
spark.stop()
print("FOUND", json.dumps(found))
"""


@pytest.fixture(scope="module")
def found(tmp_path_factory):
    import duckdb

    folder = tmp_path_factory.mktemp("stored")
    # every window holds records of all three micro-batches
    duckdb.sql(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds((i * 7) % 600) AS ts, i % 13 AS user_id,
                         ['click', 'view', 'error'][i % 3 + 1] AS event_type, (i % 90)::DOUBLE AS value, '{{}}' AS props
                         FROM range({ROWS}) t(i)) TO '{folder}/events.parquet' (FORMAT parquet)""")
    env = {k: v for k, v in os.environ.items() if k != "CLICKPULSE_RECORDS_PER_TRIGGER"} | {"PYTHONPATH": PATH}
    done = subprocess.run([sys.executable, "-c", RUN, str(folder), ",".join(BY_BATCH)], cwd=ROOT, env=env,
                          capture_output=True, text=True, timeout=600)
    lines = [x for x in done.stdout.splitlines() if x.startswith("FOUND ")]
    assert lines, done.stderr[-3000:]
    return json.loads(lines[0].removeprefix("FOUND "))


@pytest.mark.parametrize("name", BY_BATCH)
def test_rows_are_per_micro_batch_of_5000(found, name):
    assert f"// {SIZE} AS batch_id" in found[name]["sql"]
    assert found[name]["same"]


def test_stored_partials_of_every_micro_batch(found):
    assert found["speed_partials"]["batches"] == [0, 1, 2]
    assert found["speed_partials"]["rows"] > 2 * 60 * 12  # windows x (page, source), cut by each batch


@pytest.mark.parametrize("name", ("latest_partials", "check_stored_rows"))
def test_newest_stored_rows_come_from_several_micro_batches(found, name):
    assert found[name]["batches"][:2] == [0, 1] and found[name]["rows"] == 30


def test_files_are_counted_for_every_micro_batch(found):
    assert found["speed_files_capped"]["batches"] == [0, 1, 2] and found["speed_files_capped"]["rows"] == 3


@pytest.fixture(scope="module")
def found_with_large_triggers(tmp_path_factory):
    """The two views of stored rows under a trigger that would take the whole table."""
    import duckdb

    folder = tmp_path_factory.mktemp("large-triggers")
    # three copies of the same clicks under shifted ids, a micro-batch each
    duckdb.sql(f"""COPY (SELECT k * {SIZE} + i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i) AS ts, i % 13 AS user_id,
                         ['click', 'view', 'error'][i % 3 + 1] AS event_type, (i % 90)::DOUBLE AS value, '{{}}' AS props
                         FROM range({SIZE}) t(i), range(3) c(k)) TO '{folder}/events.parquet' (FORMAT parquet)""")
    names = ("latest_partials", "check_stored_rows")
    env = os.environ | {"CLICKPULSE_RECORDS_PER_TRIGGER": "1000000", "PYTHONPATH": PATH}
    done = subprocess.run([sys.executable, "-c", RUN, str(folder), ",".join(names)], cwd=ROOT, env=env,
                          capture_output=True, text=True, timeout=600)
    lines = [x for x in done.stdout.splitlines() if x.startswith("FOUND ")]
    assert lines, done.stderr[-3000:]
    return json.loads(lines[0].removeprefix("FOUND "))


@pytest.mark.parametrize("name", ("latest_partials", "check_stored_rows"))
def test_large_triggers_leave_the_stored_rows_per_micro_batch_of_5000(found_with_large_triggers, name):
    found = found_with_large_triggers[name]
    assert f"// {SIZE} AS batch_id" in found["sql"] and found["same"]
    assert found["batches"] == [0, 1, 2] and found["rows"] == 30
