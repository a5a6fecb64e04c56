"""Every registered query against its DuckDB SQL on the small tables."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


def test_every_query_has_sql():
    names = {q.name for q in entry_mod.CATALOG}
    assert names <= set(entry_mod.queries()) and names <= set(entry_mod.oracle_sql())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["page", "trafficSource", "sum_count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(q.name for q in entry_mod.CATALOG))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())
