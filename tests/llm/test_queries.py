"""The registered queries: names, SQL where there is some, and odd tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from clickpulse.llm.queries import QUERIES, SQL
from tests.conftest import SF_SMALL
from tests.test_catalog import _canon

OTHERS = ("op1_", "op2_", "op3_", "op4_", "op5_", "op6_", "op7_", "pipeline")


def test_fourteen_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
    assert set(SQL) == {n for n in QUERIES if not n.startswith(OTHERS)}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    found = QUERIES[name](spark, SF_SMALL)
    res = con.execute(SQL[name])
    assert _canon(found.columns, [tuple(r) for r in found.collect()]) == _canon([d[0] for d in res.description], res.fetchall())


@pytest.fixture
def odd_dir(spark, tmp_path, odd_docs):
    """Tables with odd rows and with columns named like those of the operators."""
    rows = [(d, t, ("en", None, "fr")[i % 3], (None, "a", "b", "a")[i % 4], None, "x", 1, "y") for i, (d, t) in enumerate(odd_docs)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "kept string, size long, class string")
    docs.write.parquet(f"{tmp_path}/odd/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    vectors = [(i, [0.1 * i, -0.2, float(i % 3)], "z") for i in range(120)]
    vectors += [(None, [1.0, 1.0, 1.0], "n"), (500, None, "n"), (550, [1.0, None, 2.0], "n"), (600, [float("nan"), 1.0, 1.0], "n"),
                (650, [float("inf"), 1.0, 1.0], "n"), (700, [], "e"), (50, [0.5, 0.5, 0.5], "again"), (3, [9.0], "short")]
    vectors = [(*v, (None, 1, 2)[i % 3]) for i, v in enumerate(vectors)]
    emb = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score string, label int")
    emb.write.parquet(f"{tmp_path}/odd/embeddings.parquet")
    emb.limit(0).write.parquet(f"{tmp_path}/empty/embeddings.parquet")
    said = [(c, t, ("user", None, "assistant")[t % 3], (f"turn {t} {c % 2}", "", None, "same")[(c + t) % 4], 1, "p")
            for c in (0, 1, 2, 3, 100, 101, 150, 205, -7, -100, -205) for t in range(c % 7)]
    said += [(0, None, "user", "no number", 1, "p"), (0, None, "user", "none either", 1, "p"), (None, 0, "user", "whose?", 1, "p"),
             (3, 1, "user", "again", 1, "p"), (3, 1, "user", "again", 1, "p"), (3, 0, None, None, 1, "p"),
             (101, 9, "user", "long é日 " * 20_000, 1, "p")]
    conv = spark.createDataFrame(said, "conv_id long, turn long, role string, text string, depth int, parent string")
    conv.write.parquet(f"{tmp_path}/odd/conversations.parquet")
    conv.limit(0).write.parquet(f"{tmp_path}/empty/conversations.parquet")
    labels = spark.createDataFrame([(10 + i, 1, 0) for i in range(30)] + [(5, 0, 0), (None, 1, 0), (7, None, None)],
                                   "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/odd/labels.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/empty/labels.parquet")
    return str(tmp_path)


PER_DOCUMENT = ("op2_license_scans", "op3_token_binary", "op4_fingerprints", "op5_minhash_dedup", "op6_quality_classifier",
                "op8_secret_scans", "op9_mixing", "op11_ngram_join")


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("op") or n == "pipeline"))
def test_odd_and_empty_tables(spark, odd_dir, odd_docs, name):
    found = entry.queries()[name](spark, f"{odd_dir}/odd").collect()
    assert found
    if name in PER_DOCUMENT:
        assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, _ in odd_docs)
    assert entry.queries()[name](spark, f"{odd_dir}/empty").count() == 0


@pytest.mark.parametrize("name", ["op9_mixing", "op8_secret_scans", "op11_ngram_join", "op12_prefix_trie",
                                  "op13_vector_codes", "op10_topk"])
def test_odd_tables_match_sql(spark, odd_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{odd_dir}/odd/{t}.parquet/*.parquet')")
    found = QUERIES[name](spark, f"{odd_dir}/odd")
    res = con.execute(SQL[name])
    assert _canon(found.columns, [tuple(r) for r in found.collect()]) == _canon([d[0] for d in res.description], res.fetchall())
