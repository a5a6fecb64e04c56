"""Thresholds of the quality classifier: cross-fitted scores and a rule that outliers cannot set."""

import random

import pytest
from pyspark.sql import functions as F

from clickpulse.llm.quality import HELD_OUT, LEAST_TEXTS, Model, _part, classify, score, thresholds
from tests.llm.test_quality import PlainModel


def _words(rng, parts, least=20, most=60):
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(least, most)))


def test_each_text_is_scored_by_the_models_of_the_other_parts(spark, frame):
    rng = random.Random(11)
    texts = [(i, _words(rng, ["an", "the", "er", "é"])) for i in range(60)]
    rows = [(i, t, "en") for i, t in texts] + [(100, texts[0][1], "en"), (101, "#? zz", None), (102, "", "en")]
    docs = frame(rows, "doc_id long, text string, lang string")
    part = {r.doc_id: r.part for r in docs.select("doc_id", _part(F.col("text")).alias("part")).collect()}
    assert len(set(part.values())) == HELD_OUT and part[0] == part[100]
    plain = [PlainModel([t for d, t in texts if part[d] != p]) for p in range(HELD_OUT)]
    trained = spark.createDataFrame(texts, "doc_id long, text string").select("text", _part(F.col("text")).alias("part"))
    found = {r.doc_id: r.nats for r in score(docs, Model(trained, HELD_OUT), block_bytes=1000).collect()}
    assert len(found) == len(rows)
    for d, t, _ in rows:
        want = plain[part[d]].nats(t)
        assert (found[d] is None) == (want is None) and (want is None or abs(found[d] - want) < 1e-4)


@pytest.mark.parametrize("outliers", [1, 3])
def test_outliers_do_not_set_a_threshold(spark, outliers):
    rows = [("en", 1 + i / 1000) for i in range(LEAST_TEXTS + 10)]
    plain, other = ({r.lang: r.threshold for r in thresholds(spark.createDataFrame(x, "lang string, nats double")).collect()}
                    for x in (rows, rows[:-outliers] + [("en", 9.0)] * outliers))
    assert plain == other and 1.06 < plain["en"] < 1.2


def test_bad_texts_go_where_one_trusted_text_is_an_outlier(frame):
    rng = random.Random(4)
    good = [(i, _words(rng, ["an", "the", "er", "is"])) for i in range(100)]
    rows = [(d, t, "en") for d, t in good]
    rows += [(500, "#%&$!?XYZQ " * 8, "en")]  # trusted by mistake
    rows += [(1000 + i, "".join(rng.choice("abcdefghijklmnop ") for _ in range(200)), "en") for i in range(20)]
    docs = frame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.keep for r in classify(docs, frame([(i,) for i in [*range(100), 500]], "doc_id long")).collect()}
    assert not any(found[1000 + i] for i in range(20)) and not found[500]
    assert sum(found[i] for i in range(100)) >= 97


def test_rates_on_the_large_table(spark):
    from clickpulse.llm.queries import op6_quality_classifier
    sf = "/root/testdata/sf0.1"
    found = op6_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rates = {r.lang: r for r in found.filter("n_bytes > 0").groupBy("lang").agg(
        F.avg(F.when(F.col("quality") == 0, F.col("keep").cast("double"))).alias("bad_kept"),
        F.avg(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1 - F.col("keep").cast("double"))).alias("clean_gone")).collect()}
    assert set(rates) == {"de", "en", "es", "fr"}
    assert all(r.bad_kept < 0.12 and r.clean_gone < 0.03 for r in rates.values()), rates


def test_each_language_has_its_own_threshold_at_any_size(spark, frame):
    rng = random.Random(9)
    parts = {"en": ["an", "the", "er"], "fr": ["ou", "ê", "le", "qu"], "es": ["ción", "ñ", "rr", "ja", "mi"]}
    rows = [(1000 * i + n, _words(rng, p), lang) for i, (lang, p) in enumerate(parts.items()) for n in range(40)]
    trusted = [(d,) for d, _, lang in rows if lang != "es" and d % 1000 < 30]  # fewer than LEAST_TEXTS each
    rows += [(5000, "#%&$!?XYZQ " * 9, "en"), (5001, "#%&$!?XYZQ " * 9 + "!", "fr"), (5002, _words(rng, parts["en"]), None)]
    docs = frame(rows, "doc_id long, text string, lang string")
    found = classify(docs, frame(trusted, "doc_id long")).collect()
    limits = {lang: {r.threshold for r in found if r.lang == lang} for lang in [*parts, None]}
    assert all(len(x) == 1 for x in limits.values()) and len({min(x) for x in limits.values()}) == 4
    gone = {r.doc_id for r in found if not r.keep}
    assert gone >= {5000, 5001} and len(gone) <= 6 and not any(2000 <= d < 3000 for d in gone)
    assert all(r.keep for r in found if r.lang is None)


def test_missing_trusted_texts_are_made_up_for(spark):
    ddl = "lang string, nats double"
    others = [("xx", 2 + i / 100) for i in range(100)] + [("yy", 4 + i / 100) for i in range(10)] + [(None, 1.0), ("xx", None)]
    trusted = [("en", 1 + i / 1000) for i in range(LEAST_TEXTS)] + [("xx", 2.3)] * 20
    found = {r.lang: r.threshold for r in thresholds(spark.createDataFrame(trusted, ddl), 0.5, others=spark.createDataFrame(
        others + trusted, ddl)).collect()}
    assert set(found) == {"en", "xx", "yy", None}
    # 20 texts at 2.3, and 30 dealt over the 120 of xx
    assert abs(found["en"] - 1.025) < 0.002 and abs(found["xx"] - 2.3) < 0.002 and abs(found["yy"] - 4.04) < 0.011
