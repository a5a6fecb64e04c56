import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickpulse.llm.quality import LEAST_TEXTS, ORDER, Model, byte_grams, classify, drop_low_quality, score, thresholds, _discounts


class PlainModel:
    """The same model on dictionaries."""

    def __init__(self, texts):
        level = Counter()
        for t in texts:
            data = b"\0" * (ORDER - 1) + (t or "").encode()
            level.update(data[i:i + ORDER] for i in range(len(data) - ORDER + 1))
        self.counts, self.discounts = {}, {}
        for n in range(ORDER, 0, -1):
            self.counts[n] = level
            kinds = Counter(level.values())
            self.discounts[n] = _discounts(kinds)
            level = Counter(g[1:] for g in level)
        self.context = {n: {} for n in self.counts}
        for n, counts in self.counts.items():
            for g, c in counts.items():
                total, held = self.context[n].get(g[:-1], (0, 0.0))
                self.context[n][g[:-1]] = total + c, held + self.discounts[n][min(c, 3) - 1]

    def p(self, gram):
        p = 1 / 256
        for n in range(1, ORDER + 1):
            g = gram[ORDER - n:]
            if g[:-1] in self.context[n]:
                total, held = self.context[n][g[:-1]]
                c = self.counts[n].get(g, 0)
                own = max(c - self.discounts[n][min(c, 3) - 1], 0) / total if c else 0.0
                p = own + held / total * p
        return p

    def nats(self, text):
        data = b"\0" * (ORDER - 1) + (text or "").encode()
        grams = [data[i:i + ORDER] for i in range(len(data) - ORDER + 1)]
        return -sum(math.log(self.p(g)) for g in grams) / len(grams) if grams else None


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["an", "the", "er", "tion", "is", "é"]) for _ in range(rng.randint(1, 3)))
    good = [(i, " ".join(word() for _ in range(rng.randint(20, 60))).capitalize() + ".") for i in range(300)]
    bad = [(1000 + i, "".join(rng.choice("#%&$!?XYZQ ") for _ in range(200))) for i in range(30)]
    return good, bad


def test_model_and_scores_match_the_plain_model(spark, frame, corpus):
    good, bad = corpus
    plain = PlainModel([t for _, t in good])
    model = Model(spark.createDataFrame(good, "doc_id long, text string"))
    rows = [(d, t, "en") for d, t in good[:20] + bad[:5]] + [(2000, None, "en"), (2001, "", None), (2002, "\0\0 日", "en")]
    found = score(frame(rows, "doc_id long, text string, lang string"), model, block_bytes=1000).collect()
    assert len(found) == len(rows)
    for r in found:
        want = plain.nats(next(t for d, t, _ in rows if d == r.doc_id))
        assert (r.nats is None) == (want is None) and (want is None or abs(r.nats - want) < 1e-4)


def test_probabilities_of_a_context_sum_to_one(spark, corpus):
    model = Model(spark.createDataFrame(corpus[0], "doc_id long, text string"))
    for context in (b"the ", b"ione", b"\0\0\0\0", b"#%&$"):
        grams = spark.range(256).select((F.lit(int.from_bytes(context, "big") << 8) + F.col("id")).alias("gram"))
        total = model.log_probabilities(grams).agg(F.sum(F.exp("logp"))).first()[0]
        assert abs(total - 1) < 1e-3


def test_classifier_separates_held_out_texts(frame, corpus):
    good, bad = corpus
    docs = frame([(d, t, "en") for d, t in good + bad], "doc_id long, text string, lang string")
    trusted = frame([(d,) for d, _ in good[:250]], "doc_id long")
    found = {r.doc_id: r for r in classify(docs, trusted).collect()}
    assert not any(found[d].keep for d, _ in bad)
    unseen = [found[d].keep for d, _ in good[250:]]
    assert sum(unseen) >= 0.9 * len(unseen)
    left = drop_low_quality(docs.withColumns({"k1": F.lit(1), "keep": F.lit("x")}),
                            frame([(d, 1, 0) for d, _ in good[:250]], "doc_id long, quality int, toxic int"))
    assert left.columns == ["doc_id", "text", "lang", "k1", "keep"]
    assert {r.doc_id for r in left.collect()} == {d for d, r in found.items() if r.keep}


def test_small_table_accuracy(spark):
    from clickpulse.llm.queries import op6_quality_classifier
    from tests.conftest import SF_MID
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    found = op6_quality_classifier(spark, SF_MID).join(labels, "doc_id").filter("toxic = 0")
    right = {r.quality: r.share for r in found.groupBy("quality").agg(
        F.avg((F.col("keep") == (F.col("quality") == 1)).cast("double")).alias("share")).collect()}
    assert right[0] > 0.9 and right[1] > 0.97


def test_thresholds_by_language(spark):
    rows = [("en", i / 100) for i in range(LEAST_TEXTS * 2)] + [("xx", 9.0)] * (LEAST_TEXTS - 1) + [(None, 5.0)] * 3 + [("en", None)]
    found = {r.lang: r.threshold for r in thresholds(spark.createDataFrame(rows, "lang string, nats double"), 0.5).collect()}
    assert set(found) == {"en", None} and abs(found["en"] - 0.49) < 0.02


def test_no_trusted_text_keeps_all_texts(frame):
    docs = frame([(1, "some text", "en"), (2, "", "en"), (3, None, None)], "doc_id long, text string, lang string")
    found = {r.doc_id: r.keep for r in classify(docs, frame([(None,)], "doc_id long")).collect()}
    assert found == {1: True, 2: False, 3: False}


def test_byte_grams():
    gram, length = byte_grams(pa.array(["abcdef", None, "é"]))
    assert length.tolist() == [6, 0, 2] and gram[5] == int.from_bytes(b"bcdef", "big") and gram[6] == 0xC3
