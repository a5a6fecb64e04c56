"""run() of the pipeline against a plain version of its five stages."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickpulse.llm.packing import CAPACITIES
from clickpulse.llm.quality import HELD_OUT, LEAST_TEXTS, SPREADS, STEP, UPPER, _part
from clickpulse.llm.queries import TOKENIZER
from clickpulse.llm.secrets import RULES
from clickpulse.llm.tokenbin import END_ID, encoder
from tests.llm.brute import SPACED, near_duplicates
from tests.llm.test_mixing import _targets
from tests.llm.test_quality import PlainModel


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("an the er tion is é ou st".split()) for _ in range(rng.randint(1, 3)))
    rows = []
    for i in range(420):
        words = [word() for _ in range(rng.randint(15, 90))]
        if i % 9 == 0:
            words.insert(5, f"password={hashlib.md5(str(i).encode()).hexdigest()[:18]}")
        rows.append([i, " ".join(words), rng.choice(["en", "en", "fr"]), rng.choice(["a", "a", "a", "b", "c", None])])
    for i in range(40):  # near copies: one word changed
        words = rows[i + 100][1].split(" ")
        words[-1] = word()
        rows.append([1000 + i, " ".join(words), "en", "a"])
    rows += [[2000 + i, "".join(rng.choice("#%&$!? ") for _ in range(120)), "en", "b"] for i in range(15)]
    rows += [[3000, None, "en", "a"], [3001, "", None, None], [3002, rows[0][1], "en", "c"]]
    labels = [(r[0], 1, 0) for r in rows[:350]] + [(2000, 0, 0), (5, None, 0), (None, 1, 0)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], ddl).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, {d for d, q, _ in labels if q == 1 and d is not None}


def _quantile(weighted, q):
    """The step at which the running weight passes q of all."""
    upto, whole = 0, sum(weighted.values())
    for step in sorted(weighted):
        upto += weighted[step]
        if upto >= whole * (q - 1e-9):
            return step


def _limit(weighted):
    median, upper = _quantile(weighted, 0.5), _quantile(weighted, UPPER)
    return (upper + SPREADS * (upper - median) + 1) * STEP


def _quality(spark, rows, trusted):
    """Each text by a model of the trusted texts of the other parts; a
    language's threshold from its trusted texts, and where these are few from
    the likelier half of all its texts and its mirror image, too."""
    texts = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    part = {r.doc_id: r.part for r in texts.select("doc_id", _part(F.col("text")).alias("part")).collect()}
    models = [PlainModel([r[1] for r in rows if r[0] in trusted and part[r[0]] != p]) for p in range(HELD_OUT)]
    nats = {r[0]: models[part[r[0]]].nats(r[1]) for r in rows}
    step = lambda n: math.floor(n / STEP)
    scored = [r for r in rows if nats[r[0]] is not None]
    general = _limit(Counter(step(nats[r[0]]) for r in scored if r[0] in trusted))
    own = {}
    for lang in {r[2] for r in scored} - {None}:
        weighted = Counter(step(nats[r[0]]) for r in scored if r[2] == lang and r[0] in trusted)
        missing = LEAST_TEXTS - sum(weighted.values())
        if missing > 0:
            every = Counter(step(nats[r[0]]) for r in scored if r[2] == lang)
            median = _quantile(every, 0.5)
            half = {s: n for s, n in every.items() if s <= median}
            for s, n in half.items():
                for at in (s, 2 * median - s):
                    weighted[at] += missing * n / (2 * sum(half.values()))
        own[lang] = _limit(weighted)
    return [r for r in scored if nats[r[0]] <= own.get(r[2], general)]


def _masked(text):
    taken = sorted((m.start(), m.end()) for rule in RULES for m in re.finditer(rule.pattern, text, re.ASCII)
                   if len(m[rule.group]) >= rule.least)
    out, at = "", 0
    for a, b in taken:
        if a > at or at == 0:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:]


def _mixed(rows):
    size = lambda r: len(SPACED.findall(r[1]))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r)
    target, out = _targets(sizes), []
    for source in sizes:
        repeats = min(int(target[source] // sizes[source]), 3)
        left = 0 if repeats == 3 else target[source] - repeats * sizes[source]
        done = False
        for r in sorted((r for r in rows if r[3] == source),
                        key=lambda r: hashlib.md5(f"{r[0]}|{r[1]}".encode()).hexdigest()[:15]):
            more = 0
            if not done:
                done = size(r) > left
                more = int(not done or size(r) - left < left)
                left -= size(r)
            out += [r] * (repeats + more)
    return out


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near-dedup", "secret scans", "mixing", "best-fit packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_and_run_match_the_plain_version(spark, tables):
    path, rows, trusted = tables
    docs, want = spark.read.parquet(f"{path}/documents.parquet"), rows
    plain = [
        lambda some: _quality(spark, some, trusted),
        lambda some: [r for i, r in enumerate(some) if near[i][1] == r[0]],
        lambda some: [[r[0], _masked(r[1]), *r[2:]] for r in some],
        _mixed,
    ]
    for (name, stage), step in zip(corpus_pipeline.STAGES, plain):
        near = near_duplicates([(r[0], r[1]) for r in want], 5, 80)
        want = step(want)
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{path}/after-{name}")
        docs = spark.read.parquet(f"{path}/after-{name}")
        got = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
        assert sorted(got, key=str) == sorted((tuple(r[:4]) for r in want), key=str), name
    assert len(want) != len(rows) and not any("password=" in r[1] for r in want)
    last = corpus_pipeline.run(spark, path).collect()
    encode = encoder(public_tokenizers.path(TOKENIZER)).whole
    tokens, found = Counter(), Counter()
    for r in want:
        tokens[(r[0], tuple(np.frombuffer(encode(r[1]), "<u2").tolist()) + (END_ID,))] += 1
    for b in last:
        assert b.n_tokens == len(b.ids) and b.capacity == min(c for c in CAPACITIES if c >= len(b.ids))
        for doc, first, low, high in zip(b.doc_ids, b.first_tokens, b.starts, [*b.starts[1:], len(b.ids)]):
            assert high > low and first == 0  # these texts fit one sequence each
            found[(doc, tuple(b.ids[low:high]))] += 1
    assert found == tokens and sum(len(b.ids) for b in last) >= 0.9 * sum(b.capacity for b in last)
