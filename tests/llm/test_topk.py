import math
import random

import numpy as np

from clickpulse.llm.topk import quantised, top_k

DDL = "vec_id long, embedding array<float>"


def _brute(rows, asks, k):
    out = []
    for n, (q, qv) in enumerate(rows):
        if not asks(q):
            continue
        others = [(-sum(a * b for a, b in zip(qv, v)), i is None, i) for m, (i, v) in enumerate(rows) if m != n]
        best = sorted(others, key=lambda o: (o[0], o[1], o[2] or 0))[:k]
        out += [(q, rank + 1, i, -s) for rank, (s, _, i) in enumerate(best)]
    return sorted(out, key=repr)


def _found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_blocks_ties_and_odd_vectors(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([0.0, 0.0, 0.5, -0.25, rng.uniform(-2, 2)]) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(20)] + [(400, []), (401, [1.0]), (7, [9.0] * 6), (None, [1.0] * 6)]
    skipped = [(2000, None), (2001, [None, 1.0]), (2002, [math.nan, 1.0]), (2003, [math.inf])]
    terms = quantised(spark.createDataFrame(rows + skipped, DDL))
    exact = [(i, [math.floor(float(np.float32(x)) * 256) for x in v]) for i, v in rows]
    assert _found(terms) == sorted(((i, v) for i, v in exact), key=repr)
    found = top_k(terms, "id % 10 = 0", 4, row_block=50, query_block=9)
    assert _found(found) == _brute(exact, lambda i: i is not None and i % 10 == 0, 4)


def test_every_row_asks_and_is_a_candidate(spark):
    """One id with two vectors, a row without an id, rows that are the same."""
    rows = [(50, [1.0, 0.0]), (50, [0.0, 5.0]), (None, [9.0, 9.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0])]
    rows += [(100, [3.0, 3.0])] * 7 + [(None, [9.0, 9.0])]
    exact = [(i, [math.floor(x * 256) for x in v]) for i, v in rows]
    for k in (1, 3, 5, 20):
        found = top_k(quantised(spark.createDataFrame(rows, DDL)), "id % 50 = 0", k, row_block=2, query_block=1)
        assert _found(found) == _brute(exact, lambda i: i is not None and i % 50 == 0, k), k


def test_fewer_rows_than_k(spark):
    terms = quantised(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>"))
    assert [tuple(r) for r in top_k(terms, "id = 0", 5).collect()] == [(0, 1, 1, 256 * 512)]
    assert top_k(terms.limit(0), "id = 0", 5).count() == 0
    assert top_k(terms.filter("id = 0"), "id = 0", 5).count() == 0
