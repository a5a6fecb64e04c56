import hashlib
import math
import random

import numpy as np
import pytest

from clickpulse.llm.orchard import Codebook, compression_report, encode, quantised, train_codebooks

DDL = "vec_id long, embedding array<double>, label int"


def _plain(rows, scale=1024, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(x * scale) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), l) for i, v, l in kept]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda q, book: min((gap(q, e), n) for n, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(groups[n]) for c in zip(*groups[n])] if n in groups else e for n, e in enumerate(books[p])]
    coded = [(i, [near(cut(v, p), books[p]) for p in range(parts)], l) for i, v, l in kept]
    sums = {}
    for _, found, l in coded:
        sums[l] = sums.get(l, 0) + sum(d for d, _ in found)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found), sums[l], digest) for i, found, l in coded), key=repr)


@pytest.mark.parametrize("spread", [3, 1000])
def test_search_finds_the_nearest_entry_and_the_lower_of_ties(spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread, (200, 5))
    entries[50:60] = entries[0]
    points = np.concatenate([rng.integers(-spread, spread, (500, 5)), entries, np.full((1, 5), 10**6)])
    gaps = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    found, apart = Codebook(entries).nearest(points)
    assert (found == gaps.argmin(axis=1)).all() and (apart == gaps.min(axis=1)).all()


def _rows(n, dims, seed):
    rng = random.Random(seed)
    rows = [(i * 3, [rng.gauss(0, 0.2) for _ in range(dims)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [rows[5], rows[5], (1, rows[7][1], 2), (None, rows[8][1], None)]  # repeated rows, equal vectors, no id
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,dims", [(400, 8), (30, 6)])
def test_same_codes_as_plain_version(spark, n, dims):
    rows = _rows(n, dims, n)
    found = compression_report(spark.createDataFrame(rows, DDL).repartition(3))
    assert sorted(map(tuple, found.collect()), key=repr) == _plain(rows)


def test_odd_vectors(spark):
    rows = [(1, [1.0, -2.0, 0.5], 1), (2, None, 1), (3, [1.0, None], 1), (4, [math.nan], 1), (5, [math.inf], 1), (6, [], None), (7, [0.25], None)]
    found = compression_report(spark.createDataFrame(rows, DDL))
    assert sorted(map(tuple, found.collect()), key=repr) == _plain(rows)
    assert compression_report(spark.createDataFrame(rows[1:5], DDL)).count() == 0
    assert compression_report(spark.createDataFrame([(1, [], None)], DDL)).collect()[0].code == "00000000"
    with pytest.raises(ValueError):
        compression_report(spark.createDataFrame([(1, [1e30], None)], DDL))


def test_other_numbers_of_parts_and_entries(spark):
    terms = quantised(spark.createDataFrame(_rows(90, 9, 2), DDL))
    books = train_codebooks(terms, parts=3, entries=7, rounds=2)
    assert [b.entries.shape for b in books.books] == [(7, 3)] * 3
    assert all(len(r.code) == 6 for r in encode(terms, books).collect())
