import random

import numpy as np
import pytest

from clickpulse.llm.ngramjoin import NGramJoin, linked, make_leaf, ngram_join_report
from tests.llm.brute import jaccard, near_duplicates, shingle_set


def _answer(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect())


def _expected(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    found = near_duplicates(rows, k, percent)
    links = [sum(1 for j, b in enumerate(sets) if j != i and a and b and 100 * len(a & b) >= percent * len(a | b))
             for i, a in enumerate(sets)]
    return sorted((d, *found[i], links[i]) for i, (d, _) in enumerate(rows))


@pytest.fixture(scope="module")
def families():
    """Near copies of one text and of a short one, texts around one passage,
    texts of a few common words, exact copies."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(2000)]
    pick = lambda n: [rng.choice(vocabulary) for _ in range(n)]

    def edited(base, most):
        text = list(base)
        for _ in range(rng.randint(0, most)):
            text[rng.randrange(len(text))] = f"edit{rng.randrange(10**9)}"
        return " ".join(text)

    passage, long, short = pick(50), pick(160), pick(14)
    texts = [edited(long, 6) for _ in range(70)] + [edited(short, 1) for _ in range(30)]
    texts += [" ".join(passage + pick(rng.randint(2, 40))) for _ in range(60)]
    texts += [" ".join(rng.choice("a b c".split()) for _ in range(rng.randint(1, 12))) for _ in range(50)]
    texts += [" ".join(pick(rng.randint(1, 90))) for _ in range(40)] + ["the very same text here again"] * 25
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,percent", [(5, 80), (2, 60), (1, 100)])
def test_links_and_components_as_by_brute_force(frame, families, k, percent):
    assert _answer(ngram_join_report(frame(families), k, percent)) == _expected(families, k, percent)


@pytest.mark.parametrize("points,tokens,groups", [(1, 10, 4), (3, 200, 1), (100, 10**6, 512)])
def test_result_does_not_depend_on_leaves_and_groups(frame, families, points, tokens, groups):
    found = NGramJoin(frame(families), 5, 80, groups=groups, leaf_points=points, leaf_tokens=tokens).report()
    assert _answer(found) == _expected(families, 5, 80)


def _leaf(sets, copies=None):
    none = np.zeros(0, np.int64)
    rows = [(bytes([i]), len(x), (copies or {}).get(i, 1), np.array(x), none) for i, x in sets.items()]
    return make_leaf(rows, 16)


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 300, rng.integers(1, 200))) for _ in range(2))
        boxes = [np.array(_leaf({i: x})["box"]) for i, x in enumerate((a, b))]
        assert [x.sum() for x in boxes] == [len(a), len(b)]
        assert np.minimum(*boxes).sum() >= len(np.intersect1d(a, b))


def test_pair_of_leaves_counts_copies_and_names_the_least_class():
    sets = {0: range(0, 10), 1: range(0, 11), 2: range(50, 60)}
    found = linked(_leaf({2: sets[2], 1: sets[1]}, {1: 4}), _leaf({0: sets[0]}, {0: 7}), 8, 80)
    assert sorted((r["class"], r["root"], r["links"]) for r in found) == [(b"\0", b"\0", 4), (b"\1", b"\0", 7)]
    assert linked(_leaf({0: sets[0], 2: sets[2]}), None, 8, 80) == []


def test_a_whole_leaf_of_points():
    rng = np.random.default_rng(2)
    sets = {i: np.unique(rng.integers(0, 14, 12)) for i in range(64)}
    expected = {i: sum(j != i and 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for j, b in sets.items())
                for i, a in sets.items()}
    found = linked(_leaf(sets), None, 8, 80)
    assert {r["class"][0]: r["links"] for r in found} == {i: n for i, n in expected.items() if n}


def test_odd_rows(frame, odd_docs):
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.n_links) for r in ngram_join_report(frame(odd_docs)).collect()}
    assert found[(1, 0)] == (1, 0) and found[(2, 0)] == (2, 0) and found[(None, 0)] == (None, 0)
    assert found[(5, 1)] == found[(6, 1)] == (5, 1)
    assert found[(None, 1)] == (None, 1)  # two rows without an id, of one text
    assert jaccard(shingle_set("one", 5), shingle_set("one", 5)) == 1
    assert ngram_join_report(frame([], "doc_id long, text string")).count() == 0
