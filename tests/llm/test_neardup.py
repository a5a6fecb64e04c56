import random

import pytest

from clickpulse.llm.components import components
from clickpulse.llm.neardup import NearDuplicates, drop_near_duplicates, least_shared, near_duplicate_report
from tests.llm.brute import near_duplicates


def _answer(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect() if r.doc_id is not None)


def _expected(rows, k, percent):
    found = near_duplicates(rows, k, percent)
    return sorted((d, *found[i], d == found[i][1]) for i, (d, _) in enumerate(rows) if d is not None)


def _family(rng, vocabulary, n_words, copies, edits, first_id):
    base = [rng.choice(vocabulary) for _ in range(n_words)]
    rows = []
    for i in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(n_words)] = f"edit{rng.randrange(10**9)}"
        rows.append((first_id + i, " ".join(text)))
    return rows


@pytest.fixture(scope="module")
def families():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows = _family(rng, vocabulary, 150, 60, 9, 1000) + _family(rng, vocabulary, 12, 25, 1, 2000)
    rows += [(3000 + i, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 40)))) for i in range(60)]
    rows += [(4000 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 80)))) for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_same_components_as_brute_force(frame, families, k, percent):
    assert _answer(near_duplicate_report(frame(families), k, percent)) == _expected(families, k, percent)


def test_long_lists_go_by_full_sets_and_pivots(frame, families):
    found = NearDuplicates(frame(families), 3, 85, longest_list=5, pivots=2).report()
    assert _answer(found) == _expected(families, 3, 85)


def test_whole_small_table(spark, read):
    rows = [(r.doc_id, r.text) for r in read("documents")]
    from tests.conftest import SF_SMALL
    found = near_duplicate_report(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert _answer(found) == _expected(rows, 3, 85)


def test_odd_rows(frame, odd_docs):
    found = near_duplicate_report(frame(odd_docs)).collect()
    assert len(found) == len(odd_docs)
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    for d in (1, 2, 3):
        assert (by[d].n_shingles, by[d].component_id, by[d].kept) == (0, d, True)
    assert by[6].component_id == 5 and not by[6].kept and by[5].kept
    nulls = [r for r in found if r.doc_id is None]
    assert all(r.component_id is None and r.kept for r in nulls)


def test_stage_keeps_one_of_each_group_and_all_columns(spark, frame, odd_docs):
    rows = [(d, t, f"x{d}", 7) for d, t in odd_docs]
    docs = frame(rows, "doc_id long, text string, class string, n long")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 6 not in ids and {1, 2, 3, 5, 7, 8} <= set(ids) and ids.count(4) == 1
    assert drop_near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_least_shared():
    assert 30 < least_shared(85) < 54 and least_shared(80) < least_shared(85)


def test_one_of_each_group_stays_also_of_repeated_rows(frame):
    text, near = "a b c d e f g h i j k l m n o p q r s t", "a b c d e f g h i j k l m n o p q r s t u"
    rows = [(1, text, i) for i in range(3)] + [(1, near, 9)] + [(None, "x y z u v", i) for i in range(4)] + [(5, "", 0), (5, "", 0)]
    rows += [(None, near, 3), (7, "alone on a page of its own", 1)]
    kept = drop_near_duplicates(frame(rows, "doc_id long, text string, first int")).collect()
    assert sorted((r.doc_id or 0, r.text in (text, near)) for r in kept) == [(0, False), (1, True), (5, False), (5, False), (7, False)]
    assert kept[0].asDict().keys() == {"doc_id", "text", "first"}
