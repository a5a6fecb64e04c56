import random

from clickpulse.llm.licenses import BASE_TEMPLATES, MORE_TEMPLATES, in_order, places, scan_licenses
from tests.llm.brute import LETTERS, LOWER


def _base(text):
    words = LETTERS.findall((text or "").translate(LOWER))
    found = [(t.label, i) for t in BASE_TEMPLATES for i in places(t.words, words)]
    starts = [i for _, i in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for x, _ in found}))


def _check(frame, rows):
    found = scan_licenses(frame(rows)).collect()
    got = sorted(((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=str)
    assert got == sorted((_base(t) for _, t in rows), key=str)
    return {r.doc_id: r for r in found}


def test_base_places_match_brute_force(frame, odd_docs):
    rng = random.Random(3)
    pool = "mit license apache general public the License, GENERAL MIT-License x y".split()
    rows = odd_docs + [(500 + i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 200)))) for i in range(80)]
    rows += [(900, "mit license " * 3000), (901, "general public general public license"), (902, "mit\x00license")]
    found = _check(frame, rows)
    assert found[900].n_base == 3000 and found[900].last_word == 2 * 2999
    assert all(0 <= r.score <= 1 for r in found.values())
    assert found[7].base_labels == "mit" and found[7].score == 1.0 and found[1].labels == "" and found[1].score == 0.0


def test_wordings_are_found_with_small_changes(frame):
    filler = " ".join(f"w{i}" for i in range(50))
    rows = []
    for i, t in enumerate(MORE_TEMPLATES):
        words = t.words
        changed = words[:len(words) // 2] + (["really"] if len(words) > 8 else []) + words[len(words) // 2:]
        rows.append((i, f"{filler} {' '.join(changed).upper()} {filler}"))
    rows += [(100, f"{filler} this software and or modify of this {filler}"), (101, filler)]
    found = _check(frame, rows)
    for i, t in enumerate(MORE_TEMPLATES):
        assert t.label in found[i].labels.split(","), t
        assert found[i].score >= 0.8
    assert found[100].labels == "" and found[101].score == 0.0


def test_whole_small_table(spark, read):
    from tests.conftest import SF_SMALL
    rows = [(r.doc_id, r.text) for r in read("documents")]
    found = scan_licenses(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    assert {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found} == {
        (d, *_base(t)) for d, t in rows}
    assert any(r.n_base for r in found)


def test_in_order():
    assert in_order("a b c d".split(), "x a b y d".split()) == 3 and in_order(["a"], []) == 0
