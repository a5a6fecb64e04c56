import random

import numpy as np
import pyarrow as pa
import pytest

from clickpulse.llm import wordhash
from tests.llm.brute import LETTERS, LOWER, SPACED


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    return ["".join(rng.choice("aB1 .\té\n日-\x00") for _ in range(rng.randint(0, 30))) for _ in range(1500)] + [None, "", "x" * 5000]


@pytest.mark.parametrize("table,pattern", [(wordhash.NOT_SPACE, SPACED), (wordhash.LETTER_OR_DIGIT, LETTERS)])
def test_words_and_shingles(texts, table, pattern):
    found = wordhash.words(pa.array(texts), table)
    split = [pattern.findall((t or "").translate(LOWER)) for t in texts]
    assert [(int(d), bytes(found.data[s:e]).decode()) for d, s, e in zip(found.doc, found.start, found.end)] == [
        (i, w) for i, ws in enumerate(split) for w in ws]
    name = {}
    for w, h in zip((w for ws in split for w in ws), found.hash.tolist()):
        assert name.setdefault(w, h) == h
    assert len(set(name.values())) == len(name)
    for k in (2, 3, 5):
        doc, value = wordhash.shingles(found, k)
        for i, ws in enumerate(split):
            want = {tuple(ws[j:j + k]) for j in range(len(ws) - k + 1)} or ({tuple(ws)} if ws else set())
            assert len(want) == int((doc == i).sum())
        assert len(doc) == len(set(zip(doc.tolist(), value.tolist())))


def test_slices_cover_all_rows_and_take_long_texts_alone():
    texts = pa.array(["a" * 10, None, "b" * 100, "", "c" * 10])
    parts = list(wordhash.slices(texts, 20))
    assert parts[0][0] == 0 and parts[-1][1] == 5 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    sliced = wordhash.text_bytes(texts.slice(2, 2))
    assert sliced[0].tobytes() == b"b" * 100 and sliced[1].tolist() == [0, 100, 100]
    assert list(wordhash.slices(pa.array([], pa.string()))) == []
    assert len(np.unique(wordhash.mix64(np.arange(1000, dtype=np.uint64)))) == 1000
