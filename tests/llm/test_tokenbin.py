import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickpulse.llm.queries import TOKENIZER
from clickpulse.llm.tokenbin import UnitEncoder, read_tokens, token_report, write_tokens


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


def _expected(rows, tokenizer):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_unit_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(3)
    parts = ["cat,", "dog***", "x.", ",", " ", "  ", "\n", "\t", "\r", "a", "the", " the", "é", "日本", "1", "!", "'s", "don't",
             "<|endoftext|>", "\x1c", "\x85", "\xa0", "​", "　", "A", "…", "\x00"]
    encoder = UnitEncoder(public_tokenizers.path(TOKENIZER))
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    texts += ["", " ", "\n", "\n\n\n", "a\n", " a", "a ", "the cat\nThe dog,\n\nend"]
    for first in range(0, len(texts), 100):
        some = texts[first:first + 100]
        assert encoder.encode_all(some) == [encoder.whole(t) for t in some]
    assert encoder.whole("a b") == np.array(tokenizer.encode("a b").ids, "<u2").tobytes()


def test_whole_small_table(spark, read, tokenizer):
    from tests.conftest import SF_SMALL
    found = token_report(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), public_tokenizers.path(TOKENIZER)).collect()
    assert sorted(map(tuple, found)) == _expected([(r.doc_id, r.text) for r in read("documents")], tokenizer)


def test_odd_rows(frame, odd_docs, tokenizer):
    rows = [r for r in odd_docs if r[0] is not None and r[0] != 4] + [(None, "same"), (None, "same")]
    found = token_report(frame(rows), public_tokenizers.path(TOKENIZER)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(_expected(rows, tokenizer), key=str)


def test_files_hold_ids_in_order_and_offsets(spark, frame, tokenizer, tmp_path):
    path, rows = public_tokenizers.path(TOKENIZER), [(i * 7 % 101, f"text number {i}, of many") for i in range(101)]
    files = write_tokens(frame(rows), str(tmp_path / "ids"), path)
    listed = sorted(files.collect(), key=lambda r: r.part)
    ids = np.concatenate([np.fromfile(tmp_path / "ids" / f"ids-{r.part:06d}.bin", "<u2") for r in listed])
    starts = np.concatenate([np.fromfile(tmp_path / "ids" / f"offsets-{r.part:06d}.bin", "<u8")[:-1] for r in listed])
    docs = np.concatenate([np.fromfile(tmp_path / "ids" / f"docs-{r.part:06d}.bin", "<i8") for r in listed])
    want = _expected(rows, tokenizer)
    assert docs.tolist() == [w[0] for w in want] and starts.tolist() == [w[1] for w in want]
    assert sum(w[2] for w in want) == len(ids) == sum(r.n_ids for r in listed)
    assert not [p.name for p in (tmp_path / "ids").iterdir() if p.name.startswith("_")]
    again = write_tokens(frame(rows), str(tmp_path / "ids"), path)  # a second run replaces the files
    assert sorted(map(tuple, read_tokens(again, str(tmp_path / "ids"), "<u2").collect())) == want
