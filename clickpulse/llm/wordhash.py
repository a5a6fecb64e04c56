"""Words and rolling word k-grams of Arrow text batches, as NumPy arrays.

Works on the UTF-8 bytes: the word classes used here are told apart by ASCII
characters only, and every byte of a longer character counts as a word byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256)
#: Bytes with A-Z mapped to a-z.
LOWERED = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: ``[^\x20\x09-\x0D]``
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lowering: digits, letters, and all beyond ASCII.
LETTER_OR_DIGIT = (((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
                   | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80))
#: Text bytes that one pass holds as arrays; one longer text makes a pass alone.
SLICE_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base (odd, modulo 2**64)."""
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _BASE)]), dtype=np.uint64)
    return _powers[:n]


@dataclass
class Words:
    """Words of ``n_docs`` texts in order: the text each is in, its byte range
    in ``data``, and a 64-bit hash of its (lowered) bytes."""

    n_docs: int
    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def position(self) -> np.ndarray:
        """Each word's number within its text, from 0."""
        first = np.cumsum(self.counts()) - self.counts()
        return np.arange(len(self.doc)) - first[self.doc]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its n + 1 offsets; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, is_word: np.ndarray, lower: bool = True) -> Words:
    data, offsets = text_bytes(texts)
    if lower:
        data = LOWERED[data]
    inside = is_word[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    before[begins] = False
    first = inside & ~before
    start = np.flatnonzero(first)
    at = np.flatnonzero(inside)
    # words end where their run does: at the next byte that is none, or the next start
    which = np.cumsum(first)[at] - 1
    length = np.bincount(which, minlength=len(start)) if len(start) else np.zeros(0, np.int64)
    value = np.zeros(0, np.uint64)
    if len(start):
        head = np.cumsum(length) - length
        codes = _CODE[data[at]] * _power(int(length.max()))[np.arange(len(at)) - head[which]]
        value = mix64(np.add.reduceat(codes, head) + length.astype(np.uint64))
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(len(texts), data, doc, start, start + length, value)


def kgrams(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of k words of one text."""
    n = len(found.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * _BASE + found.hash[i:i + n]
    at = np.flatnonzero(found.doc[:n] == found.doc[k - 1:k - 1 + n])
    return at, mix64(total[at])


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all word k-grams; a text of 1 to k - 1 words has its
    whole sequence as the only one. Sorted by text, then hash, without
    repetition: the texts' shingle sets."""
    at, value = kgrams(found, k)
    doc = found.doc[at]
    count = found.counts()
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        first = (np.cumsum(count) - count)[short]
        whole = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            more = count[short] > i
            whole[more] = whole[more] * _BASE + found.hash[first[more] + i]
        doc = np.concatenate([doc, short])
        value = np.concatenate([value, mix64(whole + count[short].astype(np.uint64))])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes of text each, at least one row."""
    size = text_bytes(texts)[1]
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(size, size[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last
        first = last
    # Arrow keeps what it has freed for later; a worker beside others gives it back
    pa.default_memory_pool().release_unused()
