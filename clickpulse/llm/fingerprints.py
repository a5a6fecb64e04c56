"""Document fingerprints by one-permutation MinHash.

Each shingle is hashed once; the top bits choose one of ``BINS`` bins and the
rest is its value, of which a bin keeps the smallest. Empty bins borrow from a
filled one by optimal densification: every bin has its own random order of the
others, the same for all texts, and takes the first filled one. Stored are the
lowest ``BITS`` bits of each bin. Unequal bins agree by chance in 2**-BITS of
the cases, and the estimate takes that bias away.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import save
from clickpulse.llm.wordhash import NOT_SPACE, shingles, slices, words

BINS = 256
BITS = 4
SHINGLE = 5

_BIN_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
#: Row b: the order in which bin b tries the bins when it is empty.
_PROBES = np.stack([np.random.default_rng([2017, b]).permutation(BINS) for b in range(BINS)])


def sketch(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(texts, BINS) array of BITS-bit values, and which texts have any word."""
    doc, value = shingles(words(texts, NOT_SPACE), shingle)
    box = (value >> _BIN_SHIFT).astype(np.int64)
    # sorted by text and value, so the first of a bin is its smallest
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (box[1:] != box[:-1])
    low = np.zeros((len(texts), BINS), np.uint8)
    filled = np.zeros((len(texts), BINS), bool)
    low[doc[first], box[first]] = (value[first] & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    filled[doc[first], box[first]] = True
    known = filled.any(axis=1)
    row, col = np.nonzero(~filled & known[:, None])
    for turn in range(BINS):
        if not len(row):
            break
        donor = _PROBES[col, turn]
        hit = filled[row, donor]
        low[row[hit], col[hit]] = low[row[hit], donor[hit]]
        row, col = row[~hit], col[~hit]
    return low, known


def packed(low: np.ndarray, known: np.ndarray) -> list[str]:
    """The fingerprints as hexadecimal text; without words, empty."""
    bits = np.unpackbits(low[:, :, None], axis=2)[:, :, 8 - BITS:].reshape(len(low), -1)
    return [row.tobytes().hex() if k else "" for row, k in zip(np.packbits(bits, axis=1), known)]


def likeness(a: np.ndarray, a_known: np.ndarray, b: np.ndarray, b_known: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity, 0 to 1. Two texts without words are alike,
    one with and one without are not."""
    chance = 2.0 ** -BITS
    agree = ((a == b).mean(axis=1) - chance) / (1 - chance)
    return np.where(a_known & b_known, np.clip(agree, 0.0, 1.0), (a_known == b_known).astype(float))


_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_FOUND_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
_EDGE = [("part", pa.int32()), ("side", pa.string()), ("text", pa.string())]


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the
    start of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compare(ids: list, texts: list[str], following: list[str]) -> Iterator[pa.RecordBatch]:
    whole = pa.array(texts, pa.large_string())
    for first, last in slices(whole):
        own, nxt = texts[first:last], following[first:last]
        new = [edited(a, b) for a, b in zip(own, nxt)]
        (a, ka), (b, kb), (c, kc) = (sketch(pa.array(x, pa.large_string())) for x in (own, new, nxt))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[first:last], pa.int64()), pa.array([len(t) for t in own], pa.int64()),
             pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]), pa.array(packed(a, ka)),
             pa.array(packed(b, kb)), pa.array(likeness(a, ka, b, kb)), pa.array(likeness(a, ka, c, kc))], schema=_FOUND)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row of an ordered partition with the next one. The first
    and the last row also leave as edges, with their texts, for the partitions
    on either side."""
    schema = pa.schema([*_FOUND, *_EDGE])
    part = TaskContext.get().partitionId()

    def done(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, *(pa.nulls(batch.num_rows, t) for _, t in _EDGE)], schema=schema)

    def edge(side: str, doc_id, text: str) -> pa.RecordBatch:
        row = {"doc_id": doc_id, "part": part, "side": side, "text": text}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    held = None
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        texts = [t or "" for t in texts]
        if not ids:
            continue
        if held is None:
            yield edge("first", ids[0], texts[0])
        else:
            ids, texts = [held[0], *ids], [held[1], *texts]
        for found in _compare(ids[:-1], texts[:-1], texts[1:]):
            yield done(found)
        held = ids[-1], texts[-1]
    if held is not None:
        yield edge("last", *held)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _compare(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how
    alike its fingerprint is to the edited text's and the next document's.

    The next document is that of the next smaller doc_id (null ids last; equal
    ids by a hash of the text); after the last comes the first, and a single
    document follows itself. Null texts are empty. Rows are dealt by ranges of
    this order, so that neighbours meet within a partition; the partitions'
    edge rows, two for each, meet by a join.
    """
    # rows that are the same may lie in several ranges: a number tells them apart
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("nth"))
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text"), F.col("nth")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("nth")
    found = save(dealt.mapInArrow(_neighbours, _FOUND_DDL + ", part int, side string, text string"), "fingerprints")
    inner = found.filter(F.col("side").isNull()).select(*_FOUND.names)
    # one small row for each partition that has rows: the one that follows it
    parts = found.filter("side = 'first'").select(F.col("part").alias("next_part"))
    order = Window.orderBy("next_part")
    chain = parts.select("next_part", F.coalesce(
        F.lag("next_part", 1).over(order), F.max("next_part").over(Window.partitionBy())).alias("part"))
    last = found.filter("side = 'last'").select("doc_id", "text", "part")
    first = found.filter("side = 'first'").select(F.col("text").alias("following"), F.col("part").alias("next_part"))
    edges = (last.join(chain, "part").join(first, "next_part").select("doc_id", "text", "following")
             .mapInArrow(_pairs, _FOUND_DDL))
    return inner.unionByName(edges)
