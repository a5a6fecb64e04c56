"""Best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the longest sequence are cut into pieces of that length
and a rest. Pieces are dealt at random into shards of bounded size, and each
shard is packed by itself: pieces in order of falling length go to the open bin
that they leave the least room in; where none has room, the bin size opens that
costs least for each word it can be expected to hold, given what is left to
pack. That is tried with every permitted longest size and the cheapest packing
stays. In the end each bin shrinks to the smallest permitted size that holds
its contents.

Lengths may be numbers of words or of token ids; :func:`pack_tokens` encodes the
texts and writes each bin as one sequence of ids.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import save, word_count
from clickpulse.llm.tokenbin import END_ID, encoder
from clickpulse.llm.wordhash import slices

CAPACITIES = (512, 1024, 2048, 4096)
#: Pieces in a shard, about.
SHARD_PIECES = 20_000
#: Token ids in a shard, about: what a task holds.
SHARD_TOKENS = 4_000_000
SEED = 7


def sequence_cost(capacity: int) -> float:
    """Cost of one sequence: its length and, for attention, a share that grows
    with its square."""
    return capacity * (1 + capacity / 65_536)


def _open_size(length: int, left: int, sizes: Sequence[int], cost: Callable[[int], float]) -> int:
    """The size that costs least per word, for a piece and ``left`` words that
    may still join it."""
    fitting = [c for c in sizes if c >= length] or [sizes[-1]]
    return min(fitting, key=lambda c: (cost(c) / min(c, max(1, length + left)), -c))


def _best_fit(lengths: np.ndarray, sizes: Sequence[int], cost: Callable[[int], float]) -> tuple[np.ndarray, list[int]]:
    """Bin of each piece (``lengths`` falling), and the words in each bin."""
    left = int(lengths.sum())
    rooms: list[int] = []  # distinct rooms of open bins, rising
    open_bins: dict[int, list[int]] = {}
    held: list[int] = []
    chosen = np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        left -= length
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            bins = open_bins[room]
            number = bins.pop()
            if not bins:
                del open_bins[room], rooms[at]
        else:
            room, number = _open_size(length, left, sizes, cost), len(held)
            held.append(0)
        held[number] += length
        chosen[i] = number
        if (room := room - length) > 0:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append(number)
    return chosen, held


def pack(lengths: np.ndarray, capacities: Sequence[int] = CAPACITIES,
         cost: Callable[[int], float] = sequence_cost) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each piece, capacity of each bin). Pieces must fit the largest
    capacity; empty ones take no room."""
    sizes = sorted(capacities)
    order = np.argsort(-lengths, kind="stable")
    best = None
    for longest in range(1, len(sizes) + 1):
        # pieces beyond the sizes on trial open a bin of the largest size
        trial = sizes[:longest] if sizes[longest - 1] >= sizes[-1] else [*sizes[:longest], sizes[-1]]
        allowed = sizes[:longest]
        big = int(np.searchsorted(-lengths[order], -allowed[-1], side="left"))
        chosen, held = _best_fit(lengths[order][big:], allowed, cost)
        over, over_held = _best_fit(lengths[order][:big], trial, cost)
        fill = np.array(over_held + held, np.int64)
        shrunk = np.array(sizes)[np.searchsorted(sizes, fill)] if len(fill) else np.zeros(0, np.int64)
        total = sum(cost(int(c)) for c in shrunk)
        if best is None or total < best[0]:
            best = total, np.concatenate([over, chosen + len(over_held)]), shrunk
    bins = np.empty(len(lengths), np.int64)
    bins[order] = best[1]
    return bins, best[2]


def pieces(docs: DataFrame, longest: int) -> DataFrame:
    """(doc_id, piece, first_word, n_words) of ``docs`` (doc_id, n_words)."""
    count = F.greatest(F.ceil(F.col("n_words") / longest), F.lit(1))
    rows = docs.select("doc_id", "n_words", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("piece"))
    return rows.select("doc_id", "piece", (F.col("piece") * longest).alias("first_word"),
                       F.least(F.lit(longest).cast("long"), F.col("n_words") - F.col("piece") * longest).alias("n_words"))


_OUT = pa.schema([("piece_id", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()),
                  ("bin_id", pa.int64()), ("capacity", pa.int64()), ("bin_offset", pa.int64())])
_OUT_DDL = "piece_id long, doc_id long, piece long, first_word long, n_words long, bin_id long, capacity long, bin_offset long"


def pack_documents(docs: DataFrame, capacities: Sequence[int] = CAPACITIES,
                   cost: Callable[[int], float] = sequence_cost, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, n_words): its bin, the bin's
    capacity and where in it the piece begins.

    Repeated rows are packed as often as they occur. Null counts are 0; a
    document without words has one empty piece, which takes no room. An empty
    table gives no rows.
    """
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.coalesce(F.col("n_words"), F.lit(0)).cast("long").alias("n_words"))
    cut = save(pieces(counted, max(capacities)).withColumn("piece_id", F.monotonically_increasing_id()), "pack-pieces")
    return pack_pieces(cut, capacities, cost, shard_pieces).drop("piece_id")


def pack_pieces(cut: DataFrame, capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = sequence_cost,
                shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``cut`` (piece_id, doc_id, piece, first_word, n_words; a stored table) with
    bin_id, capacity and bin_offset."""
    shards = max(1, -(-cut.count() // shard_pieces))
    # by chance, not by id: a document that is repeated without end fills no shard
    dealt = cut.select(*_OUT.names[:5]).withColumn("shard", F.floor(F.rand(SEED) * shards))

    def run(table: pa.Table) -> pa.Table:
        # equal input gives equal output, in whatever order the rows arrive
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("piece_id", "ascending")])
        length = table.column("n_words").to_numpy()
        bins, size = pack(length, capacities, cost)
        order = np.argsort(bins, kind="stable")
        upto = np.cumsum(length[order]) - length[order]
        first = np.searchsorted(bins[order], bins[order], side="left")
        offset = np.empty(len(bins), np.int64)
        offset[order] = upto - upto[first]
        shard = table.column("shard").to_numpy()
        return pa.table([*(table.column(c) for c in _OUT.names[:5]), pa.array((shard << 32) + bins),
                         pa.array(size[bins].astype(np.int64)), pa.array(offset)], schema=_OUT)

    return dealt.groupBy("shard").applyInArrow(run, _OUT_DDL)


def pack_texts(docs: DataFrame, capacities: Sequence[int] = CAPACITIES) -> DataFrame:
    """:func:`pack_documents` by the number of words of each text (runs of
    characters other than ASCII white space; null: none)."""
    return pack_documents(docs.select("doc_id", word_count(F.col("text")).alias("n_words")), capacities)


def _cut(path: str, longest: int):
    """Texts -> pieces of their ids, with the end id, as bytes of the encoder's width."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        width, end = encode.dtype.itemsize, np.array([END_ID], encode.dtype).tobytes()
        for batch in batches:
            texts = batch.column("text")
            for first, last in slices(texts):
                found = [f + end for f in encode.encode_all(texts.slice(first, last - first).fill_null("").to_pylist())]
                n_ids = np.array([len(f) for f in found], np.int64) // width
                count = -(-n_ids // longest)
                row = np.repeat(np.arange(len(found)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                held = np.minimum(n_ids[row] - piece * longest, longest)
                ends = np.append(0, np.cumsum(held * width)).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(found))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(first + row)), pa.array(piece), pa.array(piece * longest),
                     pa.array(held), ids], names=["doc_id", "piece", "first_word", "n_words", "ids"])
    return run


def pack_tokens(docs: DataFrame, tokenizer: str, capacities: Sequence[int] = CAPACITIES,
                cost: Callable[[int], float] = sequence_cost, shard_pieces: int = SHARD_PIECES,
                shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per sequence: bin_id, capacity, n_tokens, ids (its tokens), and
    of the pieces in it, in order, doc_ids, first_tokens (where in its document
    each begins) and starts (where in the sequence).

    ``docs`` has doc_id and text; each text is encoded by the byte-level BPE
    tokenizer of the file ``tokenizer`` and ends with the end id, so null and
    empty texts are one id. Repeated rows are packed as often as they occur.
    The ids move once, as 16-bit numbers where the vocabulary allows it, to
    the shard that packs them; a shard holds about ``shard_pieces`` pieces or
    ``shard_tokens`` ids, whichever is less.
    """
    cut = save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _cut(tokenizer, max(capacities)), "doc_id long, piece long, first_word long, n_words long, ids binary").withColumn(
        "piece_id", F.monotonically_increasing_id()), "pack-tokens")
    total = cut.agg(F.count("*").alias("pieces"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("tokens")).first()
    shards = max(1, -(-total.pieces // shard_pieces), -(-total.tokens // shard_tokens))
    # by the piece's number, so that a document repeated without end fills no shard
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("piece_id", F.lit(SEED)), F.lit(shards)))

    def run(table: pa.Table) -> pa.Table:
        # equal input gives equal output, in whatever order the rows arrive
        known = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in ("doc_id", "piece", "piece_id")]).to_numpy()
        length = table.column("n_words").to_numpy()[known]
        bins, size = pack(length, capacities, cost)
        order = np.argsort(bins, kind="stable")
        table, length, bins = table.take(pa.array(known[order])), length[order], bins[order]
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        pieces_upto, upto = np.append(first, len(bins)), np.append(0, np.cumsum(length))
        raw = b"".join(table.column("ids").to_pylist())
        ids = np.frombuffer(raw, f"<u{len(raw) // int(upto[-1])}").astype(np.int32)
        lists = lambda upto, values: pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), values)
        of = lambda name: lists(pieces_upto, table.column(name).combine_chunks())
        starts = upto[:-1] - np.repeat(upto[first], np.diff(pieces_upto))
        shard = table.column("shard")[0].as_py()
        return pa.table({
            "bin_id": pa.array((shard << 32) + bins[first]), "capacity": pa.array(size[bins[first]].astype(np.int64)),
            "n_tokens": pa.array(np.diff(upto[pieces_upto])), "doc_ids": of("doc_id"), "first_tokens": of("first_word"),
            "starts": lists(pieces_upto, pa.array(starts)), "ids": lists(upto[pieces_upto], pa.array(ids))})

    return dealt.groupBy("shard").applyInArrow(run, "bin_id long, capacity long, n_tokens long, doc_ids array<long>, "
                                                    "first_tokens array<long>, starts array<long>, ids array<int>")
