"""Vector code compression: product codebooks searched by Orchard's method.

Vectors become integers, floor(scale * x), and are cut into parts of equal
length. Each part position has a codebook. The nearest entry of a part is found
by Orchard's search: every entry keeps a list of all entries by distance from
it. From a first entry its list is walked; where an entry is nearer to the part
than the current one, the walk goes on in that entry's list. Entries looked at
once are marked and not looked at again. As soon as the next entry of the list
is further from the current one than twice the current distance, no other can
be nearer. All of it is exact, in 64-bit integers.

A round of training reads all vectors; each task sums its parts by entry, so
what is shuffled and sent to the driver are sums of a few entries, never rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import maybe_broadcast, save

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Scaled components up to this size keep squared distances within 64 bits.
LARGEST = 1 << 26
#: Entries of a list that a search looks at in one step.
STEP = 8
#: Vectors that are searched together.
TOGETHER = 8192


@dataclass
class Codebook:
    """The entries of one part position, with every entry's list: all entries
    (``order``) by their squared distance from it (``apart``)."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        self.entries = self.entries.astype(np.int64)
        apart = np.array([((self.entries - e) ** 2).sum(axis=1) for e in self.entries])
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        self.norms = np.sqrt((self.entries.astype(np.float64) ** 2).sum(axis=1))
        self.by_norm = np.argsort(self.norms, kind="stable")

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each point's nearest entry, ties to the
        lower index. The walk starts at an entry of about the same norm."""
        size = len(self.entries)
        norm = np.sqrt((points.astype(np.float64) ** 2).sum(axis=1))
        place = np.searchsorted(self.norms[self.by_norm], norm)
        now = self.by_norm[np.minimum(place, size - 1)]
        least = ((points - self.entries[now]) ** 2).sum(axis=1)
        seen = np.zeros((len(points), size), bool)
        seen[np.arange(len(points)), now] = True
        at = np.zeros(len(points), np.int64)
        walking = np.arange(len(points))
        while len(walking):
            places = at[walking, None] + np.arange(STEP)
            inside = places < size
            places = np.minimum(places, size - 1)
            # beyond twice the distance, i.e. four times its square, nothing is nearer
            inside &= self.apart[now[walking, None], places] <= 4 * least[walking, None]
            go = inside[:, 0]
            walking, places, inside = walking[go], places[go], inside[go]
            entry = self.order[now[walking, None], places]
            fresh = inside & ~seen[walking[:, None], entry]
            row, col = np.nonzero(fresh)
            seen[walking[row], entry[row, col]] = True
            far = np.full(entry.shape, np.iinfo(np.int64).max)
            far[row, col] = ((points[walking[row]] - self.entries[entry[row, col]]) ** 2).sum(axis=1)
            best = far.min(axis=1, initial=np.iinfo(np.int64).max)
            which = np.where(far == best[:, None], entry, size).min(axis=1, initial=size)
            at[walking] += STEP
            better = (best < least[walking]) | ((best == least[walking]) & (which < now[walking]))
            moved = walking[better]
            now[moved], least[moved], at[moved] = which[better], best[better], 0
        return now, least


@dataclass
class Codebooks:
    """One codebook for each part position; ``width`` components each."""

    books: list[Codebook]
    width: int

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position."""
        flat = np.concatenate([b.entries.ravel() for b in self.books]) if self.books else []
        return hashlib.sha256(",".join(str(int(x)) for x in flat).encode()).hexdigest()

    def encoded(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, summed squared distances) of rows of whole vectors."""
        found = [b.nearest(vectors[:, i * self.width:(i + 1) * self.width]) for i, b in enumerate(self.books)]
        return np.stack([f[0] for f in found], axis=1), np.sum([f[1] for f in found], axis=0)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
              scale: int = SCALE) -> DataFrame:
    """(vec_id, label, terms): integer components. Vectors that are null or
    hold a null or non-finite component are left out; null ids and labels stay."""
    x = F.col(vector_col)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vectors.filter(x.isNotNull()).filter(whole).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("terms"))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of ``width`` components; shorter vectors end in zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _sums(codebooks: Codebooks):
    """Rows -> per part and entry: how many parts it has, and their sums."""
    width, parts = codebooks.width, len(codebooks.books)
    size = len(codebooks.books[0].entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, size), np.int64)
        total = np.zeros((parts, size, width), np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                rows = _matrix(batch.column("terms").slice(first, TOGETHER), parts * width)
                codes = codebooks.encoded(rows)[0]
                for p in range(parts):
                    count[p] += np.bincount(codes[:, p], minlength=size)
                    np.add.at(total[p], codes[:, p], rows[:, p * width:(p + 1) * width])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]),
             pa.array(list(total[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])
    return run


def train_codebooks(terms: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after ``rounds`` of assigning all parts and averaging.

    ``terms`` (vec_id, terms) is read once a round and should be a stored
    table. Codebooks start as the parts of the ``entries`` smallest vec_ids
    (null last, equal ids by their terms; all rows, if fewer). Vectors are as
    long as the longest, rounded up to a multiple of ``parts``; shorter ones
    end in zeros. None if there are no rows. The driver holds the codebooks,
    whose size is set by the parameters and the vectors' length.
    """
    bounds = terms.agg(F.max(F.size("terms")).alias("width"),
                       F.max(F.array_max(F.transform("terms", lambda v: F.abs(v)))).alias("largest")).first()
    if bounds.width is None:
        return None
    if (bounds.largest or 0) > LARGEST:
        raise ValueError(f"components beyond {LARGEST} after scaling would not fit 64-bit distances")
    width = -(-bounds.width // parts)
    first = terms.orderBy(F.col("vec_id").asc_nulls_last(), "terms").limit(entries).select("terms").collect()
    start = _matrix(pa.array([r.terms for r in first], pa.list_(pa.int64())), parts * width)
    books = Codebooks([Codebook(start[:, p * width:(p + 1) * width]) for p in range(parts)], width)
    for _ in range(rounds):
        sums = terms.select("terms").mapInArrow(_sums(books), "part int, entry int, n long, total array<long>")
        merged = sums.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *(F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(width))).collect()
        new = [b.entries.copy() for b in books.books]
        for r in merged:  # a row per part and entry
            new[r.part][r.entry] = [r[f"t{i}"] // r.n for i in range(width)]
        books = Codebooks([Codebook(e) for e in new], width)
    return books


def encode(terms: DataFrame, codebooks: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): entry indexes in part order, two hex
    digits each (so at most 256 entries), and the summed squared distances."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(first, TOGETHER)
                codes, error = codebooks.encoded(_matrix(part.column("terms"), len(codebooks.books) * codebooks.width))
                text = [row.tobytes().hex() for row in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(text), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])

    label = dict(terms.dtypes)["label"]
    return terms.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def compression_report(vectors: DataFrame) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error (errors summed
    over its label, nulls together), codebooks_sha256. No rows, no result."""
    terms = save(quantised(vectors), "orchard-terms")
    codebooks = train_codebooks(terms)
    if codebooks is None:
        return terms.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = save(encode(terms, codebooks), "orchard-codes")
    sums = save(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "orchard-labels")
    joined = coded.join(maybe_broadcast(sums, 64), F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks.digest()).alias("codebooks_sha256"))


def _sql_assign(number: int) -> str:
    """Codes of all parts under the codebooks ``book<number>``."""
    return f"""code{number} AS (
  SELECT p.rid, p.part, min(list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT
                            * {ENTRIES} + b.entry) AS found
  FROM parts p JOIN book{number} b USING (part) GROUP BY p.rid, p.part)"""


def _sql_update(number: int) -> str:
    return f"""mean{number} AS (
  SELECT part, entry, list(m ORDER BY pos) AS v FROM (
    SELECT part, entry, pos, floor(sum(x) / count(*))::BIGINT AS m FROM (
      SELECT c.part, (c.found % {ENTRIES})::BIGINT AS entry, unnest(range(1, len(p.v) + 1)) AS pos, unnest(p.v) AS x
      FROM code{number} c JOIN parts p USING (rid, part)) GROUP BY part, entry, pos) GROUP BY part, entry),
book{number + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{number} b LEFT JOIN mean{number} m USING (part, entry))"""


#: DuckDB: every part against every entry, round by round.
COMPRESSION_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rid, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
sized AS (SELECT (max(len(v)) + {PARTS - 1}) // {PARTS} AS w FROM kept),
parts AS MATERIALIZED (
  SELECT rid, part, list_transform(range(part * w + 1, part * w + w + 1), lambda i: coalesce(v[i], 0)) AS v
  FROM kept, sized, (SELECT unnest(range({PARTS})) AS part)),
book0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, v FROM parts WHERE rid <= {ENTRIES}),
{", ".join(f"{_sql_assign(i)}, {_sql_update(i)}" for i in range(ROUNDS))},
{_sql_assign(ROUNDS)},
digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS}),
coded AS (
  SELECT kept.vec_id, kept.label, string_agg(printf('%02x', (found % {ENTRIES})::INT), '' ORDER BY part) AS code,
         sum(found // {ENTRIES})::BIGINT AS error
  FROM code{ROUNDS} JOIN kept USING (rid) GROUP BY rid, kept.vec_id, kept.label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, digest
"""
