"""Exact top-k search by inner product, term at a time.

Vectors become integers, floor(scale * x). Rows and queries are dealt into
blocks of bounded size, and every pair of a row block and a query block is one
task: within it each dimension is a term with its postings (rows of non-zero
weight), and a query's non-zero terms scatter weight * posting into a dense
array of scores. Each block selects its k best by partition; a window per query
merges them. All rows are scored, in exact 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import save

SCALE = 256
#: Rows of a row block, and queries of a query block.
ROW_BLOCK, QUERY_BLOCK = 16384, 4096
#: Queries that share a score array (times ROW_BLOCK longs) at a time.
STRIPE = 64

_OUT = pa.schema([("asked", pa.int64()), ("query_id", pa.int64()), ("asks", pa.int64()), ("vec_id", pa.int64()),
                  ("copies", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, terms): integer components. Vectors that are null, and vectors with
    a null or non-finite component, are left out; null ids stay."""
    x = F.col(vector_col)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (vectors.filter(x.isNotNull()).filter(whole)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("terms")))


def _matrix(table: pa.Table) -> np.ndarray:
    """A dense (rows, dimensions) matrix; short vectors end in zeros."""
    lists = table.column("terms").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _best(scores: np.ndarray, copies: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest of one score array, of those with copies (the
    first of ties)."""
    there = np.flatnonzero(copies)
    if len(there) <= k:
        return there
    scores = scores[there]
    kth = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > kth)
    return there[np.concatenate([above, np.flatnonzero(scores == kth)[:k - len(above)]])]


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def score_block(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best rows of a row block for each query of a query block: rows of
    one id and vector as one, with the number of them that the query may take."""
    ids = rows.column("id").combine_chunks()
    none = ids.is_null().to_numpy(zero_copy_only=False)
    order = np.lexsort((_numbers(rows, "key"), ids.fill_null(0).to_numpy(zero_copy_only=False), none))  # null ids last
    rows = rows.take(pa.array(order))
    keys, copies, postings = _numbers(rows, "key"), _numbers(rows, "copies"), np.ascontiguousarray(_matrix(rows).T)
    weights = _matrix(queries)
    terms = min(len(postings), weights.shape[1])
    lists = [np.flatnonzero(p) for p in postings[:terms]]
    place = {key: i for i, key in enumerate(keys.tolist())}
    who, at, best = [], [], []
    asked = _numbers(queries, "key")
    for first in range(0, len(asked), STRIPE):
        part = weights[first:first + STRIPE]
        scores = np.zeros((len(part), len(keys)), np.int64)
        for t in range(terms):
            for q in np.flatnonzero(part[:, t]):
                if len(lists[t]) == len(keys):
                    scores[q] += part[q, t] * postings[t]
                else:
                    scores[q, lists[t]] += part[q, t] * postings[t, lists[t]]
        for q in range(len(part)):
            own = place.get(int(asked[first + q]))
            left = copies
            if own is not None:  # its own row is none of them
                left = copies.copy()
                left[own] -= 1
            found = _best(scores[q], left, k)
            who.append(np.full(len(found), first + q))
            at.append(np.stack([found, left[found]]))
            best.append(scores[q][found])
    who, at = np.concatenate(who), np.concatenate(at, axis=1)
    return pa.table([queries.column(c).take(pa.array(who)).combine_chunks() for c in ("key", "id", "copies")]
                    + [rows.column("id").take(pa.array(at[0])).combine_chunks(), pa.array(np.minimum(at[1], k)),
                       pa.array(np.concatenate(best))], schema=_OUT)


def top_k(vectors: DataFrame, asks: Column | str, k: int = 5, *, row_block: int = ROW_BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products for each
    row of ``vectors`` (id, terms; as :func:`quantised` gives) that ``asks``.

    Every row but the query's own is a candidate, others of its id or with its
    vector and rows without an id among them. Ties go to the smaller id, null
    last; a query gets all rows if there are fewer than k. Rows that are the
    same are scored once and counted; each of them that asks gets an answer.
    """
    vectors = save(vectors.groupBy("id", "terms").agg(F.count(F.lit(1)).alias("copies"))
                   .withColumn("key", F.monotonically_increasing_id()), "topk-rows")
    queries = save(vectors.filter(asks), "topk-queries")
    n_rows, n_queries = vectors.count(), queries.count()
    row_blocks, query_blocks = -(-n_rows // row_block) or 1, -(-n_queries // query_block) or 1
    # a row block meets every query block and the reverse
    left = (vectors.withColumn("r", F.pmod(F.xxhash64("key"), F.lit(row_blocks)).cast("int"))
            .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    right = (queries.withColumn("q", F.pmod(F.xxhash64("key"), F.lit(query_blocks)).cast("int"))
             .withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))))

    def pair(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return _OUT.empty_table()
        return score_block(rows, asked, k)

    part = left.groupBy("r", "q").cogroup(right.groupBy("r", "q")).applyInArrow(
        pair, "asked long, query_id long, asks long, vec_id long, copies long, score long")
    each = part.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    best = Window.partitionBy("asked").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return (ranked.withColumn("answer", F.explode(F.sequence(F.lit(1).cast("long"), F.col("asks"))))
            .select("query_id", "rank", "vec_id", "score"))


def top_k_report(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by ``every``; searched: all."""
    return top_k(quantised(embeddings), F.col("id") % every == 0, k)


#: DuckDB: brute force over every (query, row) pair.
TOPK_SQL = """
WITH terms AS (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM terms q JOIN terms c ON q.rid <> c.rid WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST)::INT AS rank FROM scored)
WHERE rank <= 5
"""
