"""N-gram Jaccard join by an R-tree over count vectors.

1. Every text becomes its set of word n-grams (64-bit hashes, the tokens). Texts
   with the same set form a class.
2. Of every set the first tokens by hash are compared: so many (``first_size``)
   that two sets that are alike share ``spare`` of them or more, whatever they
   are. Sets that share fewer with all others together have no partner. Of the
   tokens that a set does share, it asks for as many of the rarest as must hold
   one that any partner asks for, too.
3. A class that may have partners is a point: all its tokens are hashed into
   ``GROUPS`` groups, the point's coordinates are the groups' counts. Points that
   ask for the same tokens share a leaf of the tree; a leaf's box is the greatest
   count per group with the least and greatest size.
4. Leaves that ask for the same token are compared from the top: two boxes, then two points, have
   an overlap of at most the sum of their coordinates' minima. Pairs of leaves
   that this bound leaves are brought together, pairs of points that it leaves
   are verified by the exact overlap of their sets.
5. A pair of leaves answers with one row per linked class: the number of
   documents it links with there, and the smallest class it is connected with.
   So all links are found and counted, but a group of near copies does not
   become rows for all its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import maybe_broadcast, row_key, save
from clickpulse.llm.components import components
from clickpulse.llm.wordhash import NOT_SPACE, mix64, shingles, slices, words

#: Coordinates of a point.
GROUPS = 64
#: A leaf is closed at so many points (64 at most, a bit for each), or so many
#: tokens (one longer set is a leaf alone).
LEAF_POINTS, LEAF_TOKENS = 64, 32768

#: The share of a set (in percent) by which the first tokens are more than the
#: fewest that must meet; more of them rule out more sets.
SPARE = 10

_FIRST_DDL = "doc_id long, k1 long, k2 long, class binary, n long, need long, first array<long>"
_FIRST = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("class", pa.binary()),
                    ("n", pa.int64()), ("need", pa.int64()), ("first", pa.list_(pa.int64()))])
_SETS_DDL = "class binary, n long, copies long, tokens array<long>"
_SETS = pa.schema([("class", pa.binary()), ("n", pa.int64()), ("copies", pa.int64()), ("tokens", pa.list_(pa.int64()))])
_LEAF_DDL = ("leaf binary, n_min long, n_max long, box array<int>, classes array<binary>, sizes array<long>, "
             "copies array<long>, tokens array<long>, points array<long>, asked array<long>")
_LEAF = pa.schema([("leaf", pa.binary()), ("n_min", pa.int64()), ("n_max", pa.int64()), ("box", pa.list_(pa.int32())),
                   ("classes", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())),
                   ("tokens", pa.list_(pa.int64())), ("points", pa.list_(pa.int64())), ("asked", pa.list_(pa.int64()))])
_LINK_DDL = "class binary, root binary, links long"
_LINK = pa.schema([("class", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])


def least_overlap(n, percent: int):
    """What a set of ``n`` tokens shares at least with any partner."""
    return -(-n * percent // 100)


def spare(n, share: int = SPARE):
    return np.maximum(-(-n * share // 100), 1)


def first_size(n, percent: int, share: int = SPARE):
    """How many first tokens of a set of ``n`` are compared. At most
    ``least_overlap(n) - spare(n)`` tokens come after them, so of the tokens
    that two sets share each has ``spare`` or more among its first ones, and
    these are the first that both share."""
    return np.minimum(n, n - least_overlap(n, percent) + spare(n, share))


def _arrays(starts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values.view(np.int64)))


def _first_tokens(k: int, percent: int):
    """Per document: its class, its set's size, the first tokens by hash, and
    how many of them it shares at least with any partner: partners have
    ``least_overlap`` tokens or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for first, last in slices(texts):
                doc, value = shingles(words(texts.slice(first, last - first), NOT_SPACE), k)
                cut = np.searchsorted(doc, np.arange(last - first + 1))
                n, raw = np.diff(cut), value.tobytes()
                name = [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() if b > a else None
                        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                held = first_size(n, percent)
                ends = np.concatenate([[0], np.cumsum(held)])
                at = np.repeat(cut[:-1] - ends[:-1], held) + np.arange(ends[-1])
                own = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("k1"), own.column("k2"), pa.array(name, pa.binary()),
                     pa.array(n, pa.int64()), pa.array(spare(least_overlap(n, percent)), pa.int64()),
                     _arrays(ends, value[at])], schema=_FIRST)
    return run


def _whole_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for first, last in slices(texts):
                doc, value = shingles(words(texts.slice(first, last - first), NOT_SPACE), k)
                ends = np.searchsorted(doc, np.arange(last - first + 1))
                own = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [own.column("class"), own.column("n"), own.column("copies"), _arrays(ends, value)], schema=_SETS)
    return run


def members(points: np.ndarray, count: int) -> np.ndarray:
    """Bit sets of points -> a matrix (tokens, points) of 0 and 1."""
    bits = np.unpackbits(np.ascontiguousarray(points, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits[:, :count].astype(np.float32)


def group_counts(tokens: np.ndarray, held: np.ndarray, groups: int) -> np.ndarray:
    """The points (rows) of a leaf: how many tokens each has in each group."""
    group = (mix64(tokens.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
    out = np.zeros((groups, held.shape[1]), np.float32)
    np.add.at(out, group, held)
    return out.T.astype(np.int64)


def make_leaf(rows: list[tuple], groups: int) -> dict:
    """A leaf of points (class, n, copies, tokens, asked): each token of theirs
    once, with the set of points that have it."""
    sizes = [r[1] for r in rows]
    tokens, at = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True)
    points = np.zeros(len(tokens), np.uint64)
    np.bitwise_or.at(points, at, np.repeat(np.uint64(1) << np.arange(len(rows), dtype=np.uint64), [len(r[3]) for r in rows]))
    points = points.view(np.int64)
    return {"leaf": rows[0][0], "n_min": min(sizes), "n_max": max(sizes),
            "box": group_counts(tokens, members(points, len(rows)), groups).max(axis=0).tolist(),
            "classes": [r[0] for r in rows], "sizes": sizes, "copies": [r[2] for r in rows], "tokens": tokens.tolist(),
            "points": points.tolist(), "asked": np.unique(np.concatenate([r[4] for r in rows])).tolist()}


def _leaves(groups: int, most_points: int, most_tokens: int):
    """Sorted points -> leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, near = [], 0, None
        for batch in batches:
            lists, asked = batch.column("tokens"), batch.column("asked")
            found = []
            for i, (name, n, copies, corner) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("class", "n", "copies", "corner")))):
                tokens = lists[i].values.to_numpy()
                if held and (len(held) >= most_points or size + len(tokens) > most_tokens
                             or (corner != near and 2 * len(held) >= most_points)):
                    found.append(make_leaf(held, groups))
                    held, size = [], 0
                near = corner
                held.append((name, n, copies, tokens, asked[i].values.to_numpy()))
                size += len(tokens)
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=_LEAF)
        if held:
            yield pa.RecordBatch.from_pylist([make_leaf(held, groups)], schema=_LEAF)
    return run


def linked(a: dict, b: dict | None, groups: int, percent: int) -> list[dict]:
    """The links between the points of two leaves (``b`` None: within ``a``):
    a row for each class that has some."""
    both = [a] if b is None else [a, b]
    held = [members(np.asarray(x["points"]), len(x["classes"])) for x in both]
    counts = [group_counts(np.asarray(x["tokens"]), h, groups) for x, h in zip(both, held)]
    n, m = np.array(a["sizes"])[:, None], np.array(both[-1]["sizes"])[None, :]
    bound = np.array([np.minimum(p, counts[-1]).sum(axis=1) for p in counts[0]])
    # overlap o is enough where 100 o >= percent (n + m - o)
    survives = (100 + percent) * bound >= percent * (n + m)
    if b is None:
        survives = np.triu(survives, 1)
    rows, cols = np.flatnonzero(survives.any(axis=1)), np.flatnonzero(survives.any(axis=0))
    if not len(rows):
        return []
    # exact overlaps of the points that survive: only tokens of both leaves count
    at = [slice(None)] * 2
    if b is not None:
        _, *at = np.intersect1d(a["tokens"], b["tokens"], assume_unique=True, return_indices=True)
    overlap = (held[0][at[0]][:, rows].T @ held[-1][at[1]][:, cols]).astype(np.int64)
    hit = survives[np.ix_(rows, cols)] & ((100 + percent) * overlap >= percent * (n[rows] + m[:, cols]))
    i, j = (x[y] for x, y in zip((rows, cols), np.nonzero(hit)))
    if not len(i):
        return []
    if b is not None:
        j = j + len(a["classes"])
    names = [c for x in both for c in x["classes"]]
    copies = np.array([c for x in both for c in x["copies"]])
    links = np.zeros(len(names), np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    # the least class each is connected with: ranks spread along the links until they rest
    by_rank = sorted(range(len(names)), key=names.__getitem__)
    root = np.empty(len(names), np.int64)
    root[by_rank] = np.arange(len(names))
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        if (new == root).all():
            break
        root = new
    return [{"class": names[p], "root": names[by_rank[root[p]]], "links": int(links[p])} for p in np.flatnonzero(links).tolist()]


_IN_LEAF = ("classes", "sizes", "copies", "tokens", "points")


def _leaf_of(batch: pa.RecordBatch, at: int, side: str) -> dict:
    parts = {c: batch.column(f"{side}_{c}")[at].values for c in _IN_LEAF}
    return {c: v.to_pylist() if c in _IN_LEAF[:3] else v.to_numpy() for c, v in parts.items()}


def _join_leaves(groups: int, percent: int, within: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                found = linked(_leaf_of(batch, at, "a"), None if within else _leaf_of(batch, at, "b"), groups, percent)
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=_LINK)
    return run


class NGramJoin:
    """The self-join of ``docs`` (doc_id, text) on the Jaccard similarity of
    their sets of word n-grams: 100 * shared >= percent * united.

    A text of fewer than ``shingle`` words has its whole sequence as its only
    token; null texts and texts without words have none and link with nothing.
    Other columns are not read. Tokens are 64-bit hashes of the words; two
    different n-grams count as one where these agree.
    """

    def __init__(self, docs: DataFrame, shingle: int = 5, percent: int = 80, groups: int = GROUPS,
                 leaf_points: int = LEAF_POINTS, leaf_tokens: int = LEAF_TOKENS) -> None:
        self.shingle, self.percent, self.groups = shingle, percent, groups
        self.leaf_points, self.leaf_tokens = min(leaf_points, 64), leaf_tokens
        key = row_key(F.col("doc_id"), F.col("text"))
        self.rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key[0].alias("k1"), key[1].alias("k2"), "text")
        found = self.rows.mapInArrow(_first_tokens(shingle, percent), _FIRST_DDL)
        # numbered, so that a row's tokens go by a short key
        self.found = save(found.withColumn("id", F.monotonically_increasing_id()), "ngram-first")
        self.members = self.found.select("doc_id", "class", "n")
        self.classes = save(self.found.filter(F.col("class").isNotNull()).groupBy("class").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "n", "need", "k1", "k2")).alias("one"))
            .select("class", "copies", "one.*"), "ngram-classes")

    def _shared(self, entries: DataFrame) -> DataFrame:
        """(token, held): the tokens that more than one row of ``entries`` has.
        Stored, so that a join with it can split the rows of a common token."""
        return save(entries.groupBy("token").agg(F.count(F.lit(1)).alias("held")).filter("held > 1"), "ngram-shared")

    def candidates(self) -> DataFrame:
        """(class, n, copies, k1, k2, asked): the classes that share enough of
        their first tokens to have a partner, and the tokens they ask for.
        (Where a class has copies, these count as others here.)"""
        first = self.found.select("id", F.explode("first").alias("token"))
        rare_first = F.array_sort(F.collect_list(F.struct("held", "token"))).alias("shared")
        listed = first.join(self._shared(first), "token").groupBy("id").agg(rare_first)
        found = listed.join(self.classes, "id").filter(F.size("shared") >= F.col("need"))
        asked = F.expr("slice(shared.token, 1, cast(size(shared) - need + 1 as int))")
        return save(found.select("class", "n", "copies", "k1", "k2", asked.alias("asked")), "ngram-candidates")

    def leaves(self) -> DataFrame:
        """The leaves of the tree: boxes, and the points in them."""
        some = self.candidates()
        asked = some.select("class", F.explode("asked").alias("token"))
        # near the least class that asks for one of its tokens: what belongs together is close
        lists = save(asked.groupBy("token").agg(F.count(F.lit(1)).alias("held"), F.min("class").alias("corner"))
                     .filter("held > 1").drop("held"), "ngram-lists")
        corner = asked.join(lists, "token").groupBy("class").agg(F.min("corner").alias("corner"))
        some = save(some.join(corner, "class"), "ngram-met")
        texts = (self.rows.select("k1", "k2", "text").join(maybe_broadcast(some.drop("asked", "corner"), 80), ["k1", "k2"])
                 .groupBy("class").agg(F.first("n").alias("n"), F.first("copies").alias("copies"), F.first("text").alias("text")))
        sets = texts.mapInArrow(_whole_sets(self.shingle), _SETS_DDL)
        points = save(sets.join(some.select("class", "asked", "corner"), "class"), "ngram-points")
        ordered = points.repartitionByRange("corner", "n", "class").sortWithinPartitions("corner", "n", "class")
        return save(ordered.select("class", "n", "copies", "tokens", "asked", "corner").mapInArrow(
            _leaves(self.groups, self.leaf_points, self.leaf_tokens), _LEAF_DDL), "ngram-leaves")

    def _leaf_pairs(self, leaves: DataFrame) -> DataFrame:
        """(a, b): leaves with a token in common that one point of each asks
        for, whose sizes fit and whose boxes may overlap enough."""
        asked = leaves.select("leaf", "n_min", "n_max", F.explode("asked").alias("token"))
        asked = save(asked.join(self._shared(asked), "token", "left_semi"), "ngram-asked")
        fits = lambda x, y: 100 * F.col(f"{x}.n_max") >= self.percent * F.col(f"{y}.n_min")
        met = (asked.alias("x").join(asked.alias("y"), (F.col("x.token") == F.col("y.token"))
                                     & (F.col("x.leaf") < F.col("y.leaf")) & fits("x", "y") & fits("y", "x"))
               .select(F.col("x.leaf").alias("a"), F.col("y.leaf").alias("b")).distinct())
        boxes = lambda c: leaves.select(F.col("leaf").alias(c), F.col("n_min").alias(f"n_{c}"), F.col("box").alias(f"box_{c}"))
        bound = F.aggregate(F.zip_with("box_a", "box_b", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x)
        return (met.join(boxes("a"), "a").join(boxes("b"), "b")
                .filter((100 + self.percent) * bound >= self.percent * (F.col("n_a") + F.col("n_b"))).select("a", "b"))

    def links(self) -> DataFrame:
        """(class, root, links): for each class the number of documents of
        other classes that it links with, and a class it is connected with, in
        parts (one row for each pair of leaves)."""
        leaves = self.leaves()
        pairs = save(self._leaf_pairs(leaves), "ngram-leaf-pairs")
        side = lambda s: leaves.select(F.col("leaf").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in _IN_LEAF))
        inner = side("a").filter(F.size("a_classes") > 1).mapInArrow(_join_leaves(self.groups, self.percent, True), _LINK_DDL)
        outer = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(
            _join_leaves(self.groups, self.percent, False), _LINK_DDL)
        return save(inner.unionByName(outer), "ngram-links")

    def report(self) -> DataFrame:
        """One row per document: doc_id, n_shingles, component_id, n_links (the
        documents it links with, copies and repeated rows among them).

        Null ids take no part in choosing component_id, which is null where a
        component has no other; a document without a set has its own id.
        """
        links = self.links()
        root = components(links.filter("class <> root").select("class", "root").distinct(), "class", "root")
        linked = links.groupBy("class").agg(F.sum("links").alias("links"))
        info = save(self.classes.select("class", "copies").join(linked, "class", "left")
                    .join(root.withColumnRenamed("node", "class"), "class", "left")
                    .select("class", F.coalesce("root", "class").alias("root"),
                            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "ngram-info")
        named = save(self.members.filter(F.col("class").isNotNull()).join(info, "class"), "ngram-named")
        least = save(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "ngram-least")
        cols = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links"]
        alone = self.members.filter(F.col("class").isNull()).withColumns(
            {"component_id": F.col("doc_id"), "n_links": F.lit(0).cast("long")})
        return named.join(least, "root").select(*cols).unionByName(alone.select(*cols))


def ngram_join_report(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    return NGramJoin(docs, shingle, percent).report()


#: DuckDB: every pair that shares a shingle, by the whole sets.
NGRAM_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, rid, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM rows),
items AS (SELECT rid, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.rid AS u, b.rid AS v FROM items a JOIN items b ON a.x = b.x AND a.rid <> b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT rid AS u, rid AS v FROM rows UNION SELECT r.u, p.v FROM reach r JOIN pairs p ON r.v = p.u),
least AS (SELECT r.u AS rid, min(rows.doc_id) AS component_id FROM reach r JOIN rows ON rows.rid = r.v GROUP BY r.u),
counted AS (SELECT u AS rid, count(*) AS n_links FROM pairs GROUP BY u)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM sets JOIN least USING (rid) LEFT JOIN counted USING (rid)
"""
