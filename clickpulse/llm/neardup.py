"""MinHash near-dedup with bottom-k sketches of one hash function.

1. Every text becomes its set of word shingles (64-bit hashes). Texts with the
   same set form a class, whose sketch is the ``SKETCH`` smallest hashes.
2. Inverted lists of the retained values generate the candidates. Two sets that
   are alike enough share at least ``t`` retained values (but for one pair in
   ten million), so they meet among the rarest ``shared - t + 1`` of each; the
   others need no list. A passage that many texts share thus makes no list
   unless a text consists of little else.
3. Lists of up to ``LIST`` classes give all their pairs. Classes on longer
   lists, such as a large group of near copies, meet each other by their full
   sets instead: the same rule on all shingles with the exact bound. There a
   list compares its classes with a few pivots first, and then only those that
   are not yet connected to its pivot with the rest of the list.
4. Pairs of fitting sizes are filtered by the estimate from the union's sketch
   and verified by exact Jaccard similarity of the full sets.
5. Links between classes and the classes' members give the components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import free_name, maybe_broadcast, row_key, save
from clickpulse.llm.components import components
from clickpulse.llm.wordhash import NOT_SPACE, shingles, slices, words

SKETCH = 64
#: A list of up to this many classes gives all its pairs.
LIST = 128
PIVOTS = 2
#: Probability that a pair at the threshold shares fewer retained values than asked for.
MISS = 1e-7


def least_shared(percent: int, size: int = SKETCH, miss: float = MISS) -> int:
    """The number of a union's ``size`` retained values that two sets of
    ``percent`` similarity share but for a probability of ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(size + 1):
        below += comb(size, t) * p ** t * (1 - p) ** (size - t)
        if below > miss:
            return t
    return size


_SETS = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("class", pa.binary()),
                   ("n", pa.int64()), ("sketch", pa.list_(pa.int64()))])
_SETS_DDL = "doc_id long, k1 long, k2 long, class binary, n long, sketch array<long>"


def _sketches(k: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for first, last in slices(texts):
                doc, value = shingles(words(texts.slice(first, last - first), NOT_SPACE), k)
                cut = np.searchsorted(doc, np.arange(last - first + 1))
                n = np.diff(cut)
                raw = value.tobytes()
                name = [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() if b > a else None
                        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                held = np.minimum(n, size)
                ends = np.concatenate([[0], np.cumsum(held)])
                at = np.repeat(cut[:-1] - ends[:-1], held) + np.arange(ends[-1])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value[at].view(np.int64)))
                own = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("k1"), own.column("k2"), pa.array(name, pa.binary()),
                     pa.array(n, pa.int64()), lists], schema=_SETS)
    return run


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, name = batch.column("text"), batch.column("class")
            for first, last in slices(texts):
                doc, value = shingles(words(texts.slice(first, last - first), NOT_SPACE), k)
                ends = np.searchsorted(doc, np.arange(last - first + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [name.slice(first, last - first), pa.array(np.diff(ends), pa.int64()), lists], names=["class", "n", "sketch"])
    return run


def _alike(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("text_a"), batch.column("text_b")
            for first, last in slices(left):
                rows = last - first
                da, va = shingles(words(left.slice(first, rows), NOT_SPACE), k)
                db, vb = shingles(words(right.slice(first, rows), NOT_SPACE), k)
                doc, value = np.concatenate([da, db]), np.concatenate([va, vb])
                order = np.lexsort((value, doc))
                doc, value = doc[order], value[order]
                both = np.bincount(doc[1:][(doc[1:] == doc[:-1]) & (value[1:] == value[:-1])], minlength=rows)
                either = np.bincount(doc, minlength=rows) - both
                hit = np.flatnonzero(100 * both >= percent * either)
                yield batch.slice(first, rows).select(["a", "b"]).take(pa.array(hit))
    return run


def _rare_first(sets: DataFrame, least: Column) -> DataFrame:
    """(value, class, n, rarer): the list entries that a set needs. ``sets`` has
    (class, n, sketch); ``least`` is the number of values that it shares with
    any partner. ``rarer``: how many of its values come before this one, with
    those that no other set holds."""
    entries = sets.select("class", "n", F.size("sketch").alias("held"), F.explode("sketch").alias("value"))
    common = (sets.select(F.explode("sketch").alias("value")).groupBy("value")
              .agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1"))
    # stored, so that the join can split the entries of a very common value
    shared = entries.join(save(common, "neardup-common"), "value")
    listed = (shared.groupBy("class").agg(
        F.first("n").alias("n"), F.first("held").alias("held"),
        F.array_sort(F.collect_list(F.struct("texts", "value"))).alias("values"))
        .withColumn("least", least).withColumn("alone", F.col("held") - F.size("values"))
        .filter(F.size("values") >= F.col("least")))
    return listed.select("class", "n", "alone", F.posexplode(F.expr(
        "slice(values, 1, cast(size(values) - least + 1 as int))")).alias("at", "v")).select(
        "class", "n", (F.col("alone") + F.col("at")).alias("rarer"), "v.value")


def _list_pairs(lists: DataFrame, fit: Column) -> DataFrame:
    joined = lists.alias("x").join(lists.alias("y"), (F.col("x.value") == F.col("y.value"))
                                   & (F.col("x.class") < F.col("y.class")) & fit)
    return joined.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()


def _with_length(lists: DataFrame) -> DataFrame:
    """The entries of lists of two or more, with their lists' lengths."""
    lists = save(lists, "neardup-entries")
    lengths = lists.groupBy("value").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    return save(lists.join(save(lengths, "neardup-lengths"), "value"), "neardup-lists")


class NearDuplicates:
    """The classes, links and components of ``docs`` (doc_id, text).

    ``percent``: least similarity, 100 * shared >= percent * united. A text of
    fewer than ``shingle`` words has its whole sequence as its only shingle;
    null texts and texts without words have none, and are linked with nothing.
    """

    def __init__(self, docs: DataFrame, shingle: int = 5, percent: int = 80, sketch: int = SKETCH,
                 longest_list: int = LIST, pivots: int = PIVOTS) -> None:
        self.shingle, self.percent, self.size = shingle, percent, sketch
        self.longest, self.pivots = longest_list, pivots
        key = row_key(F.col("doc_id"), F.col("text"))
        self.rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key[0].alias("k1"), key[1].alias("k2"), "text")
        found = save(self.rows.mapInArrow(_sketches(shingle, sketch), _SETS_DDL), "neardup-sets")
        self.members = found.select("doc_id", "k1", "k2", "class", "n")
        self.classes = save(found.filter(F.col("class").isNotNull()).groupBy("class").agg(
            F.first("n").alias("n"), F.first("sketch").alias("sketch"),
            F.min(F.struct("k1", "k2")).alias("key")), "neardup-classes")

    def _texts(self, classes: DataFrame) -> DataFrame:
        """(class, text): one text of each of ``classes``, from the documents."""
        wanted = save(self.classes.join(classes, "class", "left_semi").select(
            "class", F.col("key.k1").alias("k1"), F.col("key.k2").alias("k2")), "neardup-wanted")
        found = self.rows.select("k1", "k2", "text").join(maybe_broadcast(wanted, 64), ["k1", "k2"])
        return save(found.groupBy("class").agg(F.first("text").alias("text")), "neardup-texts")

    def _estimated(self, pairs: DataFrame) -> DataFrame:
        """The pairs that the sketch of their union does not rule out."""
        side = lambda c: self.classes.select(F.col("class").alias(c), F.col("sketch").alias(f"sketch_{c}"))
        joined = pairs.join(side("a"), "a").join(side("b"), "b")
        united = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, self.size)
        rows = joined.withColumn("united", united).withColumn(
            "shared", F.size(F.array_intersect("united", F.array_intersect("sketch_a", "sketch_b"))))
        full = F.size("united") == self.size
        need = F.when(full, F.lit(least_shared(self.percent, self.size))).otherwise(
            F.ceil(F.size("united") * self.percent / 100))
        return rows.filter(F.col("shared") >= need).select("a", "b")

    def _verified(self, pairs: DataFrame, name: str, sketched: bool = True) -> DataFrame:
        """The pairs that are alike; those that did not come from sketches
        (``sketched`` off) are not asked to pass a sketch's estimate either."""
        pairs = save(self._estimated(pairs) if sketched else pairs, f"neardup-pairs-{name}")
        ends = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
        texts = self._texts(ends)
        side = lambda c: texts.select(F.col("class").alias(c), F.col("text").alias(f"text_{c}"))
        joined = pairs.join(side("a"), "a").join(side("b"), "b")
        return save(joined.mapInArrow(_alike(self.shingle, self.percent), "a binary, b binary"), f"neardup-links-{name}")

    def links(self) -> DataFrame:
        """(a, b): pairs of classes that connect what all links connect (within
        long lists not every link is looked at)."""
        by_sketch = F.least(F.ceil(F.col("n") * self.percent / 100), F.lit(least_shared(self.percent, self.size)))
        lists = _with_length(_rare_first(self.classes.select("class", "n", "sketch"), by_sketch))
        hot = save(lists.filter(F.col("length") > self.longest).select("class").distinct(), "neardup-hot")
        if hot.isEmpty():
            return self._verified(_list_pairs(lists, self._fit(exact=False)), "sketch")
        lists = lists.join(hot.withColumn("hot", F.lit(True)), "class", "left").filter(F.col("length") <= self.longest)
        cold = F.col("x.hot").isNull() | F.col("y.hot").isNull()
        pairs = _list_pairs(lists, self._fit(exact=False) & cold)
        full = save(self._texts(hot).mapInArrow(_full_sets(self.shingle), "class binary, n long, sketch array<long>"), "neardup-full")
        by_set = F.ceil(F.col("n") * self.percent / 100)
        lists = _with_length(_rare_first(full, by_set))
        first = self._verified(pairs, "sketch").unionByName(self._verified(self._pivot_pairs(lists), "first", sketched=False))
        root = save(components(first), "neardup-first-roots")
        joined = root.select(F.col("node").alias("a"), F.col("root").alias("b"))  # as good as the links
        rest = save(self._unconnected(lists, root), "neardup-rest")
        return joined if rest.isEmpty() else joined.unionByName(self._verified(rest, "rest", sketched=False))

    def _fit(self, exact: bool) -> Column:
        """Sizes of two sets that may be alike; with full sets, also whether
        enough is left to share from this value on (at the rarest value that
        two sets share, all that they share is left)."""
        n, m = F.col("x.n"), F.col("y.n")
        sizes = 100 * F.least(n, m) >= self.percent * F.greatest(n, m)
        if exact:
            most = F.least(n - F.col("x.rarer"), m - F.col("y.rarer"))
            sizes = sizes & (100 * most >= self.percent * (n + m - most))
        return sizes

    def _pivot_pairs(self, lists: DataFrame) -> DataFrame:
        """Every class with the pivots of its lists: the classes in which the
        fewest values are rarer, which near copies are closest to."""
        few = _fewest(lists, self.pivots)
        joined = lists.alias("x").join(few.alias("y"), (F.col("x.value") == F.col("y.value"))
                                       & (F.col("x.class") != F.col("y.class")) & self._fit(exact=True))
        return joined.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()

    def _unconnected(self, lists: DataFrame, root: DataFrame) -> DataFrame:
        """Pairs of a list in different components, of which one is not
        connected to the list's first pivot."""
        placed = save(lists.join(root.withColumnRenamed("node", "class"), "class", "left").withColumn(
            "root", F.coalesce("root", "class")), "neardup-placed")
        main = placed.groupBy("value").agg(F.min_by("root", F.struct("rarer", "class")).alias("main"))
        apart = placed.join(save(main, "neardup-main"), "value").filter(F.col("root") != F.col("main"))
        apart = save(apart.drop("main"), "neardup-apart")
        joined = apart.alias("x").join(placed.alias("y"), (F.col("x.value") == F.col("y.value"))
                                       & (F.col("x.root") != F.col("y.root")) & self._fit(exact=True))
        return joined.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()

    def named(self) -> DataFrame:
        """(doc_id, k1, k2, n, root): the documents with words and their components."""
        root = components(self.links())
        named = self.members.filter(F.col("class").isNotNull()).join(
            root.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
        return save(named.select("doc_id", "k1", "k2", "n", "root"), "neardup-named")

    def report(self) -> DataFrame:
        """One row per document: doc_id, n_shingles, component_id, kept, and
        the row's key (k1, k2). Documents of the same set are one component;
        null ids take no part in choosing component_id."""
        named = self.named()
        least = save(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "neardup-least")
        grouped = named.join(least, "root").select("doc_id", "k1", "k2", "n", "component_id")
        alone = self.members.filter(F.col("class").isNull()).select("doc_id", "k1", "k2", "n", F.col("doc_id").alias("component_id"))
        return grouped.unionByName(alone).select(
            "doc_id", F.col("n").alias("n_shingles"), "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "k1", "k2")


def _fewest(long: DataFrame, count: int) -> DataFrame:
    """(value, class, n, rarer): of each list the ``count`` classes with the
    fewest rarer values (then the smallest). Each round takes one more,
    by a sum per list, so no list is gathered or sorted."""
    order = F.struct("rarer", "class", "n")
    found, after = None, None
    for _ in range(count):
        rows = long
        if after is not None:
            rows = long.join(after, "value").filter(order > F.col("last")).drop("last")
        after = rows.groupBy("value").agg(F.min(order).alias("last"))
        one = after.select("value", "last.class", "last.n", "last.rarer")
        found = one if found is None else found.unionByName(one)
    return save(found, "neardup-pivots")


def near_duplicate_report(docs: DataFrame, shingle: int = 3, percent: int = 85) -> DataFrame:
    return NearDuplicates(docs, shingle, percent).report().drop("k1", "k2")


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, with one document of each component: of the
    smallest doc_id (null last), of several texts of that id one by their
    hashes, and of rows repeated in id and text one. Documents without words
    stay, each row of them."""
    k1, k2, none = (free_name(docs.columns, f"neardup_{c}") for c in ("k1", "k2", "none"))
    named = NearDuplicates(docs, shingle, percent).named().withColumnsRenamed({"k1": k1, "k2": k2})
    order = F.struct(F.col("doc_id").isNull().alias(none), "doc_id", k1, k2)
    first = save(named.groupBy("root").agg(F.min(order).alias("first")).select("root", f"first.{k1}", f"first.{k2}"), "neardup-first")
    gone = save(named.select(k1, k2).distinct().join(first, [k1, k2], "left_anti"), "neardup-gone")
    again = save(named.groupBy(k1, k2).count().filter("count > 1").join(first, [k1, k2], "left_semi").select(k1, k2), "neardup-again")
    key = row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.withColumns({k1: key[0], k2: key[1]}).join(maybe_broadcast(gone, 32), [k1, k2], "left_anti")
    if again.isEmpty():
        return keyed.select(*docs.columns)
    again = maybe_broadcast(again, 32)
    once = keyed.join(again, [k1, k2], "left_semi").dropDuplicates([k1, k2])
    return keyed.join(again, [k1, k2], "left_anti").unionByName(once).select(*docs.columns)
