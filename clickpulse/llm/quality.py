"""Quality classifier: perplexity under an interpolated modified Kneser-Ney
model of byte n-grams, trained on trusted texts.

An n-gram is ``ORDER`` bytes of UTF-8 in one long, so its context is a shift
and its shorter forms are masks, and all counts are sums and joins by longs.

* Cross-fitting: texts are dealt into HELD_OUT parts by a hash of the text.
  Each text, trusted or not, is scored by the model of the other parts' trusted
  texts; the models' counts stand side by side, a column each.
* Training: n-gram counts of all trusted texts; continuation counts for the
  shorter n-grams; totals and kinds of counts by context; three discounts for
  each length, from the counts of counts.
* Scoring: texts are dealt into blocks by a hash of the id. The distinct
  n-grams of a block, far fewer than its bytes, are joined to the sharded
  counts; their log-probabilities go to the block, where each text sums its
  own. Every byte of every text counts.
* Thresholds: for each language the upper quantile of all its trusted texts'
  perplexities and some of its distance from the median. A text is kept up to
  its language's threshold. What a language lacks of LEAST_TEXTS trusted texts
  its other texts make up for, so none is judged by others: not as they are, as
  some are bad, but by their likelier half, mirrored at their median. Bad texts
  move that only as far as they move the median.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import free_name, maybe_broadcast, row_key, save
from clickpulse.llm.wordhash import slices, text_bytes

ORDER = 5
#: Text bytes in a block.
BLOCK_BYTES = 32 << 20
#: Parts of the texts; each is scored by a model of the trusted texts of the others.
HELD_OUT = 5
#: A threshold is this quantile and so many times its distance from the median.
UPPER, SPREADS = 0.95, 1.5
#: Languages with fewer trusted texts make up for the missing ones by the likelier
#: half of all their texts and its mirror image.
LEAST_TEXTS = 50
#: Distinct n-grams that a task sums before it sends them on.
HELD_GRAMS = 2_000_000
#: Quantiles are read from counts of log-perplexity in steps of this size.
STEP = 0.001


def byte_grams(texts: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram that ends at each byte, bytes per text). Before a text stand
    ``order - 1`` zero bytes."""
    data, offsets = text_bytes(texts)
    length = np.diff(offsets)
    at = np.arange(len(data)) + (order - 1) * (np.repeat(np.arange(len(length)), length) + 1)
    padded = np.zeros(len(data) + (order - 1) * len(length), np.int64)
    padded[at] = data
    gram = np.zeros(len(data), np.int64)
    for back in range(order - 1, -1, -1):
        gram = (gram << 8) | padded[at - back]
    return gram, length


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram = np.concatenate([g for g, _ in parts])
    order = np.argsort(gram, kind="stable")
    gram, count = gram[order], np.concatenate([c for _, c in parts])[order]
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
    return gram[first], np.add.reduceat(count, first) if len(first) else count


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, c) of a partition, summed as far as HELD_GRAMS allow. A text's
    ``part``, where there is one, stands above the bytes of its n-grams."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def rows() -> pa.RecordBatch:
        gram, count = _summed(held)
        return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(count)], names=["gram", "c"])

    for batch in batches:
        texts = batch.column("text")
        part = batch.column("part").to_numpy().astype(np.int64) << 8 * ORDER if "part" in batch.schema.names else None
        for first, last in slices(texts):
            gram, length = byte_grams(texts.slice(first, last - first))
            if part is not None:
                gram += np.repeat(part[first:last], length)
            gram, count = np.unique(gram, return_counts=True)
            held.append((gram, count.astype(np.int64)))
            if sum(len(g) for g, _ in held) > HELD_GRAMS:
                held = [_summed(held)]
                if len(held[0][0]) > HELD_GRAMS // 2:
                    yield rows()
                    held = []
    if held:
        yield rows()


def _mask(n: int) -> int:
    return (1 << 8 * n) - 1


class Model:
    """Counts of each length 1..ORDER: ``counts[n]`` (gram, c...) and
    ``contexts[n]`` (context, total..., spread...), where spread is the
    probability left to shorter n-grams; ``discounts[n]`` for counts 1, 2 and
    more.

    With ``parts`` above 1 these are that many models side by side, a column
    each: model i counts the texts of all parts but i.
    """

    def __init__(self, texts: DataFrame, parts: int = 1) -> None:
        """``texts`` has the column text, and part with ``parts`` above 1."""
        self.models = range(parts)
        rows = texts.mapInArrow(_counted, "gram long, c long")
        part = F.shiftright("gram", 8 * ORDER)
        own = [F.col("c") if parts == 1 else F.when(part != i, F.col("c")).otherwise(F.lit(0)) for i in self.models]
        level = rows.groupBy(F.col("gram").bitwiseAND(F.lit(_mask(ORDER))).alias("gram")).agg(
            *(F.sum(c).alias(f"c{i}") for i, c in enumerate(own)))
        self.counts, self.contexts, self.discounts = {}, {}, {}
        for n in range(ORDER, 0, -1):
            level = self.counts[n] = save(level, f"kn-counts-{n}")
            kinds = level.agg(*(F.count(F.when(F.col(f"c{i}") == c, 1)).alias(f"k{i}_{c}")
                                for i in self.models for c in range(1, 5))).first()
            self.discounts[n] = [_discounts({c: kinds[f"k{i}_{c}"] for c in range(1, 5)}) for i in self.models]
            totals = level.groupBy(F.shiftright("gram", 8).alias("context")).agg(
                *(F.nullif(F.sum(f"c{i}"), F.lit(0)).alias(f"total{i}") for i in self.models),
                *(F.sum(self.discount(n, i)).alias(f"held{i}") for i in self.models))
            self.contexts[n] = save(totals.select(
                "context", *(f"total{i}" for i in self.models),
                *((F.col(f"held{i}") / F.col(f"total{i}")).alias(f"spread{i}") for i in self.models)), f"kn-contexts-{n}")
            # a shorter n-gram counts the distinct bytes that precede it
            level = level.groupBy(F.col("gram").bitwiseAND(F.lit(_mask(n - 1))).alias("gram")).agg(
                *(F.count(F.when(F.col(f"c{i}") > 0, 1)).alias(f"c{i}") for i in self.models))

    def discount(self, n: int, i: int) -> Column:
        c, (one, two, more) = F.col(f"c{i}"), self.discounts[n][i]
        return F.when(c == 0, F.lit(0.0)).when(c == 1, F.lit(one)).when(c == 2, F.lit(two)).otherwise(F.lit(more))

    def log_probabilities(self, grams: DataFrame) -> DataFrame:
        """(gram, logp...) for distinct n-grams of full length, by joins with the
        counts of each length; what was never seen takes the shorter form's.
        One model's column is logp, several have logp0, logp1, ..."""
        below = None
        for n in range(1, ORDER + 1):
            keys = grams.select(F.col("gram").bitwiseAND(F.lit(_mask(n))).alias("gram"))
            keys = keys.distinct() if n < ORDER else keys
            rows = (keys.withColumn("context", F.shiftright("gram", 8))
                    .join(self.counts[n], "gram", "left").join(self.contexts[n], "context", "left"))
            if below is None:
                rows = rows.withColumns({f"p{i}": F.lit(1 / 256) for i in self.models})
            else:
                rows = rows.withColumn("short", F.col("gram").bitwiseAND(F.lit(_mask(n - 1)))).join(
                    below.withColumnRenamed("gram", "short"), "short")
            found = []
            for i in self.models:
                own = F.greatest(F.col(f"c{i}") - self.discount(n, i), F.lit(0.0)) / F.col(f"total{i}")
                p = F.coalesce(own, F.lit(0.0)) + F.col(f"spread{i}") * F.col(f"p{i}")
                found.append(F.coalesce(p, F.col(f"p{i}")).alias(f"p{i}"))
            below = rows.select("gram", *found)
        names = ["logp"] if len(self.models) == 1 else [f"logp{i}" for i in self.models]
        return below.select("gram", *(F.log(f"p{i}").cast("float").alias(x) for i, x in enumerate(names)))


def _discounts(kinds: dict[int, int]) -> tuple[float, float, float]:
    """Chen and Goodman's estimates; kept within (0, 1), (0, 2), (0, 3) where a
    small table lacks some count."""
    n1, n2, n3, n4 = (max(kinds.get(i, 0), 1) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in enumerate(found, 1))


_PACKED = pa.schema([("block", pa.int32()), ("texts", pa.binary())])
_ROW = ["doc_id", "k1", "k2", "lang", "text"]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one block as one compressed value."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        block = batch.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        found, start = np.unique(block[order], return_index=True)
        for b, rows in zip(found, np.split(order, start[1:])):
            own = batch.select(_ROW).take(pa.array(rows))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema, options=options) as writer:
                writer.write_batch(own)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                             schema=_PACKED)


def _unpacked(value: pa.Scalar) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_stream(value.as_buffer()) as reader:
        yield from reader


def _block_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, gram): the distinct n-grams of the rows of a block that stand
    together (a block's rows may come in several batches; that only repeats
    some n-grams)."""
    held, known = None, []

    def rows() -> pa.RecordBatch:
        gram = np.unique(np.concatenate(known))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), held, np.int32)), pa.array(gram)], names=["block", "gram"])

    for batch in batches:
        for block, value in zip(batch.column("block").to_pylist(), batch.column("texts")):
            if known and block != held:
                yield rows()
                known = []
            held = block
            for own in _unpacked(value):
                texts = own.column("text")
                known += [np.unique(byte_grams(texts.slice(a, b - a))[0]) for a, b in slices(texts)]
            if len(known) > 16:
                known = [np.unique(np.concatenate(known))]
    if known:
        yield rows()


_SCORES = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("lang", pa.string()),
                     ("n_bytes", pa.int64()), ("nats", pa.float64())])
_SCORES_DDL = "doc_id long, k1 long, k2 long, lang string, n_bytes long, nats double"


def _score_block(packed: pa.Table, table: pa.Table) -> pa.Table:
    gram = table.column("gram").to_numpy()
    order = np.argsort(gram)
    gram, logp = gram[order], table.column("logp").to_numpy()[order].astype(np.float64)
    out = []
    for chunk in packed.column("texts").chunks:
        for value in chunk:
            for rows in _unpacked(value):
                texts = rows.column("text")
                for first, last in slices(texts):
                    keys, length = byte_grams(texts.slice(first, last - first))
                    total = np.bincount(np.repeat(np.arange(len(length)), length),
                                        weights=logp[np.searchsorted(gram, keys)] if len(keys) else None, minlength=len(length))
                    nats = np.divide(-total, length, out=np.full(len(length), np.nan), where=length > 0)
                    part = rows.slice(first, last - first)
                    out.append(pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in _ROW[:4]), pa.array(length), pa.array(nats, mask=length == 0)], schema=_SCORES))
    return pa.Table.from_batches(out, schema=_SCORES)


def _keyed(docs: DataFrame) -> DataFrame:
    key = row_key(F.col("doc_id"), F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), key[0].alias("k1"), key[1].alias("k2"),
                       F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def _part(text: Column) -> Column:
    """The part of a text; equal texts share it, so none is in the model that scores its copy."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(HELD_OUT)).cast("int")


def score(docs: DataFrame, model: Model, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, k1, k2, lang, n_bytes, nats): mean negative log-probability of
    a text's bytes, under the model that did not count its part; null for a
    text without bytes."""
    parts = len(model.models)
    rows = _keyed(docs).withColumn("part", _part(F.col("text")) if parts > 1 else F.lit(0))
    # one row for each part
    sizes = rows.groupBy("part").agg(F.sum(F.octet_length("text")).alias("size")).agg(F.max("size")).first()[0] or 0
    blocks = max(1, -(-sizes // block_bytes))
    # by number, not by content: a row that is repeated without end fills no block
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    rows = rows.withColumn("block", (number * parts + F.col("part")).cast("int")).drop("part")
    seen = save(rows.mapInArrow(_counted, "gram long, c long").select("gram").distinct(), "kn-seen")
    known = save(model.log_probabilities(seen), "kn-log-probabilities")
    # read twice in the plan below, dealt out once (Spark reuses the exchange)
    packed = rows.mapInArrow(_pack, "block int, texts binary").repartition(blocks * parts, "block")
    grams = packed.sortWithinPartitions("block").mapInArrow(_block_grams, "block int, gram long")
    logp = F.col("logp") if parts == 1 else F.coalesce(
        *(F.when(F.pmod(F.col("block"), F.lit(parts)) == i, F.col(f"logp{i}")) for i in model.models))
    scored = grams.join(known, "gram").select("block", "gram", logp.alias("logp"))
    return packed.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(_score_block, _SCORES_DDL)


def _steps(scores: DataFrame) -> DataFrame:
    return scores.filter("nats IS NOT NULL").groupBy(
        "lang", F.floor(F.col("nats") / STEP).alias("step")).agg(F.count(F.lit(1)).alias("texts"))


def _filling(others: DataFrame, own: DataFrame, least: int) -> DataFrame:
    """Rows of _steps() by which each language's texts in ``own`` come up to
    ``least``: the steps of ``others`` up to their median and as far beyond it,
    at equal shares."""
    have = own.groupBy("lang").agg(F.sum("texts").alias("have"))
    by = Window.partitionBy("lang")
    steps = _steps(others).filter("lang IS NOT NULL").withColumn("all", F.sum("texts").over(by)).withColumn(
        "upto", F.sum("texts").over(by.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    half = steps.withColumn("median", F.min(F.when(F.col("upto") >= 0.5 * F.col("all"), F.col("step"))).over(by)).filter("step <= median")
    mirrored = half.unionByName(half.withColumn("step", 2 * F.col("median") - F.col("step")))
    missing = F.lit(least) - F.coalesce("have", F.lit(0))
    share = F.col("texts") / F.sum("texts").over(by)
    return (mirrored.join(have, "lang", "left").withColumn("texts", share * missing).filter(missing > 0)
            .select("lang", "step", "texts"))


def thresholds(scores: DataFrame, quantile: float = UPPER, least: int = LEAST_TEXTS, others: DataFrame | None = None
               ) -> DataFrame:
    """(lang, threshold) from (lang, nats) of trusted texts; the row of null
    language holds for languages without one of their own. With ``others``, the
    scores of all texts, every language in them has its own: these make up for
    what it lacks of ``least`` trusted texts.

    A threshold is the quantile and SPREADS times its distance from the median,
    so texts beyond the quantile do not move it. A quantile is the end of the
    step in which the running count of texts passes it, so sums by (language,
    step) are all that is gathered.
    """
    steps = _steps(scores)
    own = steps.filter("lang IS NOT NULL")
    if others is not None:
        own = own.unionByName(_filling(others, own, least)).groupBy("lang", "step").agg(F.sum("texts").alias("texts"))
    steps = own.withColumn("own", F.lit(True)).unionByName(
        steps.groupBy("step").agg(F.sum("texts").alias("texts")).select(
            F.lit(None).cast("string").alias("lang"), "step", "texts", F.lit(False).alias("own")))
    by = Window.partitionBy("lang", "own")
    run = steps.withColumn("all", F.sum("texts").over(by)).withColumn(
        "upto", F.sum("texts").over(by.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * (q - 1e-9), F.col("step")))
    found = run.filter(~F.col("own") | (F.col("all") >= least - 1e-6)).groupBy("lang", "own").agg(
        at(0.5).alias("median"), at(quantile).alias("upper"))
    return found.select("lang", (
        (F.col("upper") + SPREADS * (F.col("upper") - F.col("median")) + 1) * STEP).alias("threshold"))


def cross_fitted(docs: DataFrame, trusted: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of all of ``docs``, each under a model of the trusted texts of the other parts."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        maybe_broadcast(trusted, 24), "doc_id", "left_semi")
    model = Model(texts.select("text", _part(F.col("text")).alias("part")), HELD_OUT)
    return save(score(docs, model, block_bytes), "quality-scores")


def classify(docs: DataFrame, trusted: DataFrame, quantile: float = UPPER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text, lang): perplexity (per
    byte), threshold, keep, and the row's key (k1, k2).

    ``trusted`` has the doc_ids of trusted documents. Null and empty texts have
    no perplexity and are not kept; a null language takes the threshold of all;
    without any trusted text there is no threshold and all texts are kept.
    """
    trusted = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    trusted = save(trusted, "quality-trusted")
    scores = cross_fitted(docs, trusted, block_bytes)
    limits = save(thresholds(scores.join(trusted, "doc_id", "left_semi"), quantile, others=scores), "quality-thresholds")
    own = limits.filter("lang IS NOT NULL").withColumnRenamed("threshold", "own_threshold")
    general = limits.filter("lang IS NULL").select("threshold").first()  # one row at most
    rest = float(general["threshold"]) if general else None
    limit = F.when(F.col("lang").isNull(), F.lit(rest)).otherwise(F.col("own_threshold")) if general else F.lit(None)
    joined = scores.join(own, "lang", "left").withColumn("limit", limit.cast("double"))
    return joined.select(
        "doc_id", "lang", "n_bytes", F.exp("nats").alias("perplexity"), F.exp("limit").alias("threshold"),
        F.coalesce(F.col("nats") <= F.coalesce("limit", F.lit(math.inf)), F.lit(False)).alias("keep"), "k1", "k2")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as of good quality and not toxic."""
    return labels.filter((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs, trusted_ids(labels)).drop("k1", "k2")


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rejected documents."""
    gone = classify(docs, trusted_ids(labels)).filter(~F.col("keep"))
    k1, k2 = (free_name(docs.columns, f"quality_{c}") for c in ("k1", "k2"))
    gone = save(gone.select(F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct(), "quality-gone")
    key = row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.withColumns({k1: key[0], k2: key[1]})
    return keyed.join(maybe_broadcast(gone, 32), [k1, k2], "left_anti").select(*docs.columns)
