"""Mixing sources to target weights with hash-threshold histograms.

Every row gets a 60-bit hash of its content. A source that should contribute
``target`` words out of ``source_size`` takes all its rows ``floor(target /
source_size)`` times, and once more the rows whose hash lies below a threshold.
The threshold comes from nested histograms: words by (source, top 12 hash
bits) show the bucket in which the running sum passes the budget; only the rows
of that bucket are summed again by the next 12 bits, and only those of that
bucket by the hash itself. Rows are never sorted, and the filter is a
comparison with the source's threshold. Rows that are the same share a hash; of
those at the threshold as many are taken as come nearest to the budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import free_name, save, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
HASH_BITS = 60
#: Bits that the first two histograms resolve; the last one takes what remains.
LEVELS = (12, 12)


def content_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of the MD5 of id and text, as a long."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> adds weight, target, repeats, budget.

    Sources in code point order (null last) take the weights in turn. All
    targets together are all words. A target above ``max_repeat`` times its
    source stops there and the rest is shared anew by weight, until none is
    above: in order of size over weight, the sources that stop are a prefix,
    so running sums find where it ends. One row per source passes one task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy()
    cycle = F.array(*(F.lit(int(w)) for w in weights))
    out = sizes.withColumn("weight", F.element_at(
        cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long"))
    cap = F.col("source_size") * max_repeat
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = (out.withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
           .withColumn("rest_weight", F.sum("weight").over(onward))
           .withColumn("stops", F.col("rest") * F.col("weight") > cap * F.col("rest_weight")))
    # the first source that does not stop fixes the share of all that follow
    open_rest = F.max(F.when(~F.col("stops"), F.struct("rest_weight", "rest"))).over(everything)
    share = (open_rest["rest"] * F.col("weight")).cast("double") / open_rest["rest_weight"].cast("double")
    ratio = F.col("target") / F.col("source_size")
    return (out.withColumn("target", F.when(F.col("stops"), cap.cast("double")).otherwise(share))
            .withColumn("repeats", F.when(F.col("source_size") > 0, F.least(F.floor(ratio), F.lit(max_repeat)))
                        .otherwise(0).cast("long"))
            .withColumn("budget", F.when(F.col("repeats") >= max_repeat, 0.0)
                        .otherwise(F.col("target") - F.col("repeats") * F.col("source_size")))
            .select("source", "source_size", "weight", "target", "repeats", "budget"))


def _boundary(parts: DataFrame, order: Column, last: bool) -> DataFrame:
    """Per source, the histogram part in which the running sum passes ``left``:
    (source, part, left), ``left`` less what lies before it. ``parts`` holds
    (source, part, words, copies, left). On the last level ``part`` is one hash
    of equal rows, and ``take`` says how many of them end nearest to the budget."""
    run = Window.partitionBy("source").orderBy(order)
    passed = (parts.withColumn("upto", F.sum("words").over(run))
              .filter(F.col("upto") > F.col("left"))
              .withColumn("nth", F.row_number().over(run)).filter("nth = 1")
              .withColumn("left", F.col("left") - (F.col("upto") - F.col("words"))))
    if last:
        each = F.col("words") / F.col("copies")
        whole = F.floor(F.col("left") / each)
        nearer = (whole + 1) * each - F.col("left") < F.col("left") - whole * each
        return passed.select("source", "part", F.least(whole + nearer.cast("long"), F.col("copies")).alias("take"))
    return passed.select("source", "part", "left")


def thresholds(sized: DataFrame, targets: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """(source, threshold, take) for every source with a boundary: rows of a
    hash below the threshold are taken, and ``take`` rows of that hash.

    ``sized`` has (source, size, hash). Each level reads only the rows of the
    boundary buckets found before; its sums are pre-aggregated by (source,
    bucket), so a source with a third of all rows is spread over its buckets.
    """
    rows = sized.select("source", "size", "hash").filter("size > 0")
    edge = targets.select("source", F.lit(0).cast("long").alias("prefix"), F.col("budget").alias("left"))
    shift = HASH_BITS
    for bits in (*levels, shift - sum(levels)):
        last = shift == bits
        inside = rows.withColumn("prefix", F.shiftright("hash", shift) if shift < HASH_BITS else F.lit(0).cast("long"))
        shift -= bits
        parts = (inside.groupBy("source", "prefix", F.shiftright("hash", shift).alias("part"))
                 .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("copies")))
        known = edge.withColumnsRenamed({"source": "edge_source", "prefix": "edge_prefix"})
        near = parts.join(known, F.col("source").eqNullSafe(F.col("edge_source"))
                          & (F.col("prefix") == F.col("edge_prefix")))
        edge = _boundary(near.select("source", "part", "words", "copies", "left"), F.col("part"), last)
        if not last:
            edge = edge.withColumnRenamed("part", "prefix")
    return edge.select("source", F.col("part").alias("threshold"), "take")


def first_rows(rows: DataFrame, keys: Sequence[str], take: str, taken: str) -> DataFrame:
    """``rows`` with one more column, ``taken``: whether a row is one of the
    first ``take`` (any, but fixed) of those equal in ``keys``. They are
    counted in the blocks they were written in, so that a key with very many
    rows is not one task's."""
    row, block, before = (free_name(rows.columns, f"mix_{c}") for c in ("row", "block", "before"))
    kept = save(rows.withColumn(row, F.monotonically_increasing_id()), "mix-edge").withColumn(block, F.shiftright(row, 33))
    counts = kept.groupBy(*keys, block).agg(F.count(F.lit(1)).alias(before))
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    names = {c: free_name(kept.columns, f"of_{c}") for c in (*keys, block)}
    counts = save(counts.withColumnsRenamed(names), "mix-edge-blocks")
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    own = Window.partitionBy(*keys, block).orderBy(row)
    nth = F.row_number().over(own) + F.col(before)
    return kept.join(counts, same).withColumn(taken, nth <= F.col(take)).drop(*names.values(), row, block, before)


def mix(rows: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``rows`` (source, size, hash, any others) with source_size, target and
    ``times``: how often the mix takes the row (0 to ``max_repeat``).

    Of repeated rows at a threshold some are taken once more and some are not;
    which ones is open, as they are the same. A source without words has target 0, and its rows are not taken. ``rows`` is read
    several times and should be a stored table.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = save(source_targets(sizes, weights, max_repeat), "mix-targets")
    edges = thresholds(rows, targets)
    plan = targets.select("source", "source_size", "target", "repeats").join(
        edges.withColumnRenamed("source", "edge_source"),
        F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source")
    plan = save(plan.withColumnRenamed("source", "plan_source"), "mix-plan")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    return _with_times(joined, "hash", "threshold", "repeats", "take", "times").drop("repeats", "threshold", "take")


def _with_times(joined: DataFrame, hashed: str, threshold: str, repeats: str, take: str, times: str) -> DataFrame:
    at = F.coalesce(F.col(hashed) == F.col(threshold), F.lit(False))
    below = F.coalesce(F.col(hashed) < F.col(threshold), F.lit(False))
    # a threshold belongs to one source
    edge = first_rows(joined.filter(at), [c for c in ("source",) if c in joined.columns] + [hashed], take, times)
    rest = joined.filter(~at).withColumn(times, below)
    both = rest.unionByName(edge)
    return both.withColumn(times, F.col(repeats) + F.col(times).cast("long"))


def mix_report(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    Null texts have size 0, and an empty table gives no rows. Other columns
    are not read.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       content_hash(F.col("doc_id"), F.col("text")).alias("hash"))
    out = mix(save(rows, "mix-rows"), weights, max_repeat)
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("times")).alias("taken"), "times")


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mix itself: ``docs`` with its own columns, each row as often as it
    is taken. The thresholds come from narrow rows; the texts are then filtered
    in place, by a join with one row per source."""
    rows = docs.select("source", word_count(F.col("text")).alias("size"),
                       content_hash(F.col("doc_id"), F.col("text")).alias("hash"))
    narrow = save(rows, "mix-rows")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = save(source_targets(sizes, weights, max_repeat), "mix-targets")
    source, repeats, threshold, take, hashed, times, copy = (free_name(docs.columns, f"mix_{c}") for c in (
        "source", "repeats", "threshold", "take", "hash", "times", "copy"))
    plan = targets.select("source", "repeats").join(
        thresholds(narrow, targets).withColumnRenamed("source", "edge_source"),
        F.col("source").eqNullSafe(F.col("edge_source")), "left")
    plan = save(plan.select(F.col("source").alias(source), F.col("repeats").alias(repeats),
                            F.col("threshold").alias(threshold), F.col("take").alias(take)), "mix-plan")
    hashes = docs.withColumn(hashed, content_hash(F.col("doc_id"), F.col("text")))
    joined = hashes.join(plan, F.col("source").eqNullSafe(F.col(source)))
    timed = _with_times(joined, hashed, threshold, repeats, take, times)
    taken = timed.withColumn(copy, F.array_repeat(F.lit(1), F.col(times).cast("int"))).filter(F.size(copy) > 0)
    return taken.select(*docs.columns, F.explode(copy).alias(copy)).drop(copy)


#: DuckDB: the same sums over rows in hash order.
MIXING_SQL = r"""
WITH rows AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS hash
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM sizes),
running AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT
            - coalesce(sum(source_size * 3) OVER (ORDER BY source_size / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
         (sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest_weight
  FROM weighted),
stopping AS (SELECT *, rest * weight > source_size * 3 * rest_weight AS stops FROM running),
opened AS (SELECT rest AS open_rest, rest_weight AS open_weight FROM stopping WHERE NOT stops
           ORDER BY rest_weight DESC, rest DESC LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN stops THEN (source_size * 3)::DOUBLE
              ELSE (open_rest * weight)::DOUBLE / open_weight::DOUBLE END AS target
  FROM stopping, opened),
repeated AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size)::BIGINT, 3) ELSE 0 END AS repeats FROM targets),
budgets AS (
  SELECT *, CASE WHEN repeats >= 3 THEN 0.0::DOUBLE ELSE target - repeats * source_size END AS budget FROM repeated),
hashes AS (SELECT source, hash, sum(size)::BIGINT AS words, count(*) AS copies FROM rows WHERE size > 0 GROUP BY source, hash),
runs AS (SELECT *, (sum(words) OVER (PARTITION BY source ORDER BY hash))::BIGINT AS upto FROM hashes),
passed AS (
  SELECT r.source, min(hash) AS threshold, arg_min(words::DOUBLE / copies, hash) AS each, arg_min(copies, hash) AS copies,
         arg_min(budget - (upto - words), hash) AS rest
  FROM runs r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source WHERE upto > budget GROUP BY r.source),
edges AS (
  SELECT source, threshold, least(copies, floor(rest / each) + CASE WHEN (floor(rest / each) + 1) * each - rest
         < rest - floor(rest / each) * each THEN 1 ELSE 0 END) AS take FROM passed),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source, hash) AS nth FROM rows),
timed AS (
  SELECT n.doc_id, n.size, b.source_size, b.target, (b.repeats + CASE WHEN n.hash < e.threshold
         OR (n.hash = e.threshold AND n.nth <= e.take) THEN 1 ELSE 0 END)::BIGINT AS times
  FROM numbered n JOIN budgets b ON n.source IS NOT DISTINCT FROM b.source
  LEFT JOIN edges e ON n.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, size * times AS taken, times FROM timed
"""
