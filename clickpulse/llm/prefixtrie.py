"""Prefix trie of conversations, built from burst containers.

A conversation is a sequence of turn ids (16-byte digests of role and text);
texts do not travel beyond the scan. Conversations of the same sequence become
one row with their number and smallest id. Starting at the root, a trie head
holds a container with the rest of every sequence that passes it. A container
with too many sequences or turns bursts: its head becomes a node, and its
sequences are dealt by their next turn id into containers one turn further
down. Containers that are small enough are sorted by their suffixes and swept,
which gives all nodes below their heads at once. Sums over subtrees then go up
through the burst heads, one sum by parent for each depth.

A sequence is held as one row (24 bytes a turn). What is never held together is
all sequences under one head, or all ids of one sequence: these are sorted,
joined piecewise, and hashed as they come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import maybe_broadcast, save

#: A container bursts beyond so many different sequences, or turns below its head.
CONTAINER_ROWS, CONTAINER_TURNS = 4096, 65536
#: Conversations share turns with the one at the start of their block of ids.
BLOCK, MOST_SHARED = 100, 5
#: Characters of joined ids in one piece.
PIECE = 1 << 20
NO_IDS = hashlib.sha256(b"").hexdigest()

_NODE_DDL = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
             "saved_tokens long, ends_sha256 string, parent binary")
_NODE = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                   ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                   ("ends_sha256", pa.string()), ("parent", pa.binary())])
_PIECE = pa.schema([("cls", pa.binary()), ("least", pa.int64()), ("piece", pa.string())])
_ENDS = pa.schema([("cls", pa.binary()), ("ends", pa.string())])
COLUMNS = [c for c in _NODE.names if c != "parent"]


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, chars): each conversation's turns in order, as turn ids
    and code points. ``turns`` has conv_id, turn, role, text; rows without a
    conv_id belong to no conversation and are left out. Null turns come first;
    turns of the same number go by their ids, repeated rows all stay."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                 F.unhex(F.md5(name)).alias("id"), F.char_length(text).alias("chars")).alias("t"))
    own = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return own.select("conv_id", F.col("t.id").alias("ids"), F.col("t.chars").alias("chars"))


def rebuilt(own: DataFrame, block: int = BLOCK, most: int = MOST_SHARED) -> DataFrame:
    """Each conversation c with its first h turns, h = crc32(c) % (most + 1),
    replaced by the first h of conversation c - c % block (all it has, if
    fewer; none, if it is not there). A block start serves ``block`` rows."""
    conv = F.col("conv_id")
    own = save(own.withColumn("base", conv - conv % block), "trie-own")
    starts = own.filter(F.col("conv_id") == F.col("base")).select(
        "base", *(F.slice(c, 1, most).alias(f"base_{c}") for c in ("ids", "chars")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    joined = own.join(starts, "base", "left").withColumn("h", h)

    def both(c: str, kind: str) -> Column:
        shared = F.coalesce(F.col(f"base_{c}"), F.array().cast(f"array<{kind}>"))
        return F.concat(F.slice(shared, F.lit(1), F.col("h")), F.slice(c, F.col("h") + 1, F.greatest(F.size(c), F.lit(1))))

    return joined.select("conv_id", both("ids", "binary").alias("ids"), both("chars", "int").alias("chars"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (cls, conv_id) -> joined ids, a new piece where cls changes."""
    name, least, held, size = None, None, [], 0
    for batch in batches:
        found = []
        for cls, conv in zip(batch.column("cls").to_pylist(), batch.column("conv_id").to_pylist()):
            if held and (cls != name or size > PIECE):
                found.append((name, least, ",".join(held)))
                held, size = [], 0
            if not held:
                name, least = cls, conv
            held.append(str(conv))
            size += len(held[-1]) + 1
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _PIECE)], schema=_PIECE)
    if held:
        yield pa.RecordBatch.from_pylist([{"cls": name, "least": least, "piece": ",".join(held)}], schema=_PIECE)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (cls, least, piece) -> the hash of the joined pieces of each cls."""
    name, hashed = None, None
    for batch in batches:
        found = []
        for cls, piece in zip(batch.column("cls").to_pylist(), batch.column("piece").to_pylist()):
            if cls != name:
                if hashed is not None:
                    found.append((name, hashed.hexdigest()))
                name, hashed = cls, hashlib.sha256(piece.encode())
            else:
                hashed.update(("," + piece).encode())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _ENDS)], schema=_ENDS)
    if hashed is not None:
        yield pa.RecordBatch.from_pylist([{"cls": name, "ends": hashed.hexdigest()}], schema=_ENDS)


def _distinct(convs: DataFrame) -> DataFrame:
    """One row per different sequence: ids, chars, first (smallest conv_id),
    n (conversations), ends (hash of their ids). Ids of one sequence are sorted
    and joined in ranges first, so that the task that hashes a very common one
    reads a few long pieces."""
    named = save(convs.withColumn("cls", F.unhex(F.md5(F.array_join(F.transform("ids", lambda x: F.hex(x)), "")))), "trie-convs")
    classes = named.groupBy("cls").agg(F.first("ids").alias("ids"), F.first("chars").alias("chars"),
                                       F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n"))
    pieces = (named.select("cls", "conv_id").repartitionByRange("cls", "conv_id").sortWithinPartitions("cls", "conv_id")
              .mapInArrow(_pieces, "cls binary, least long, piece string"))
    ends = (pieces.repartition("cls").sortWithinPartitions("cls", "least").mapInArrow(_digests, "cls binary, ends string"))
    return save(classes.join(ends, "cls").drop("cls"), "trie-sequences")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by head, then ids -> the nodes of every container."""
    head, rows = None, []
    for batch in batches:
        found = []
        for row in zip(*(batch.column(c).to_pylist() for c in _HELD)):
            if rows and row[0] != head:
                found += swept(rows)
                rows = []
            head = row[0]
            rows.append(row)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _NODE)], schema=_NODE)
    if rows:
        found = swept(rows)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _NODE)], schema=_NODE)


_HELD = ["head", "parent", "parent_conv", "depth", "ids", "chars", "first", "n", "ends"]


def swept(rows: list[tuple]) -> list[tuple]:
    """The nodes of one container from its sorted sequences: what a sequence
    has in common with the one before it are nodes that are there already."""
    _, parent, parent_conv, depth, *_ = rows[0]
    above, chars, conv, convs, ends = [-1], [rows[0][5][depth - 1]], [None], [0], [None]
    path, before = [0], []
    for _, _, _, _, ids, sizes, first, n, end in rows:
        ids, same = ids[depth:], 0
        while same < len(before) and same < len(ids) and before[same] == ids[same]:
            same += 1
        del path[same + 1:]
        for k in range(same, len(ids)):
            above.append(path[-1])
            path.append(len(chars))
            chars.append(sizes[depth + k])
            conv.append(None)
            convs.append(0)
            ends.append(None)
        at = path[-1]
        conv[at] = first if conv[at] is None else min(conv[at], first)
        convs[at] += n
        ends[at] = end
        before = ids
    below, children, leaves, saved = len(chars), [0] * len(chars), [0] * len(chars), [0] * len(chars)
    level = [depth] * below
    for i in range(1, below):
        level[i] = level[above[i]] + 1
    for i in range(below - 1, -1, -1):  # a node comes after its parent
        leaves[i] = leaves[i] or 1
        saved[i] += (convs[i] - 1) * chars[i]
        if (up := above[i]) >= 0:
            conv[up] = conv[i] if conv[up] is None else min(conv[up], conv[i])
            convs[up] += convs[i]
            children[up] += 1
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    return [(conv[i], level[i], conv[above[i]] if i else parent_conv, convs[i], children[i], leaves[i], saved[i],
             ends[i] or NO_IDS, None if i else parent) for i in range(below)]


class PrefixTrie:
    """The trie of ``convs`` (conv_id, ids, chars), conv_id without repetition.

    A container bursts beyond ``rows`` sequences or ``turns`` turns; results do
    not depend on these bounds. The root always bursts, into one container for
    each first turn id. No conversations make no nodes, not even a root.
    """

    def __init__(self, convs: DataFrame, rows: int = CONTAINER_ROWS, turns: int = CONTAINER_TURNS) -> None:
        self.rows, self.turns = rows, turns
        self.sequences = _distinct(convs)

    def _burst(self) -> tuple[list[DataFrame], list[DataFrame]]:
        """(burst heads by depth, the containers that are small enough)."""
        held = self.sequences.withColumns({
            "head": F.lit(b""), "parent": F.lit(None).cast("binary"), "parent_conv": F.lit(None).cast("long"),
            "depth": F.lit(0)}).select(*_HELD)
        heads, ready = [], []
        while True:
            left = F.size("ids") - F.col("depth")
            sizes = held.groupBy("head").agg(
                F.first("parent").alias("parent"), F.first("parent_conv").alias("parent_conv_id"),
                F.first("depth").cast("long").alias("depth"), F.min("first").alias("conv_id"), F.sum("n").alias("n_convs"),
                F.max(F.when(left == 0, F.col("ends"))).alias("ends"), F.count(F.lit(1)).alias("rows"), F.sum(left).alias("turns"),
                F.max(F.when(F.col("depth") > 0, F.get("chars", F.col("depth") - 1)).otherwise(0)).alias("chars"))
            over = (F.col("depth") == 0) | (F.col("rows") > self.rows) | ((F.col("turns") > self.turns) & (F.col("rows") > 1))
            big = save(sizes.filter(over), "trie-heads")
            if big.isEmpty():
                return heads, [*ready, held]
            heads.append(big)
            few = maybe_broadcast(big.select("head", F.col("conv_id").alias("head_conv")), 64)
            marked = held.join(few, "head", "left")
            ready.append(save(marked.filter("head_conv IS NULL").select(*_HELD), "trie-ready"))
            step = F.get("ids", F.col("depth"))
            held = save(marked.filter(F.col("head_conv").isNotNull() & (left > 0)).select(
                F.unhex(F.md5(F.concat("head", step))).alias("head"), F.col("head").alias("parent"),
                F.col("head_conv").alias("parent_conv"), (F.col("depth") + 1).alias("depth"), *_HELD[4:]), "trie-held")

    def nodes(self) -> DataFrame:
        """One row per node, as COLUMNS."""
        heads, ready = self._burst()
        containers = reduce(DataFrame.unionByName, ready)
        below = save(containers.repartition("head").sortWithinPartitions("head", "ids").mapInArrow(_sweep, _NODE_DDL), "trie-nodes")
        tops, found = below.filter("parent IS NOT NULL"), [below]
        for big in reversed(heads):  # of one depth each, the deepest first
            sums = tops.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                                              F.sum("saved_tokens").alias("below")).withColumnRenamed("parent", "head")
            none = F.lit(0).cast("long")
            level = save(big.join(sums, "head", "left").select(
                "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", none).alias("n_children"),
                F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
                ((F.col("n_convs") - 1) * F.col("chars") + F.coalesce("below", none)).alias("saved_tokens"),
                F.coalesce("ends", F.lit(NO_IDS)).alias("ends_sha256"), "parent"), "trie-burst")
            found.append(level)
            # the heads one depth up have their children here and among the containers
            tops = below.filter("parent IS NOT NULL").unionByName(level)
        return reduce(DataFrame.unionByName, found).select(*COLUMNS)


def prefix_trie_report(turns: DataFrame) -> DataFrame:
    return PrefixTrie(rebuilt(sequences(turns))).nodes()


#: DuckDB: every prefix of every conversation, grouped.
TRIE_SQL = """
WITH table_of AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS tab),
turns AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
         md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(chars ORDER BY turn NULLS FIRST, id) AS chars
  FROM turns GROUP BY conv_id),
hashed AS (
  SELECT own.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
         lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 6 AS h
  FROM own, table_of),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.ids, [])[1:o.h], o.ids[o.h + 1:]) AS ids,
         list_concat(coalesce(b.chars, [])[1:o.h], o.chars[o.h + 1:]) AS chars
  FROM hashed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
steps AS (
  SELECT conv_id, d, array_to_string(ids[1:d], '') AS node, CASE WHEN d = 0 THEN 0 ELSE chars[d] END AS chars, len(ids) = d AS ends
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ended
  FROM steps GROUP BY node, d),
children AS (SELECT left(node, 32 * (d::INT - 1)) AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
families AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
below AS (
  SELECT left(node, 32 * up::INT) AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM families) GROUP BY 1)
SELECT f.conv_id, f.d::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
       f.n_children::BIGINT AS n_children, below.n_leaves::BIGINT AS n_leaves, below.saved_tokens, sha256(f.ended) AS ends_sha256
FROM families f JOIN below USING (node) LEFT JOIN nodes p ON f.d > 0 AND p.node = left(f.node, 32 * (f.d::INT - 1))
"""
