"""Secret scans with a trigram inverted index, in DataFrame functions only.

1. For each rule's regex a Boolean trigram query is derived: a conjunction of
   clauses, each a disjunction of literal strings that any match must contain,
   each string the conjunction of its trigrams.
2. The index holds postings (trigram, row) for the trigrams that some query
   names, over every whole text, lower-cased (A-Z).
3. The postings of a row meet by its key and the queries are evaluated on them:
   the rules for which the row is a candidate. Rules without a mandatory
   trigram (a run of hex digits, say) have no query and scan every row.
4. Candidates are verified with the regex itself; spans are code point offsets.
"""

from __future__ import annotations

import re._parser as regex_parser
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import free_name, maybe_broadcast, row_key, save

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Alternatives that the derivation enumerates before it closes a clause; only
#: the selectivity of a query depends on it, never what is found.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` (syntax that Java and RE2 read
    alike), leftmost and non-overlapping, of which those stay whose ``group``
    has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three base kinds of the contract.
BASE_RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Public formats of further keys.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: Clauses (all must hold) of alternatives (one must hold) of trigrams (all present).
Query = tuple[tuple[frozenset[str], ...], ...]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _clause(strings: set[str]) -> tuple[frozenset[str], ...] | None:
    """The clause "one of the strings occurs"; None where it says nothing."""
    grams = {_trigrams(s) for s in strings}
    if not grams or frozenset() in grams:
        return None
    return tuple(sorted((g for g in grams if not any(h < g for h in grams)), key=sorted))


def _exact(op, arg) -> set[str] | None:
    """The few lower-cased strings that a regex node can match, or None."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()} if arg < 128 else None
    if name == "IN":
        chars = set()
        for kind, value in arg:
            if str(kind) == "LITERAL" and value < 128:
                chars.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] < 128 and value[1] - value[0] < 8:
                chars.update(chr(c).lower() for c in range(value[0], value[1] + 1))
            else:
                return None
        return chars if len(chars) <= 8 else None
    if name == "SUBPATTERN":
        return _exact_sequence(arg[3])
    if name == "BRANCH":
        found = [_exact_sequence(b) for b in arg[1]]
        return None if any(f is None for f in found) else set().union(*found)
    if name == "MAX_REPEAT" and arg[1] <= 4:
        once = _exact_sequence(arg[2])
        if once is None:
            return None
        out = {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(once, repeat=n)}
        return out if len(out) <= MAX_STRINGS else None
    return None


def _exact_sequence(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        found = _exact(op, arg)
        if found is None or len(found) * len(out) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in found}
    return out


def trigram_query(pattern: str) -> Query:
    """The trigram query of a regex; empty if it has no mandatory trigram.

    Runs of enumerable nodes join to strings; whatever else stands between
    them ends a run. Matching texts satisfy the query (not the reverse).
    """
    clauses, run = [], {""}

    def close() -> None:
        nonlocal run
        if (clause := _clause(run)) is not None:
            clauses.append(clause)
        run = {""}

    def walk(nodes) -> None:
        nonlocal run
        for op, arg in nodes:
            found = _exact(op, arg)
            if found is not None:
                if len(found) * len(run) > MAX_STRINGS:
                    close()
                run = {a + b for a in run for b in found}
                continue
            close()
            if str(op) == "SUBPATTERN":
                walk(arg[3])
                close()
            elif str(op) == "MAX_REPEAT" and arg[0] >= 1:
                walk(arg[2])
                close()

    walk(regex_parser.parse(pattern))
    close()
    return tuple(dict.fromkeys(clauses))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def postings(rows: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The index: (trigram, k1, k2) for every trigram that a rule's query names
    and every row (k1, k2, text) that holds it."""
    grams = sorted({g for r in rules for c in trigram_query(r.pattern) for alt in c for g in alt})
    low = rows.select("k1", "k2", lower_ascii(F.col("text")).alias("low"))
    held = F.filter(F.array(*(F.lit(g) for g in grams)).cast("array<string>"), lambda g: F.contains(F.col("low"), g))
    return low.select(F.explode(held).alias("trigram"), "k1", "k2")


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(k1, k2, rules): the rules whose trigram query holds on the row's
    postings. A row's postings are at most the trigrams that rules name."""
    met = index.groupBy("k1", "k2").agg(F.collect_set("trigram").alias("held"))

    def holds(query: Query) -> Column:
        every = lambda grams: reduce(Column.__and__, (F.array_contains("held", g) for g in sorted(grams)))
        return reduce(Column.__and__, (reduce(Column.__or__, map(every, c)) for c in query))

    named = [F.when(holds(q), F.lit(i)) for i, r in enumerate(rules) if (q := trigram_query(r.pattern))]
    return (met.select("k1", "k2", F.array_compact(F.array(*named).cast("array<int>")).alias("rules"))
            .filter(F.size("rules") > 0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(values: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body(block, number)`` of about sqrt(n) blocks of a non-empty array, so that steps that
    grow an array one by one copy a block, never the whole."""
    size = F.greatest(F.ceil(F.sqrt(F.size(values))).cast("int"), F.lit(1))
    return let(size, lambda k: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / k).cast("int")), lambda b: body(F.slice(values, b * k + 1, k), b)))


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """array<int>: for each element, all elements before it (and 0) taken
    together by ``step``, an associative one such as sum or maximum."""
    zero, none = F.lit(0), F.array().cast("array<int>")
    total = lambda block: F.aggregate(block, zero, step)

    def through(start: Column, block: Column) -> Column:
        grow = lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(block, F.struct(start.alias("at"), none.alias("out")), grow, lambda acc: acc["out"])

    def whole(x: Column) -> Column:
        return let(_blocks(x, lambda block, _: total(block)), lambda totals: let(
            F.transform(totals, lambda _, b: total(F.slice(totals, F.lit(1), b))), lambda starts: F.flatten(
                _blocks(x, lambda block, b: through(F.get(starts, b), block)))))

    return let(values, lambda x: F.when(F.size(x) > 0, whole(x)).otherwise(none))


def _lengths(pieces: Column) -> Column:
    return F.transform(pieces, lambda p: F.char_length(p))


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """array<struct<start, kind, end>> of one rule's matches in ``text``.

    The pieces between the matches and the matches alternate, so running sums
    of their lengths give each match its place, in code points.
    """
    pattern = F.lit(rule.pattern)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    parts = F.arrays_zip(
        _lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("hit"),
        _lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("kept"),
        _lengths(F.split(text, rule.pattern, -1)).alias("gap"))

    def placed(p: Column) -> Column:
        before = running(F.transform(p, lambda z: z["gap"] + z["hit"]), lambda x, y: x + y)
        whole = F.transform(F.arrays_zip(p.alias("p"), before.alias("at")), lambda z: F.struct(
            (z["at"] + z["p"]["gap"]).alias("start"), F.lit(number).alias("kind"),
            (z["at"] + z["p"]["gap"] + z["p"]["hit"]).alias("end"), z["p"]["kept"].alias("kept")))
        return F.transform(F.filter(whole, lambda z: z["kept"] >= rule.least),
                           lambda z: F.struct(z["start"].alias("start"), z["kind"].alias("kind"), z["end"].alias("end")))

    # what follows the last match is a gap without one
    found = let(F.filter(parts, lambda z: z["hit"].isNotNull()), placed)
    return F.when(text.rlike(rule.pattern), found).otherwise(none)


def with_spans(docs: DataFrame, rules: Sequence[Rule] = RULES) -> tuple[DataFrame, str]:
    """``docs`` with one more column, array<struct<start, kind, end>> sorted by
    start, then kind (a rule's number), and that column's name.

    ``docs`` needs doc_id and text. Null text has no spans; repeated rows each
    get theirs; other columns stay. Rows and candidates meet by a hash of
    id and text; the candidates are broadcast where their counted size allows,
    so that texts stay where they are, else both are shuffled by the key.
    """
    k1, k2, spans, chosen = (free_name(docs.columns, f"secret_{c}") for c in ("k1", "k2", "spans", "rules"))
    key = row_key(F.col("doc_id"), F.col("text"))
    index = save(postings(docs.select(key[0].alias("k1"), key[1].alias("k2"), "text"), rules), "secret-postings")
    found = save(candidates(index, rules).select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("rules").alias(chosen)),
                 "secret-candidates")
    keyed = docs.withColumns({k1: key[0], k2: key[1]})
    joined = keyed.join(maybe_broadcast(found, 64), [k1, k2], "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    each = []
    for i, rule in enumerate(rules):
        own = rule_spans(F.col("text"), rule, i)
        each.append(F.when(F.array_contains(F.col(chosen), i), own).otherwise(none) if trigram_query(rule.pattern) else own)
    out = joined.withColumn(spans, F.array_sort(F.concat(*each)))
    return out.select(*docs.columns, F.coalesce(F.col(spans), none).alias(spans)), spans


def _listed(spans: Column, rules: Sequence[Rule]) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: counts of the base kinds, the hash of their list,
    and all spans as text. Null and empty texts have none."""
    found, spans = with_spans(docs.select("doc_id", "text"), rules)
    base = len(BASE_RULES)
    count = lambda i: F.size(F.filter(spans, lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id", *(count(i).alias(f"n_{r.kind}") for i, r in enumerate(rules[:base])),
        F.sha2(_listed(F.filter(spans, lambda s: s["kind"] < base), rules), 256).alias("base_sha256"),
        _listed(F.col(spans), rules).alias("spans"))


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with the sorted ``spans`` masked. A place in a text is found by
    counting from its start, so the text is cut into stretches of about sqrt(n)
    spans first, and the pieces between the spans out of these."""
    def stretch(some: Column, _: Column) -> Column:
        low, high = F.get(some, F.lit(0))["from"], F.element_at(some, -1)["to"]
        return let(F.substring(text, low + 1, high - low), lambda part: F.transform(some, lambda s: F.concat(
            F.substring(part, s["from"] - low + 1, s["to"] - s["from"]), F.lit(mask))))

    def pieces(s: Column) -> Column:
        reached = running(F.transform(s, lambda x: x["end"]), lambda x, y: F.greatest(x, y))
        heads = F.filter(F.transform(F.arrays_zip(s.alias("s"), reached.alias("at")), lambda z: F.struct(
            z["at"].alias("from"), z["s"]["start"].alias("to"))), lambda z: (z["to"] > z["from"]) | (z["from"] == 0))
        return let(heads, lambda h: F.array_join(F.flatten(_blocks(h, stretch)), ""))

    end = F.array_max(F.transform(spans, lambda s: s["end"]))
    return F.concat(let(spans, pieces), F.substring(text, end + 1, F.char_length(text)))


def redact(docs: DataFrame, rules: Sequence[Rule] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mask`` (spans that overlap or
    touch as one) and n_chars, where there is such a column, counted anew for
    the changed rows. Rows without secrets stay as they are."""
    found, spans = with_spans(docs, rules)
    text = F.col("text")
    clean = _masked(text, F.col(spans), mask)
    changed = F.size(spans) > 0
    new = {"text": F.when(changed, clean).otherwise(text)}
    out = found.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns), F.col(spans))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _sql_spans(rule: Rule, number: int) -> str:
    rx = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""
  SELECT doc_id, rid, {number} AS kind, '{rule.kind}' AS name, spot AS start, spot + length(hit) AS stop FROM (
    SELECT doc_id, rid, hit, kept, pos,
           sum(length(gap)) OVER (PARTITION BY rid ORDER BY pos) + coalesce(sum(length(hit)) OVER (
             PARTITION BY rid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spot
    FROM (SELECT doc_id, rid, unnest(regexp_split_to_array(text, {rx})) AS gap,
                 unnest(regexp_extract_all(text, {rx}, 0)) AS hit, unnest(regexp_extract_all(text, {rx}, {rule.group})) AS kept,
                 generate_subscripts(regexp_split_to_array(text, {rx}), 1) AS pos
          FROM rows WHERE regexp_matches(text, {rx}))) WHERE hit IS NOT NULL AND length(kept) >= {rule.least}"""


#: DuckDB: the same spans by a plain scan of every rule over every text.
SECRETS_SQL = f"""
WITH rows AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_sql_spans(r, i) for i, r in enumerate(RULES))}),
listed AS (SELECT rid, kind, name, start, name || ':' || start::BIGINT || ':' || stop::BIGINT AS item FROM spans),
per_row AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex,
         string_agg(item, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
         string_agg(item, ',' ORDER BY start, kind) AS spans
  FROM listed GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM rows LEFT JOIN per_row USING (rid)
"""
