"""License scans by diagonal voting.

All rolling word k-gram hashes of all texts are joined in Spark to the
positions of the same k-grams in the license templates. A hit at text position
``p`` and template position ``t`` votes for the diagonal ``p - t``; votes are
summed by (row, template, diagonal), neighbouring diagonals (words inserted or
left out) merge to one span, and the spans are verified on the words of the
text itself.

Words are the runs of digits, letters and characters beyond ASCII of the text
with A-Z lowered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import maybe_broadcast, row_key, save
from clickpulse.llm.wordhash import LETTER_OR_DIGIT, kgrams, slices, words

K = 2
#: Diagonals up to this far apart belong to one span.
DIAGONAL_GAP = 3
#: Share of a template's words that a verified span must hold, in order.
MIN_COVER = 0.8
#: k-grams in one row of hashes (a longer text makes several rows).
CHUNK = 1 << 14


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool = False  # a phrase whose words must stand consecutively
    whole: bool = False  # a wording of which no word may differ

    @property
    def words(self) -> list[str]:
        return self.text.split()


# The base phrases of the contract.
BASE_TEMPLATES = (
    Template("mit", "mit license", exact=True),
    Template("apache", "apache license", exact=True),
    Template("gpl", "general public license", exact=True),
)
# Wordings of public licenses that are recognised with small changes too.
MORE_TEMPLATES = (
    Template("agpl", "gnu affero general public license", whole=True),
    Template("lgpl", "gnu lesser general public license", whole=True),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file "
                       "except in compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("cc-by", "licensed under a creative commons attribution license"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                    "general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files"),
    Template("mpl", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)
TEMPLATES = BASE_TEMPLATES + MORE_TEMPLATES

_GRAMS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("base", pa.int64()), ("grams", pa.list_(pa.int64()))])


def _gram_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, k1, k2 = batch.column("text"), batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for first, last in slices(texts):
                found = words(texts.slice(first, last - first), LETTER_OR_DIGIT)
                at, value = kgrams(found, k)
                row, place = found.doc[at], found.position()[at]
                # a row of hashes for each text and each CHUNK positions in it
                cut = np.ones(len(at), bool)
                cut[1:] = (row[1:] != row[:-1]) | (place[1:] % CHUNK == 0)
                begin = np.flatnonzero(cut)
                lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(at)), pa.int32()),
                                                 pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[first + row[begin]]), pa.array(k2[first + row[begin]]),
                     pa.array(place[begin].astype(np.int64)), lists], schema=_GRAMS)
    return run


def gram_hashes(rows: DataFrame, k: int = K) -> DataFrame:
    """(k1, k2, pos, gram): every rolling k-gram hash of every text, with its
    word position. ``rows`` has (k1, k2, text)."""
    packed = rows.mapInArrow(_gram_rows(k), "k1 long, k2 long, base long, grams array<long>")
    return (packed.select("k1", "k2", "base", F.posexplode("grams").alias("nth", "gram"))
            .select("k1", "k2", (F.col("base") + F.col("nth")).alias("pos"), "gram"))


def template_positions(spark, templates: Sequence[Template] = TEMPLATES, k: int = K) -> DataFrame:
    """(template, tpos, gram): fixed and small, a row for each template word."""
    found = words(pa.array([t.text for t in templates]), LETTER_OR_DIGIT)
    at, value = kgrams(found, k)
    rows = [(int(found.doc[a]), int(p), int(v)) for a, p, v in zip(at, found.position()[at], value.view(np.int64))]
    return spark.createDataFrame(rows, "template int, tpos long, gram long")


def voted_spans(hits: DataFrame, least: Sequence[int], gap: int = DIAGONAL_GAP) -> DataFrame:
    """(k1, k2, template, low, high, drift): word ranges on merged neighbouring
    diagonals that got ``least[template]`` votes or more, and how far apart the
    diagonals of one are."""
    votes = (hits.groupBy("k1", "k2", "template", (F.col("pos") - F.col("tpos")).alias("diagonal"))
             .agg(F.countDistinct("tpos").alias("votes"), F.min("pos").alias("low"), F.max("pos").alias("high")))
    order = Window.partitionBy("k1", "k2", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal", 1).over(order) > gap
    merged = (votes.withColumn("span", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(
                  order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
              .groupBy("k1", "k2", "template", "span")
              .agg(F.sum("votes").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"),
                   (F.max("diagonal") - F.min("diagonal")).alias("drift")))
    need = F.element_at(F.array(*(F.lit(int(n)) for n in least)), F.col("template") + 1)
    return merged.filter(F.col("votes") >= need).select("k1", "k2", "template", "low", "high", "drift")


def in_order(template: Sequence[str], text: Sequence[str]) -> int:
    """Length of the longest common subsequence of two word lists."""
    best = [0] * (len(template) + 1)
    for word in text:
        before = 0
        for i, t in enumerate(template):
            before, best[i + 1] = best[i + 1], before + 1 if t == word else max(best[i + 1], best[i])
    return best[-1]


def may_differ(template: Template, min_cover: float) -> int:
    """Words of a template that a text may lack, by the decimal value of ``min_cover``."""
    n = len(template.words)
    return 0 if template.exact or template.whole else n - math.ceil(n * Fraction(str(min_cover)))


def places(phrase: Sequence[str], text: Sequence[str]) -> list[int]:
    n = len(phrase)
    return [i for i in range(len(text) - n + 1) if text[i:i + n] == phrase]


def verify(text: list[str], spans: list[dict], templates: Sequence[Template], min_cover: float
           ) -> tuple[set[tuple[int, int]], set[str], float]:
    """Places (template, first word) of exact phrases, labels found by the
    other templates, and the best cover (1 with a phrase, else that of the
    best span, from 0)."""
    found, labels, score = set(), set(), 0.0
    for span in spans:
        t = templates[span["template"]]
        phrase = t.words
        # the span's grams may start or end within the template
        low = max(0, span["low"] - (0 if t.exact else len(phrase)))
        high = span["high"] + (K if t.exact else len(phrase))
        part = text[low:high]
        if t.exact:
            at = places(phrase, part)
            found.update((span["template"], low + i) for i in at)
            score = max(score, 1.0 if at else 0.0)
            continue
        # a span may hold several copies. A copy takes the template's length and what
        # its diagonals drift (the merged ones at most); windows begin so close that
        # each copy lies whole in one
        drift = max(DIAGONAL_GAP, min(span["drift"], len(phrase)))
        step = DIAGONAL_GAP + 1
        room = len(phrase) + drift + step - 1
        for i in range(0, max(1, len(part) - room + step), step):
            cover = in_order(phrase, part[i:i + room]) / len(phrase)
            if cover >= (1.0 if t.whole else min_cover):
                labels.add(t.label)
                score = max(score, cover)
            if cover == 1.0:
                break
    return found, labels, score


_REPORT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double")


def _verified(templates: Sequence[Template], min_cover: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("text"), batch.column("spans")
            for first, last in slices(texts):
                found = words(texts.slice(first, last - first), LETTER_OR_DIGIT)
                count = found.counts()
                begin = np.cumsum(count) - count
                out = []
                for i, listed in enumerate(spans.slice(first, last - first).to_pylist()):
                    places_, labels, score = set(), set(), 0.0
                    if listed:
                        own = slice(begin[i], begin[i] + count[i])
                        text = [found.data[s:e].tobytes().decode() for s, e in zip(found.start[own], found.end[own])]
                        places_, labels, score = verify(text, listed, templates, min_cover)
                    base = {templates[t].label for t, _ in places_}
                    starts = [p for _, p in places_]
                    out.append((int(count[i]), len(places_), min(starts, default=None), max(starts, default=None),
                                ",".join(sorted(base)), ",".join(sorted(base | labels)), score))
                cols = list(zip(*out))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first).cast(pa.int64()),
                     *(pa.array(c, k) for c, k in zip(cols, kinds))],
                    names=[c.split()[0] for c in _REPORT.split(", ")])
    return run


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, min_cover: float = MIN_COVER) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text).

    n_words: words of the whole text; n_base, first_word, last_word: places of
    the exact phrases; base_labels, labels: distinct labels of the exact
    phrases and of all templates, sorted and comma-joined; score: the best
    cover. Null and empty texts have no words and no labels; repeated rows each
    get the same answer, as spans meet rows by a hash of id and text.
    """
    key = row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.select(key[0].alias("k1"), key[1].alias("k2"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = template_positions(docs.sparkSession, templates)
    hits = gram_hashes(keyed.select("k1", "k2", "text")).join(F.broadcast(known), "gram")  # fixed templates
    # d words that differ break up to K * d grams of a template
    least = [max(1, len(t.words) - K + 1 - K * may_differ(t, min_cover)) for t in templates]
    spans = save(voted_spans(hits, least).groupBy("k1", "k2").agg(
        F.sort_array(F.collect_list(F.struct("template", "low", "high", "drift"))).alias("spans")), "license-spans")
    longest = spans.agg(F.max(F.size("spans"))).first()[0] or 0
    near = maybe_broadcast(spans, 32 + 32 * longest)
    joined = keyed.join(near, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_verified(templates, min_cover), _REPORT)
