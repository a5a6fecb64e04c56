"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import save


def _is_stars(edges: DataFrame) -> bool:
    """True if every larger end hangs under one root and no root hangs."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    met = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return met.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for each node of a link, the smallest node that it reaches.

    Each round hangs a node's larger neighbours under its smallest neighbour
    (large star), then its smaller neighbours (small star); the rounds grow with
    the logarithm of the longest path. Only sums and joins by node are used, no
    node's neighbours are gathered; each round is written to the shared folder.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = save(pairs, "components")
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # stored, so that the joins can split the edges of a node with many neighbours
        least = save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components-least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = save(large, "components-large")
        least = save(large.groupBy("u").agg(F.min("v").alias("m")), "components-least")
        small = (large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = save(small, "components")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
