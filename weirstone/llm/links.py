"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node next to it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node with an edge; the root is the smallest node of its component.

    ``edges`` has two columns of one type, one row per link at least once, in
    either direction.  Both steps keep the components; they end in stars, after
    a number of rounds that grows with the logarithm of the longest chain.  A
    node with very many links is pre-aggregated, and joins on it can be split.
    """
    a, b = edges.columns
    ends = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = stored(ends.distinct(), "edges")
    while True:
        current = stored(_small_star(_large_star(current)), "edges")
        several = current.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        inner = current.select(F.col("v").alias("u")).distinct().join(current, "u", "left_semi")
        if several.union(inner).isEmpty():
            break
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
