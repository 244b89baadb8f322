"""Connected components by star contraction, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import written


def _contract(edges: DataFrame) -> DataFrame:
    """One round over ``(u, v)`` with ``u > v``: link larger neighbours to the least one, then smaller ones.

    Minima are partial sums per task, and the joins are plain equi-joins that
    adaptive execution can split at a node with very many links.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    large = written(large, "large-star")
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``) that isn't the least of its component.

    Both columns are longs; the root is the least node. Links of a node to
    itself and repeated ones don't matter. The number of rounds grows with the
    logarithm of the longest chain; each round is written to the shared folder.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = state(edges)
    while seen[0]:
        edges = written(_contract(edges), "stars")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
