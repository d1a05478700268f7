"""Connected components of a link table, in a bounded number of Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import stash

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """Columns node, component (its smallest reachable node) for the nodes of `links(src, dst)` that reach a smaller one.

    Alternates two star steps on the links until they no longer change: every node's larger neighbours move to its smallest
    neighbour, then every node's smaller neighbours do. Both are group minima and a join, combine before their shuffle, and
    need a number of rounds that grows with the logarithm of the longest chain. Only row counts reach the driver.
    """
    edges = stash(links.filter("src != dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = stash(_small_star(_large_star(edges)))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = now
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours, and itself, to its smallest neighbour or itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node's smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
