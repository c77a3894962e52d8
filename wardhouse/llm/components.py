"""Connected components of an edge table by alternating stars; nodes never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardhouse.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.union(edges.select("b", "a")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return both.join(least, "node").where("other > node").select(F.col("least").alias("a"), F.col("other").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node itself, are tied to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    moved = edges.join(least, "b").where("a > least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("least").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a < b): label is the component's least node.

    Each round writes its edges, so a lost executor repeats one round at most. It ends when a round changes nothing,
    after a number of rounds that grows with the logarithm of the nodes.
    """
    state = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    current = cut(edges.select("a", "b"))
    before = state(current)
    while before[0]:
        current = cut(_small_star(_large_star(current)))
        after = state(current)
        if after == before:
            break
        before = after
    nodes = current.select(F.col("b").alias("node"), F.col("a").alias("label"))
    return nodes.union(current.select("a", "a").distinct())
