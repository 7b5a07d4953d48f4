"""Connected components of a graph held as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest among the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
    larger = both.filter("v > u").join(low, "u")
    return larger.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    rest = edges.join(low, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return rest.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; the root is the smallest node of the component.

    ``edges`` has two comparable columns u and v; loops, repeated and null ends are ignored. Every round is two
    groupings with partial minima and two joins that can be split at a hub; the number of rounds is about the
    square of the logarithm of the longest path at worst. Each round ends in a checkpoint.
    """
    oriented = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = checkpointed(oriented.distinct())
    state = _state(now)
    while state[0]:
        now = checkpointed(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if before == state:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
