"""Connected components of an undirected edge list, by alternating star contraction.

The method of Kiveris et al., "Connected Components in MapReduce and Beyond" (2014):
every round links each node to the least neighbour it knows, first towards larger
neighbours, then towards smaller ones, until the edges form stars.  Rounds grow with
the logarithm of the node count, not with the length of a chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import stage
from .joins import by_shuffle


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(by_shuffle(least), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(by_shuffle(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v")


def _downward(edges: DataFrame) -> DataFrame:
    return (
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _settle(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The staged edges and a fingerprint of their set, taken while they are written."""
    seen = Observation()
    mix = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    watched = edges.observe(seen, F.count(F.lit(1)).alias("n"), mix.alias("mix"))
    staged = stage(watched, "edges")
    return staged, (seen.get["n"], seen.get["mix"])


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node of the edges; a component is named by its least node.

    Each step is a grouped minimum, which combines before the shuffle, and a join
    with it.  Steps are staged: the next one reads their edges twice, and a lost
    executor repeats one step only.
    """
    current, mark = _settle(_downward(edges.select(F.col(u).alias("u"), F.col(v).alias("v"))))
    while True:
        larger = stage(_downward(_large_star(current)), "edges")
        current, after = _settle(_downward(_small_star(larger)))
        if after == mark:
            break
        mark = after
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)
