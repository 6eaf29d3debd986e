"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clinflow.scratch import materialize


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller node."""
    pair = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return pair.filter(F.col("u") != F.col("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the least of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("least"))
    return _directed(both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return _directed(moved.union(least.select("u", F.col("least").alias("v"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges ``u, v`` (longs); the label is the least node reachable.

    No node's neighbours are gathered in one place: minima are combined before they travel. Each round is written to
    shared storage, so lineage stays short. The number of rounds grows with the logarithm of the longest path.
    """
    current = materialize(_directed(edges), "edges")
    seen = None
    while True:
        state = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("mark")).first()
        if (state["n"], state["mark"]) == seen or not state["n"]:
            break
        seen = (state["n"], state["mark"])
        current = materialize(_small_star(_large_star(current)), "edges")
    members = current.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return members.union(current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
