"""Connected components of a graph too large for one machine.

Alternating large-star and small-star steps: each step sends every node the
smallest neighbour it knows, so components shrink to stars in a number of
rounds that grows with the logarithm of their size, and no task holds more than
one node's neighbours at a time, aggregated. Each round is written to the
shared folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import written

MAX_ROUNDS = 60


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (a, b) pairs: neighbours are linked to the smallest node of the neighbourhood."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    linked = both.join(least, "a")
    if large:
        moved = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = linked.select(F.col("a"), F.col("m").alias("b"))
        moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, component) of every node in ``edges`` (columns a, b of one ordered type, no NULL).

    The component is its smallest node. Loops and repeated edges are allowed;
    nodes without edges do not appear.
    """
    current = written(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        current = written(_stars(_stars(current, True), False), "edges")
        state = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before == state:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
