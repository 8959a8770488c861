"""Connected components of links that are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.shared import stored


def connected(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """`nodes` (node, label) with the smallest label of each node's component.

    Alternates two steps until nothing changes: all larger neighbours of a node are hung
    on its smallest neighbour, then all neighbours that are not larger. Chains shrink by
    a factor each round. Each round is written to the shared folder. Nodes without links
    keep their label; null labels yield to others; links name nodes of `nodes` only.
    """
    edges = stored(links.filter("a <> b").select("a", "b").distinct(), "links")
    while True:
        large = _hang(edges, larger=True)
        small = stored(_hang(large, larger=False), "links")
        before, after = _state(edges), _state(small)
        edges = small
        if before == after:
            break
    # Now every edge leads from a node to the least node of its component.
    roots = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("label").alias("label"))
    return placed.drop("label").join(least, "root").select("node", "label")


def _hang(edges: DataFrame, larger: bool) -> DataFrame:
    one = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    sides = one.union(one.select("v", "u")) if larger else one
    # The least neighbour is combined before the shuffle; large neighbourhoods are split
    # by the adaptive skew join.
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = sides.join(least, "u")
    if larger:
        hung = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hung = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return hung.filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    """Two sums that tell whether a round changed the edges."""
    mixed = F.xxhash64(F.greatest("a", "b"), F.least("a", "b"))
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(mixed.cast("decimal(38,0)")).alias("sum")).first()
    return row["n"], row["sum"]
