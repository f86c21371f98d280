"""Connected components of an edge table by repeated contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.spread import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges(a, b)``: the label is one node of its component.

    Each round points every node at its smallest neighbour (or itself), replaces
    both ends of every edge by those pointers and drops loops and repeats. Node
    names should be hashes: their order is then random and a constant share of
    the nodes disappears each round, on chains too. Minima are pre-aggregated
    before the shuffle; edges, pointers and labels are checkpointed each round,
    so a lost executor costs one round at most and skewed joins can be split.
    An edge table without rows gives no nodes.
    """
    left = cut(edges.where("a <> b").select("a", "b").distinct())
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("to")))
        if labels is None:
            labels = point.select("node", F.col("to").alias("label"))
        else:
            step = point.select(F.col("node").alias("label"), "to")
            labels = cut(labels.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label")))
        ends = left
        for c in ("a", "b"):
            ends = ends.join(point.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")), c)
        ends = ends.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).where("a <> b")
        left = cut(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if labels is None:
        labels = left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
