"""Connected components of an edge table, by labels that are written in each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.operators.materialize import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the smallest node that it is connected with.

    Each round gives a node the smallest label among its own, its neighbours' and its label's label. Rounds grow with
    the logarithm of a component's length, not with its size. Nodes without an edge don't appear. No rows, no result.
    """
    both = edges.where("a <> b").select("a", "b")
    both = stage(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels"
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
        best = near.agg(F.min("label").alias("near")).join(labels, "node")
        best = best.select("node", F.least("near", "label").alias("next"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = stage(
            best.join(jump, "next").select("node", F.least("next", "far").alias("label"), "old"), "labels"
        )
        labels = step.select("node", "label")
        if step.where("label <> old").isEmpty():
            return labels
