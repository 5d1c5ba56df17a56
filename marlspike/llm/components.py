"""Connected components by repeated contraction; no list of neighbours is built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of edges (a, b); label is a node of its component.

    Each round points every node at the smallest of itself and its neighbours
    and replaces the ends of all edges by what they point at, until no edge is
    left; the pointers of the rounds, one after the other, give the label. A
    node's edges are only ever reduced by a minimum, so hubs are harmless.
    """
    edges = materialize(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = materialize(
            both.groupBy("a").agg(F.min("b").alias("low")).select(
                F.col("a").alias("node"), F.least("a", "low").alias("to")
            ),
            "points",
        )
        if labels is None:
            labels = points.select("node", F.col("to").alias("label"))
        else:
            step = points.select(F.col("node").alias("label"), "to")
            labels = materialize(
                labels.join(step, "label", "left").select(
                    "node", F.coalesce("to", "label").alias("label")
                ),
                "labels",
            )
        left = points.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = points.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = materialize(
            edges.join(left, "a").join(right, "b").filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
