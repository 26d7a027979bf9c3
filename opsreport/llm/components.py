"""Connected components by contraction, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsreport.llm.common import written


def chain_ends(parent: DataFrame) -> DataFrame:
    """Follows (x, p) with p < x to the end of each chain, doubling the step each time."""
    while True:
        up = parent.select(F.col("x").alias("p"), F.col("p").alias("top"))
        stepped = written(
            parent.join(up, "p", "left").select(
                "x", F.coalesce("top", "p").alias("p"), F.col("top").isNotNull().alias("moved")
            ),
            "roots",
        )
        parent = stepped.select("x", "p")
        if stepped.where("moved").isEmpty():
            return parent


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b): the least node of its component.

    Each pass hangs every node below its least smaller neighbour, follows the chains to their
    roots and replaces nodes by roots in the edges, until no edge is left. Passes grow with
    the logarithm of the nodes; every pass is written, so a lost executor costs one pass.
    """
    edges = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y"))
        .distinct(),
        "edges",
    )
    labels: DataFrame | None = None
    while not edges.isEmpty():
        roots = chain_ends(written(edges.groupBy("x").agg(F.min("y").alias("p")), "parents"))
        ends = [roots.select(F.col("x").alias(c), F.col("p").alias(f"{c}p")) for c in "xy"]
        left = (
            edges.join(ends[0], "x")
            .join(ends[1], "y", "left")
            .select(F.col("xp").alias("a"), F.coalesce("yp", "y").alias("b"))
            .where("a <> b")
        )
        if labels is None:
            nodes = edges.select(F.col("x").alias("node")).union(edges.select("y")).distinct()
            labels = nodes.withColumn("label", F.col("node"))
        up = roots.select(F.col("x").alias("label"), F.col("p").alias("top"))
        labels = written(
            labels.join(up, "label", "left").select(
                "node", F.coalesce("top", "label").alias("label")
            ),
            "labels",
        )
        edges = written(
            left.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct(),
            "edges",
        )
    if labels is None:
        return edges.select(F.col("x").alias("node"), F.col("y").alias("label"))
    return labels
