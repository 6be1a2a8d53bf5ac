"""Connected components: of an edge table by contraction, and of arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import kept_table


def spanning_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the same components: from every node to the smallest node
    of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            other = label != np.arange(len(nodes))
            return nodes[other], nodes[label[other]]
        label = new


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, label), the label being the smallest node of
    the component. Each round points every node to its smallest neighbour (and
    on to that one's), and contracts the edges, which shrink geometrically; a
    hub with many edges is reduced on the map side. Rounds are written tables,
    so a lost executor repeats one round at most."""
    left = kept_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "components-edges")
    labels = kept_table(left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
                        .withColumn("label", F.col("node")), "components-labels")
    while not left.isEmpty():
        # b is the smaller end: every a has somewhere lower to go
        up = kept_table(left.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")), "components-up")
        on = up.select(F.col("node").alias("up"), F.col("up").alias("on"))
        up = kept_table(up.join(on, "up", "left").select("node", F.coalesce("on", "up").alias("up")), "components-up")
        labels = kept_table(
            labels.join(up.select(F.col("node").alias("label"), "up"), "label", "left")
            .select("node", F.coalesce("up", "label").alias("label")), "components-labels")
        left = (left.join(up.select(F.col("node").alias("a"), F.col("up").alias("a2")), "a")
                .join(up.select(F.col("node").alias("b"), F.col("up").alias("b2")), "b", "left")
                .select(F.col("a2").alias("x"), F.coalesce("b2", "b").alias("y")).where("x <> y")
                .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
        left = kept_table(left, "components-edges")
    return labels
