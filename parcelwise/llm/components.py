"""Connected components over an edge table of any size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the smallest node names the component.

    Rounds of contraction: every node points to its best neighbour (or stays), edges are
    rewritten to the nodes pointed to, and inner edges vanish. "Best" is the smallest id in
    the first round, which finishes stars at once, and the smallest salted hash afterwards,
    which shrinks any chain by a constant factor a round. A hub of any degree is combined
    map-side in the minimum; the joins read stored tables on both sides, so that AQE can
    split a hot key. NULL ends and self-loops are no edges. Without edges the result is empty.
    """
    ends = edges.select("a", "b").where("a <> b")
    edge = store(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps: list[DataFrame] = []
    while not edge.isEmpty():
        salt = len(steps)

        def rank(c, salt=salt):
            return F.struct(F.xxhash64(F.lit(salt), c) if salt else F.lit(0), F.col(c))

        both = edge.union(edge.select("b", "a"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        parent = store(
            best.select(F.col("a").alias("node"), F.when(F.col("m") < rank("a"), F.col("m")["b"]).otherwise(F.col("a")).alias("parent")), "parents"
        )
        left = parent.select(F.col("node").alias("a"), F.col("parent").alias("x"))
        right = parent.select(F.col("node").alias("b"), F.col("parent").alias("y"))
        moved = edge.join(left, "a").join(right, "b").where("x <> y")
        edge = store(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        steps.append(parent)
    if not steps:
        return edge.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = steps[0]
    for step in steps[1:]:
        to = step.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        labels = labels.join(to, "parent", "left").select("node", F.coalesce("next", "parent").alias("parent"))
    labels = store(labels, "labels")
    low = store(labels.groupBy("parent").agg(F.min("node").alias("component")), "lowest")
    return labels.join(low, "parent").select("node", "component")


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The fewest edges with the same components as the links ``a - b``: members and their smallest member."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]
