"""Connected components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sift.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of `edges` (a, b), the smallest node naming it.

    Each round every node hooks onto its smallest neighbour if that is
    smaller, the trees that this makes are flattened by pointer jumping, and
    the edges move to the roots. Two neighbours cannot both stay roots, so at
    least half of the nodes that still have edges go in each round. Only
    staged tables are joined, so adaptive execution can split the partition
    of a node with very many neighbours; minima are combined before the
    shuffle. Loops, repeated edges and null ends add nothing.
    """
    label = None
    edges = stage(
        edges.filter("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:
        both = edges.union(edges.select("b", "a"))
        roots = flatten(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min("b").alias("least"))
            .select("node", F.least("node", "least").alias("root"))
        )
        if label is None:
            label = roots.withColumnRenamed("root", "component")
        else:
            moved = roots.select(F.col("node").alias("component"), "root")
            label = stage(
                label.join(moved, "component", "left").select(
                    "node", F.coalesce("root", "component").alias("component")
                ),
                "labels",
            )
        a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stage(
            edges.join(a, "a").join(b, "b").filter("ra != rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            "edges",
        )
        if edges.isEmpty():
            return label


def flatten(hooks: DataFrame) -> DataFrame:
    """Replace each node's parent by its tree's root, doubling the reach per step."""
    hooks = stage(hooks, "roots")
    while True:
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
        deep = hooks.join(up, "root").filter("up != root")
        if deep.isEmpty():
            return hooks
        hooks = stage(hooks.join(up, "root").select("node", F.col("up").alias("root")), "roots")
