"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.sources.workspace import Workspace


def components(edges: DataFrame, workspace: Workspace, name: str) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); the root is one of the component's nodes.

    Each round maps every node to the smallest among itself and its neighbours, renames the ends of all edges so, and
    drops loops and repeats. Nodes that are no minimum vanish, at least half of those that still have edges; the maps
    compose to the roots. Rounds and maps are written tables, and no step holds a node's neighbours together.
    """
    edges = workspace.store(f"{name}_edges_0", edges.select("a", "b").where("a != b").distinct())
    roots, number = None, 0
    while not edges.isEmpty():
        number += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        step = step.select("node", F.least("node", "near").alias("root"))
        step = workspace.store(f"{name}_step_{number}", step)
        left = step.select(F.col("node").alias("a"), F.col("root").alias("c"))
        right = step.select(F.col("node").alias("b"), F.col("root").alias("d"))
        renamed = edges.join(left, "a").join(right, "b").where("c != d").select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"))
        edges = workspace.store(f"{name}_edges_{number}", renamed.distinct())
        if roots is None:
            roots = step
        else:
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("onward"))
            roots = workspace.store(f"{name}_roots_{number}", roots.join(onward, "root", "left").select("node", F.coalesce("onward", "root").alias("root")))
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
