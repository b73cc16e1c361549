"""Connected components over an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a``, ``b``); the
    root is the smallest node of the component.

    Each level hooks every node to its smallest neighbour (a partial
    aggregate, so a hub costs one row per task), halves the pointer paths
    twice and contracts the edges to the roots.  It ends when no edge is left;
    hooking at least halves the nodes that are not local minima.  Every level
    is written below the shared checkpoint folder.
    """
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "cc-edges")
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = (both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                  .select("node", F.least("node", "m").alias("root")))
        for i in range(2):
            parent = written(parent, "cc-parent")
            up = parent.where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("up"))
            parent = (parent.join(up, "root", "left")
                      .select("node", F.coalesce("up", "root").alias("root")))
        parent = written(parent, "cc-parent")
        levels.append(parent)
        for end in ("a", "b"):
            edges = (edges.join(parent.withColumnRenamed("node", end), end)
                     .drop(end).withColumnRenamed("root", end))
        edges = written(edges.select("a", "b").where("a <> b").distinct(), "cc-edges")
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = levels[0]
    for level in levels[1:]:
        up = level.select(F.col("node").alias("root"), F.col("root").alias("up"))
        out = out.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return out
