"""Connected components of any size: hook every node to its smallest neighbour, jump, contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """node, comp (the smallest node reachable) for the nodes of ``edges`` (a, b).

    Every round contracts the components found so far to one node, so the edges shrink
    quickly; a node of any degree is reduced by a partial minimum before it is shuffled.
    """
    edges = ws.keep(edges.where("a <> b").select("a", "b").distinct(), "edges", like=edges)
    found = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = ws.keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                       .select("node", F.least("node", "low").alias("up")), "hooks", like=both)
        for _ in range(2):
            above = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hook = ws.keep(hook.join(above, "up").select("node", F.col("top").alias("up")), "jumps", like=hook)
        if found is None:
            found = hook.select("node", F.col("up").alias("comp"))
        else:
            moved = hook.select(F.col("node").alias("comp"), "up")
            found = ws.keep(found.join(moved, "comp", "left").select(
                "node", F.coalesce("up", "comp").alias("comp")), "found", like=found)
        before = edges
        for end in ("a", "b"):
            step = hook.select(F.col("node").alias(end), F.col("up").alias("to"))
            other = "b" if end == "a" else "a"
            edges = edges.join(step, end).select(F.col("to").alias(end), other)
        edges = ws.keep(edges.where("a <> b").distinct(), "edges", like=before)
    if found is None:
        return ws.spark.createDataFrame([], "node long, comp long")
    return found
