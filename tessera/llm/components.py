"""Connected components over an edge table, by Spark joins.

State: rows ``(node, parent)`` with parent < node. Each round takes every
node's smallest parent and hooks its other parents onto that one. When every
node has one parent, the forest is flattened by pointer jumping. Each round is
written to the shared folder, so a lost executor repeats one round at most.
Aggregates combine on the map side, and no round brings a node's edges together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``a, b`` (long) rows -> ``node, root``: the smallest node that each node
    with an edge reaches. Loops, repeated and null edges are ignored."""
    state = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("parent"))
                .distinct(), "cc")
    for _ in range(max_rounds):
        low = state.groupBy("node").agg(F.min("parent").alias("low"), F.count(F.lit(1)).alias("n"))
        if low.where("n > 1").limit(1).count() == 0:
            break
        joined = state.join(low, "node")
        hooked = joined.where(F.col("parent") > F.col("low")).select(F.col("parent").alias("node"), F.col("low").alias("parent"))
        state = cut(low.select("node", F.col("low").alias("parent")).unionByName(hooked).distinct(), "cc")
    else:
        raise RuntimeError("components did not settle")
    for _ in range(max_rounds):
        up = state.select(F.col("node").alias("parent"), F.col("parent").alias("upper"))
        new = cut(state.join(up, "parent", "left")
                  .select("node", "parent", F.coalesce("upper", "parent").alias("next")), "cc")
        moved = new.where("next <> parent").limit(1).count()
        state = new.select("node", F.col("next").alias("parent"))
        if not moved:
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = state.select("node", F.col("parent").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
