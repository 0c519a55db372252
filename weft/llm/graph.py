"""Connected components of an edge table by contraction; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Each round points every node to the smallest of its neighbourhood, follows those pointers
    twice more, and contracts; a path shortens by a factor of at least four."""
    edges = scratch.save(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    maps = []
    while edges.count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = scratch.save(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")).select(F.col("a").alias("node"), "p"), "parent")
        for _ in range(2):
            jump = parent.select(F.col("node").alias("p"), F.col("p").alias("q"))
            parent = scratch.save(parent.join(jump, "p", "left").select("node", F.coalesce("q", "p").alias("p")), "parent")
        maps.append(parent)
        left = parent.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        right = parent.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        moved = edges.join(left, "a").join(right, "b").where("pa <> pb")
        edges = scratch.save(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0].select("node", F.col("p").alias("root"))
    for later in maps[1:]:
        step = later.select(F.col("node").alias("root"), F.col("p").alias("next"))
        out = out.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return out
