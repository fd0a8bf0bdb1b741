"""Connected components by alternating large-star and small-star rounds over an edge table; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``node, root``: each node that has an edge, with the smallest node it can reach. Self-loops and repeated edges don't count.

    A round joins each node's neighbours to the smallest one known; the number of rounds grows with the logarithm of the
    longest path. Every round is written to the shared folder, so that a lost executor costs one round at most.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now = common.materialize(now, "edges")
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node goes to the smallest of the node and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every smaller neighbour, and the node itself, goes to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        after = common.materialize(small, "edges")
        changed = after.join(now, ["u", "v"], "left_anti").limit(1).count() + now.join(after, ["u", "v"], "left_anti").limit(1).count()
        now = after
        if not changed:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError("components have not settled")
