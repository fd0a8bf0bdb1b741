"""Duplicate clusters of entities and their merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def written(df: DataFrame) -> DataFrame:
    """``df`` written once in the shared folder and read again: lineage ends here, and lost executors cost nothing before it."""
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clusters(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``node, root`` of every node with an edge: the smallest node it reaches.

    Each round points a node at its neighbours' smallest root and then at that root's root, so that distances halve.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other"))).where("node <> other").distinct()
    both = written(both)
    roots = written(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("root")))
    for _ in range(max_rounds):
        seen = both.join(roots.select(F.col("node").alias("other"), F.col("root").alias("r")), "other").groupBy("node").agg(F.min("r").alias("r"))
        step = roots.join(seen, "node").select("node", F.least("root", "r").alias("root"), F.col("root").alias("old"))
        jump = step.join(step.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left").select("node", F.least("root", F.coalesce("up", "root")).alias("root"), "old")
        jump = written(jump)
        if not jump.where("root <> old").limit(1).count():
            return jump.select("node", "root")
        roots = jump.select("node", "root")
    raise RuntimeError("clusters have not settled")


def merge_entities(entities: DataFrame, edges: DataFrame, *, key: str = "id", name: str = "canonical_name", aliases: str = "dba_names", fill: tuple[str, ...] = ()) -> DataFrame:
    """One row per cluster, that of the smallest id: aliases of all and the others' names joined and sorted, ``fill`` columns from the first that has one."""
    roots = clusters(edges).select(F.col("node").alias(key), "root")
    rooted = entities.join(roots, key, "left").withColumn("root", F.coalesce("root", key))
    own = F.col(key) == F.col("root")
    filled = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(key))).alias(c) for c in fill]
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.concat(F.coalesce(aliases, F.array()), F.when(own, F.expr("cast(array() as array<string>)")).otherwise(F.array(name)))))))
    return rooted.groupBy(F.col("root").alias(key)).agg(F.max(F.when(own, F.col(name))).alias(name), names.alias(aliases), *filled)


def repointed(rows: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """Foreign keys moved to the clusters' roots."""
    return rows.join(roots.select(F.col("node").alias(key), F.col("root").alias("__root")), key, "left").withColumn(key, F.coalesce("__root", key)).drop("__root")


def merge_confidence(best: str = "best", second: str = "second"):
    """``high`` for a best match of at least 0.95 that leads by over 0.1, ``low`` where a second one reaches 0.9, else ``medium``."""
    b, s = F.col(best), F.coalesce(F.col(second), F.lit(0.0))
    return F.when((b >= 0.95) & (b - s > 0.1), "high").when((b >= 0.9) & (s >= 0.9), "low").otherwise("medium")
