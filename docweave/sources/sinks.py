"""Writes: append, upsert, update, delete, routed facts, content cache, snapshots."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partitions: int | None = None) -> None:
    (df.repartition(partitions) if partitions else df).write.mode("append").parquet(path)


def upserted(current: DataFrame, changes: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """``current`` with rows of ``changes`` in place of those with their keys; of several changes to a key the last stays: by ``order``, nulls first, and by their place in ``changes`` where that ties or isn't given.

    Rows with a null in their key conflict with none: they are all added. One shuffle on the keys; write the result to a new path and
    swap, as a table must not be read and overwritten at once.
    """
    given = changes.withColumns({"__at": F.monotonically_increasing_id(), "__keyed": ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))})
    last = W.partitionBy(*keys).orderBy(*([F.col(order).desc_nulls_last()] if order else []), F.col("__at").desc())
    changes = given.where("__keyed").withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n").unionByName(given.where("not __keyed"))
    return current.join(changes.select(*keys), keys, "left_anti").unionByName(changes.select(*current.columns))


def updated(current: DataFrame, test: Column, values: Mapping[str, Column]) -> DataFrame:
    """Rows that fit ``test`` get new values; a null test leaves the row."""
    return current.withColumns({c: F.when(test, v).otherwise(F.col(c)) for c, v in values.items()})


def deleted(current: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return current.join(ids.select(key), key, "left_anti")


def export_csv(df: DataFrame, path: str, columns: Mapping[str, str]) -> None:
    """A projection with its own headings, as CSV."""
    df.select(*[F.col(c).alias(h) for h, c in columns.items()]).write.mode("overwrite").option("header", True).csv(path)


def exploded_facts(df: DataFrame, key: str, payload: str, routes: Mapping[int, tuple[str, str]], item: str = "item_no") -> DataFrame:
    """Extraction results (JSON) to a row per fact: key, item, target table and the fact's JSON, by a map from item to (table, list field)."""
    table = F.create_map(*[F.lit(x) for k, (t, _) in routes.items() for x in (k, t)])
    known = df.where(F.col(item).isin(*routes))
    facts = F.coalesce(*[F.when(F.col(item) == k, F.expr(f"try_variant_get(try_parse_json(`{payload}`), '$.{f}', 'array<variant>')")) for k, (_, f) in routes.items()])
    return known.withColumns({"target": table[F.col(item)]}).select(key, item, "target", F.posexplode(facts).alias("fact_no", "__v")).select(key, item, "target", "fact_no", F.to_json("__v").alias("fact"))


def content_cache(files: DataFrame, *, digest: str = "sha256", at: str = "cached_at", size: str = "size", as_of: Column, days: int = 30, most_bytes: int, keep: float = 0.9) -> DataFrame:
    """What stays in a cache: of each digest the newest, none older than ``days``, and if all exceed ``most_bytes`` the newest up to ``keep`` of that.

    The running size is taken by day first, so that no task sees more than a day's files besides a number per day.
    """
    newest = W.partitionBy(digest).orderBy(F.col(at).desc(), F.col(size).desc())
    live = files.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n").where(F.col(at) >= as_of - F.make_dt_interval(days=F.lit(days)))
    live = live.withColumn("__day", F.to_date(at))
    per_day = live.groupBy("__day").agg(F.sum(size).alias("__size"))
    before = per_day.withColumn("__newer", F.coalesce(F.sum("__size").over(W.orderBy(F.col("__day").desc()).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    total = per_day.agg(F.coalesce(F.sum("__size"), F.lit(0)).alias("__total"))
    within = F.sum(size).over(W.partitionBy("__day").orderBy(F.col(at).desc(), digest).rowsBetween(W.unboundedPreceding, 0))
    ranked = live.join(before.select("__day", "__newer"), "__day").withColumn("__sum", F.col("__newer") + within).join(F.broadcast(total))
    return ranked.where((F.col("__total") <= most_bytes) | (F.col("__sum") <= F.lit(int(most_bytes * keep)))).drop("__day", "__newer", "__sum", "__total")


def new_content(rows: DataFrame, known: DataFrame, digest: str = "sha256", at: str | None = None) -> DataFrame:
    """Uploads whose content isn't there yet, one of each: the first by ``at``, else by place. A null digest is always new."""
    first = W.partitionBy(digest).orderBy(*([F.col(at).asc_nulls_last()] if at else []), "__at")
    rows = rows.withColumn("__at", F.monotonically_increasing_id())
    one = rows.where(F.col(digest).isNotNull()).withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
    return one.join(known.select(digest), digest, "left_anti").unionByName(rows.where(F.col(digest).isNull()).select(one.columns)).drop("__at").select(*[c for c in rows.columns if c != "__at"])


def orphans(rows: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """Metadata rows whose file is gone."""
    return rows.join(live.select(key).distinct(), key, "left_anti").select(*rows.columns)


def still_to_do(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a resumed job has left: work whose keys no finished row has; a null key is never finished."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti").select(*work.columns)


def snapshot(spark: SparkSession, df: DataFrame, folder: str, stamp: str) -> str:
    path = f"{folder}/{stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def restored(spark: SparkSession, folder: str, stamp: str | None = None) -> DataFrame:
    """The snapshot of a stamp, else the latest one: stamps sort by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if stamp is None:
        stamps = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
        if not stamps:
            raise FileNotFoundError(f"no snapshot in {folder}")
        stamp = stamps[-1]
    return spark.read.parquet(f"{folder}/{stamp}")


def remove_expired(spark: SparkSession, folder: str, oldest: str) -> list[str]:
    """Delete snapshots whose stamp is before ``oldest``; their stamps."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName() < oldest)
    for stamp in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{stamp}"), True)
    return gone


def expired(snapshots: DataFrame, as_of: Column, days: int = 7, at: str = "created_at") -> DataFrame:
    return snapshots.where(F.col(at) < as_of - F.make_dt_interval(days=F.lit(days)))
