"""Joins beyond equality: first match by substring, fuzzy names, nearest vectors, token overlap, staged resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import jaccard
from . import vector_index
from .names import fuzzy_names  # noqa: F401  one of the joins

#: Rows at most of a side that is sent to every executor; a larger one is taken in parts of about so many.
SMALL_ROWS = 50_000


def parts(df: DataFrame) -> list[DataFrame]:
    """``df`` in parts small enough to be broadcast, rows dealt out by hash: one part where all of it is. For joins that no equality serves, one pass over the other side a part."""
    n = -(-df.count() // SMALL_ROWS) or 1
    if n == 1:
        return [F.broadcast(df)]
    part = F.pmod(F.xxhash64(*df.columns), F.lit(n))
    return [F.broadcast(df.where(part == i)) for i in range(n)]


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def first_substring_match(rows: DataFrame, key: Column, candidates: DataFrame, name: str, number: str, position: str, row_id: str) -> DataFrame:
    """For each row the first candidate, by position, whose name is part of ``key`` (any case) or whose number is; empty ones match nothing.

    Candidates are a lookup table, broadcast in ``parts``. Rows without a match stay with nulls.
    """
    k = F.lower(key)
    test = ((F.col(name) != "") & k.contains(F.lower(F.col(name)))) | ((F.col(number).cast("string") != "") & key.contains(F.col(number).cast("string")))
    hits = union([rows.join(c, test, "inner").select(row_id, *candidates.columns) for c in parts(candidates)]).groupBy(row_id).agg(F.min_by(F.struct(*candidates.columns), position).alias("__m"))
    return rows.join(hits, row_id, "left").select(*rows.columns, *[F.col("__m")[c].alias(c) for c in candidates.columns if c not in rows.columns])


def nearest_vectors(queries: DataFrame, base: DataFrame, *, query_id: str, base_id: str, vector: str, k: int = 10, threshold: float | None = None) -> DataFrame:
    """query, base id, similarity and rank of the ``k`` nearest by cosine, as if all rows were compared; ties by base id. By an index of cells built for the call; ``vector_index`` keeps one for many."""
    index = vector_index.build(base, base_id=base_id, vector=vector, copies=k)
    return vector_index.nearest(index, queries, query_id=query_id, vector=vector, k=k, threshold=threshold)[0]


def token_overlap(left: DataFrame, right: DataFrame, *, left_id: str, right_id: str, left_text: str, right_text: str, threshold: float = 0.5) -> DataFrame:
    """Pairs whose words' Jaccard reaches the threshold, found through shared words: of a text's words, in order of
    rarity, one of the first ``n - ceil(t n) + 1`` is shared by any such pair, so only these are joined.
    """
    words = lambda df, i, t: df.select(F.col(i).alias("id"), F.explode(F.array_distinct(F.filter(F.split(F.lower(F.col(t)), r"\s+"), lambda w: w != ""))).alias("word"))
    lw, rw = words(left, left_id, left_text), words(right, right_id, right_text)
    rarity = lw.unionByName(rw).groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    def prefix(w: DataFrame) -> DataFrame:
        ranked = w.join(rarity, "word").withColumns({"r": F.row_number().over(W.partitionBy("id").orderBy("n", "word")), "size": F.count(F.lit(1)).over(W.partitionBy("id"))})
        return ranked.where(F.col("r") <= F.col("size") - F.ceil(F.col("size") * threshold) + 1).select("id", "word")

    pairs = prefix(lw).withColumnRenamed("id", "left").join(prefix(rw).withColumnRenamed("id", "right"), "word").select("left", "right").distinct()
    full = pairs.join(left.select(F.col(left_id).alias("left"), F.col(left_text).alias("__l")), "left").join(right.select(F.col(right_id).alias("right"), F.col(right_text).alias("__r")), "right")
    return full.withColumn("similarity", jaccard("__l", "__r")).where(F.col("similarity") >= threshold).select("left", "right", "similarity")


def ranked_matches(pairs: DataFrame, by: str = "name", limit: int = 10) -> DataFrame:
    """By the score in three digits, then the candidate's name; the first ``limit`` of each."""
    order = W.partitionBy(by).orderBy(F.round("similarity", 3).desc(), "candidate")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def resolve(names: DataFrame, known: DataFrame, matches: DataFrame, *, name: str = "name", known_name: str = "canonical_name", known_id: str = "id", accept: float = 0.95) -> DataFrame:
    """Exact, else the best fuzzy match at ``accept`` or more, else a new entity: name, id (null if new), resolution."""
    exact = names.join(known.select(F.col(known_name).alias(name), F.col(known_id).alias("__exact")).dropDuplicates([name]), name, "left")
    best = matches.groupBy("name").agg(F.max_by(F.struct("candidate", "similarity"), F.struct("similarity", "candidate")).alias("b")).where(F.col("b.similarity") >= accept)
    best = best.join(known.select(F.col(known_name).alias("__c"), F.col(known_id).alias("__fuzzy")), F.col("b.candidate") == F.col("__c")).groupBy(F.col("name").alias(name)).agg(F.min("__fuzzy").alias("__fuzzy"))
    out = exact.join(best, name, "left")
    return out.select(name, F.coalesce("__exact", "__fuzzy").alias("id"), F.when(F.col("__exact").isNotNull(), "exact").when(F.col("__fuzzy").isNotNull(), "fuzzy").otherwise("new").alias("resolution"))


def match_verdict(similarity: Column | str, accept: float = 0.94, review: float = 0.85) -> Column:
    s = F.col(similarity) if isinstance(similarity, str) else similarity
    return F.when(s > accept, "accept").when(s > review, "review").otherwise("new")


def duplicates_by_hash(rows: DataFrame, known: DataFrame, *, digest: str, scope: str, known_id: str) -> DataFrame:
    """The known id of the same digest within the same scope, else of any; null if there is none. The smallest id stands for many."""
    own = known.groupBy(scope, digest).agg(F.min(known_id).alias("__own"))
    any_ = known.groupBy(digest).agg(F.min(known_id).alias("__any"))
    return rows.join(own, [scope, digest], "left").join(any_, digest, "left").withColumn("duplicate_of", F.coalesce("__own", "__any")).drop("__own", "__any")
