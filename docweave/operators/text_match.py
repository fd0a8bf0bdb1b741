"""Texts against a small table of headings by TF-IDF cosine, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .entity import written

#: Words that don't count (fixed values).
STOP_WORDS = "a about above after again against all am an and any are as at be because been before being below between both but by can did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its itself just me more most my no nor not now of off on once only or other our out over own same she so some such than that the their them then there these they this those through to too under until up very was we were what when where which while who whom why will with you your".split()


def grams(text: Column, most: int = 3) -> Column:
    """Runs of one to ``most`` words of two letters or digits at least, without stop words, lower-cased."""
    words = F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"\b(\w\w+)\b"), F.lit(1)), lambda w: ~w.isin(*STOP_WORDS))
    runs = [words]
    for n in range(2, most + 1):
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(F.array().cast("array<int>"))
        runs.append(F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " ")))
    return F.concat(*runs)


def heading_similarity(texts: DataFrame, headings: DataFrame, *, text_id: str, text: str, heading_id: str, heading: str, least: float = 0.0, features: int = 1000) -> DataFrame:
    """text, heading and cosine of each pair that shares a feature.

    Features are the headings' most frequent grams (ties by text); weights are counts times ``ln((1 + n) / (1 + df)) + 1`` over the headings,
    each vector of unit length. A text's grams join the headings' by gram, so that only shared ones meet.
    """
    h = headings.select(F.col(heading_id).alias("__h"), F.explode(grams(F.col(heading))).alias("gram")).withColumnRenamed("__h", "heading")
    n = headings.agg(F.count(F.lit(1)).alias("n"))
    stats = h.groupBy("gram").agg(F.count(F.lit(1)).alias("total"), F.count_distinct("heading").alias("df")).orderBy(F.col("total").desc(), "gram").limit(features)
    # a lookup of at most ``features`` rows, used on both sides: worked out once
    idf = written(stats.join(F.broadcast(n)).select("gram", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf")))

    def weighted(rows: DataFrame, key: str) -> DataFrame:
        w = rows.groupBy(key, "gram").agg(F.count(F.lit(1)).alias("tf")).join(F.broadcast(idf), "gram").withColumn("w", F.col("tf") * F.col("idf"))
        return w.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(key)))).select(key, "gram", "w")

    t = weighted(texts.select(F.col(text_id).alias("__t"), F.explode(grams(F.col(text))).alias("gram")).withColumnRenamed("__t", "text"), "text")
    pairs = t.join(written(weighted(h, "heading")).withColumnRenamed("w", "v"), "gram").groupBy("text", "heading").agg(F.sum(F.col("w") * F.col("v")).alias("similarity"))
    return pairs.where(F.col("similarity") >= least)
