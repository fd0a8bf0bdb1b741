"""Names that are alike: all pairs at or over a threshold of ``udfs.similarity``, by joins on keys that every such pair shares.

The similarity is 1 for equal normalised names, 0.95 where one is within the other, else the larger of the sequence ratio and
0.9 times the words' overlap. Each part has a key of its own:

* ratio: with ``m`` matched characters it is 2m / (la + lb), so a pair at ``t`` differs by at most (1 - t)(la + lb) insertions and
  deletions, and its lengths by a factor of (2 - t) / t at most. A name cut into one segment more than that holds one
  unharmed, and it stands in the other name no further from its place than insertions before it, or deletions, can move it.
* words: of names that share at least ``t / 0.9`` of the longer one's words, one of the rarest few is shared.
* within: the contained name's rarest run of three characters is one of the other's runs.

Keys are hashed; what they bring together by chance fails the comparison that follows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.udfs import name_similarity, normalised
from ..session import runs_on_executors
from .entity import written

runs_on_executors(__name__)

_EPS = 1e-9


def lengths_near(n: int, t: float) -> range:
    """The lengths of names whose ratio with one of length ``n`` can reach ``t``."""
    return range(math.ceil(n * t / (2 - t) - _EPS), math.floor(n * (2 - t) / t + _EPS) + 1)


def most_changes(one: int, two: int, t: float) -> int:
    return math.floor((1 - t) * (one + two) + _EPS)


def segments(n: int, parts: int) -> list[tuple[int, int]]:
    return [(n * i // parts, n * (i + 1) // parts) for i in range(parts)]


def _key(*parts) -> int:
    return zlib.crc32("|".join(map(str, parts)).encode("utf-8", "surrogatepass"))


def segment_keys(name: str, t: float) -> list[int]:
    """For each length that the other name may have, the segments of this one."""
    n = len(name)
    return list({_key(m, n, i, name[a:b]) for m in lengths_near(n, t) for i, (a, b) in enumerate(segments(n, most_changes(m, n, t) + 1))})


def window_keys(name: str, t: float) -> list[int]:
    """For each length that the other name may have, where its segments can stand in this one."""
    m, out = len(name), set()
    for n in lengths_near(m, t):
        d = most_changes(m, n, t)
        for i, (a, b) in enumerate(segments(n, d + 1)):
            for p in range(max(0, a - (d - m + n) // 2), min(m - (b - a), a + (d + m - n) // 2) + 1):
                out.add(_key(m, n, i, name[p : p + b - a]))
    return list(out)


def _keys(make):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for names, t in batches:
            yield pd.Series([None if x is None else make(x, y) for x, y in zip(names, t)])

    return keys


@F.pandas_udf(T.StringType())
def normalised_name(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda x: None if x is None else normalised(x))


def _runs(norm: str, *sizes: int):
    one = lambda q: F.when(F.length(norm) >= q, F.transform(F.sequence(F.lit(1), F.length(norm) - q + 1), lambda i: F.substring(norm, i, F.lit(q)))).otherwise(F.expr("cast(array() as array<string>)"))
    return F.array_distinct(F.concat(*[one(q) for q in sizes]))


def _within(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """Pairs of an ``inner`` and an ``outer`` norm by the inner one's rarest run."""
    there = outer.select(F.col("norm").alias("outer"), F.explode(_runs("norm", 1, 2, 3)).alias("run"))
    counts = there.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    mine = inner.select("norm", F.explode(F.when(F.length("norm") > 2, _runs("norm", 3)).otherwise(F.array("norm"))).alias("run")).join(counts, "run")
    rarest = mine.groupBy("norm").agg(F.min_by("run", F.struct("n", "run")).alias("run"), F.count(F.lit(1)).alias("found"))
    # a run that the other side lacks rules the name out
    rarest = rarest.where(F.col("found") == F.size(F.when(F.length("norm") > 2, _runs("norm", 3)).otherwise(F.array("norm"))))
    return rarest.select(F.col("norm").alias("inner"), "run").join(there, "run").where(F.col("outer").contains(F.col("inner"))).select("inner", "outer")


def _by_words(left: DataFrame, right: DataFrame, share: float) -> DataFrame:
    words = lambda df: df.select("norm", F.explode(F.array_distinct(F.filter(F.split("norm", " "), lambda w: w != ""))).alias("word"))
    lw, rw = words(left), words(right)
    rarity = lw.unionByName(rw).groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    def rarest(w: DataFrame) -> DataFrame:
        ranked = w.join(rarity, "word").withColumns({"r": F.row_number().over(W.partitionBy("norm").orderBy("n", "word")), "size": F.count(F.lit(1)).over(W.partitionBy("norm"))})
        return ranked.where(F.col("r") <= F.col("size") - F.ceil(F.col("size") * share - _EPS) + 1).select("norm", "word")

    return rarest(lw).withColumnRenamed("norm", "a").join(rarest(rw).withColumnRenamed("norm", "b"), "word").select("a", "b")


def fuzzy_names(names: DataFrame, candidates: DataFrame, *, name: str, candidate: str, threshold: float = 0.85) -> DataFrame:
    """name, candidate, similarity: all pairs of distinct names at or over the threshold, which is above zero. Null names match nothing; empty ones are equal to one another."""
    side = lambda df, c, out: written(df.select(F.col(c).alias(out)).where(F.col(c).isNotNull()).distinct().withColumn("norm", normalised_name(out)))
    left, right = side(names, name, "name"), side(candidates, candidate, "candidate")
    ln, rn = left.select("norm").distinct(), right.select("norm").distinct()
    t = F.lit(float(threshold))
    by_segment = ln.select(F.col("norm").alias("a"), F.explode(_keys(window_keys)("norm", t)).alias("key")).join(rn.select(F.col("norm").alias("b"), F.explode(_keys(segment_keys)("norm", t)).alias("key")), "key").select("a", "b")
    pairs = [by_segment]
    if threshold <= 0.95:
        full = [x.where("norm <> ''") for x in (ln, rn)]
        pairs += [_within(full[0], full[1]).select(F.col("inner").alias("a"), F.col("outer").alias("b")), _within(full[1], full[0]).select(F.col("outer").alias("a"), F.col("inner").alias("b"))]
    if threshold <= 0.9:
        pairs.append(_by_words(ln, rn, threshold / 0.9))
    found = pairs[0]
    for p in pairs[1:]:
        found = found.unionByName(p)
    # the similarity is that of the normalised names
    alike = found.distinct().withColumn("similarity", name_similarity("a", "b")).where(F.col("similarity") >= threshold)
    return alike.join(left.withColumnRenamed("norm", "a"), "a").join(right.withColumnRenamed("norm", "b"), "b").select("name", "candidate", "similarity")
