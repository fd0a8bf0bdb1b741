"""URL rules by a Bloom filter cascade, with DataFrame functions only.

A rule's key is its host and path prefix run together. A URL's candidate keys are its host's last labels with its path's
first characters, for the shapes (labels, characters) that rules have. Over the corpus's complete universe of candidate keys a
cascade of Bloom filters is built: the first level encodes the listed keys; the second those keys of the universe that
the first lets through though they aren't listed; the third the listed keys that the second lets through; and so on until
nothing wrong is left. A key of the universe is listed if the first level that turns it away is an even one. So membership is
exact, and a URL is judged within its row, without a join.

Filters are constants in the plan, sized by the listed keys (the first level's error rate is their share of the universe); rule
tables beyond ``max_keys`` are looked up by an exact hash join instead, with the same result.

Null URLs and those without ``://`` have an empty host and path and fit no rule. The longest key that fits wins, of
equally long ones that with more labels in its host; of rules with the same key the block stands. Rules with a null host or path don't count.
Repeated pages are judged each. Without rules every page is allowed; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str  # block or allow
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Level:
    words: str  # JSON array of 64-bit words
    bits: int
    probes: int
    salt: int

    def holds(self, key: Column) -> Column:
        table = F.expr(f"from_json('{self.words}', 'array<bigint>')")
        out = None
        for i in range(self.probes):
            at = F.pmod(F.xxhash64(key, F.lit(self.salt), F.lit(i)), F.lit(self.bits))
            word = F.get(table, F.floor(at / 64).cast("int"))
            hit = word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))) != 0
            out = hit if out is None else out & hit
        return out


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Exact for keys of the universe that the cascade was built over. A null key is not listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[i].holds(key), out).otherwise(F.lit(i % 2 == 1))
        return key.isNotNull() & out


def _level(keys: DataFrame, n: int, error: float, salt: int) -> Level:
    """A Bloom filter of ``keys`` (column key). Bits are set by an aggregate; only its words, whose number follows ``n``, reach the driver."""
    bits = max(64, math.ceil(n * -math.log(error) / math.log(2) ** 2 / 64) * 64)
    probes = max(1, min(16, round(-math.log2(error))))
    at = F.explode(F.array(*[F.pmod(F.xxhash64("key", F.lit(salt), F.lit(i)), F.lit(bits)) for i in range(probes)])).alias("at")
    rows = keys.select(at).groupBy(F.floor(F.col("at") / 64).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(64)).cast("int"))).alias("v")).collect()
    words = [0] * (bits // 64)
    for r in rows:
        words[r["w"]] = r["v"]
    return Level(str(words).replace(" ", ""), bits, probes, salt)


def build_cascade(listed: DataFrame, universe: DataFrame, *, max_levels: int = 64) -> Cascade:
    """``listed`` and ``universe``: distinct keys (column key). Levels alternate between listed keys and false positives."""
    n, size = listed.count(), universe.count()
    if not n:
        return Cascade(())
    others = universe.join(F.broadcast(listed) if n <= 10_000 else listed, "key", "left_anti")
    error = min(0.5, max(n * math.sqrt(0.5) / max(size, 1), 1e-9))
    levels: list[Level] = []
    inside, outside = listed, others
    for salt in range(max_levels):
        level = _level(inside, n, error, salt)
        levels.append(level)
        wrong = common.materialize(outside.where(level.holds(F.col("key"))), "let-through")
        n = wrong.count()
        if not n:
            return Cascade(tuple(levels))
        inside, outside, error = wrong, inside, 0.5
    raise RuntimeError("the cascade has not settled")


def candidates(pages: DataFrame, shapes: Sequence[tuple[int, int]], host: str = "host", path: str = "path") -> list[Column]:
    """A candidate key for each shape, null where the URL is too short for it."""
    return [F.when(F.length(F.col(path)) >= n, F.concat(F.substring_index(F.col(host), ".", -labels), F.substring(F.col(path), 1, n))) for labels, n in shapes]


def judge_urls(pages: DataFrame, rules: Sequence[Rule] | DataFrame, *, url: str = "url", max_keys: int = 100_000) -> DataFrame:
    """``pages`` with host, path, rule (the key that decides, else null) and verdict (its action, else allow); columns of these names are replaced."""
    spark: SparkSession = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r.action, r.host, r.path) for r in rules], "action string, host string, path string")
    rules = rules.where("action in ('block', 'allow') and host is not null and path is not null and host <> ''").select("action", F.translate("host", UPPER, LOWER).alias("host"), "path")
    rules = rules.select(F.concat("host", "path").alias("key"), "action", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")).distinct()
    shapes = sorted(((r["labels"], r["chars"]) for r in rules.select("labels", "chars").distinct().collect()), key=lambda s: (-s[0], -s[1]))
    judged = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if not shapes:
        return judged.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    keys = rules.groupBy("key").agg(F.max("action").alias("action"))  # block comes after allow
    n = keys.count()
    candidate = F.array_compact(F.array(*candidates(judged, shapes)))
    if n > max_keys:
        return _by_join(judged, keys, candidate)
    universe = common.materialize(judged.select("host", "path").distinct().select(F.explode(candidate).alias("key")).distinct(), "universe")
    cascades = {a: build_cascade(keys.where(F.col("action") == a).select("key"), universe) for a in ("block", "allow")}
    fits = F.filter(candidate, lambda k: cascades["block"].listed(k) | cascades["allow"].listed(k))
    longest = F.reduce(fits, F.lit(None).cast("string"), lambda best, k: F.when(best.isNull() | (F.length(k) > F.length(best)), k).otherwise(best))
    judged = judged.withColumn("rule", longest)
    return judged.withColumn("verdict", F.when(cascades["block"].listed(F.col("rule")), F.lit("block")).otherwise(F.lit("allow")))


def _by_join(judged: DataFrame, keys: DataFrame, candidate: Column) -> DataFrame:
    """For rule tables too large for constants: distinct URLs' keys are joined to the rules."""
    hits = judged.select("host", "path").distinct().select("host", "path", F.explode(candidate).alias("key")).join(keys, "key")
    labels = F.size(F.split(F.substring_index("key", "/", 1), r"\."))
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("key").alias("n"), labels.alias("l"), "key", "action")).alias("b")).select("host", "path", F.col("b.key").alias("rule"), F.col("b.action").alias("verdict"))
    return judged.drop("rule", "verdict").join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
