"""Source divergence audit: how the sources of a language part in their words, by smoothed shares of terms.

Terms are runs of letters A-Z, lower-cased, and of all characters beyond ASCII. A language keeps the terms that at least
``min_docs`` of its documents hold. Every source of a language, and the language as a whole, gives each kept term a share in
billionths, ``1 + floor(scale * (count + 1) / (N + V))``, N being the counts' sum and V the number of kept terms. What one share
p is away from another, q, is ``floor((p - q)^2 / q)``: summed over all kept terms for two sources (part ``pair``), and term by
term for a source's own words that it has more often than its language (part ``term``, the ``top`` first).

Plain relational: matches exploded, counted by group and term; the kept vocabulary crossed with its language's groups, so that
zeros are rows; joined with itself by term, summed, ranked. Counts are partially aggregated where the texts are, so that a
source with a third of all rows is no hot key; a term has one row a source. The only joins by language are of groups and are dealt out
by salts; ranks to ``top`` are limited before they move. Whole numbers throughout: products beyond 64 bits go through decimals.

Null text, lang and source are empty strings, and an empty string is a lang or source like others. A source without kept terms has
pairs (of value 0 where its language keeps none) and no terms. Repeated rows count each. Ties in value go by the item's UTF-8 bytes. Other columns aren't read,
so they may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

#: What parts terms: every ASCII character that is no letter. The dealt expression's matches are what lies between.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts that a language's terms and groups are dealt into where they are crossed.
SALTS = 64


def terms(text: Column) -> Column:
    """An array of the terms, and at most one empty string at either end. ``lower`` is right, and quicker, where all is ASCII."""
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.split(low, BETWEEN)


def group_ids(docs: DataFrame) -> tuple[DataFrame, Column]:
    """lang, source and a number of every group, and the number as an expression, so that texts need no join for it. Were two groups to share one, another seed is taken."""
    groups = docs.select("lang", "source").distinct()
    for seed in range(8):
        g = F.xxhash64(F.lit(seed), "lang", "source")
        if not groups.groupBy(g.alias("g")).count().where("count > 1").limit(1).count():
            return groups.withColumn("g", g), g
    raise RuntimeError("groups share their numbers under every seed")


def with_share(rows: DataFrame, out: str, count: str, total: str, kept: str, scale: int) -> DataFrame:
    """``1 + floor(scale * (count + 1) / (total + kept))``, exactly: in longs where the product fits them."""
    long = f"{scale}L * (`{count}` + 1) div (`{total}` + `{kept}`)"
    wide = f"cast({scale} as decimal(19,0)) * cast(`{count}` + 1 as decimal(19,0)) div cast(`{total}` + `{kept}` as decimal(19,0))"
    return rows.withColumn(out, F.expr(f"1 + CASE WHEN `{count}` < {2**63 // scale - 1}L THEN {long} ELSE {wide} END"))


AWAY = "(p - q) * (p - q) div q"


def salted(df: DataFrame, by: str | None = None) -> DataFrame:
    """With a column ``salt``: dealt out by ``by``, or once for every salt."""
    return df.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int") if by else F.explode(F.expr(f"sequence(0, {SALTS - 1})")))


def count_terms(docs: DataFrame, g: Column) -> DataFrame:
    """g, term, n (occurrences) and docs (documents that hold it): each text's terms and its distinct ones are exploded, and counted in one go."""
    found = docs.select(g.alias("g"), terms(F.col("text")).alias("all"))
    both = found.select("g", F.posexplode(F.array("all", F.array_distinct("all"))).alias("distinct", "terms"))
    each = both.select("g", "distinct", F.explode("terms").alias("term")).where("term <> ''")
    return each.groupBy("g", "term").agg(F.count_if(F.col("distinct") == 0).alias("n"), F.count_if(F.col("distinct") == 1).alias("docs"))


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 3, scale: int = 1_000_000_000, top: int = 200) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    groups, g = group_ids(docs)
    groups = common.materialize(groups, "groups")

    # A term's rows come together once: there it is kept or not, and gets a number.
    term = W.partitionBy("lang", "term")
    rows = count_terms(docs, g).join(groups.select("g", "lang"), "g").repartition("lang", "term").withColumn("id", F.monotonically_increasing_id())
    rows = rows.withColumns({"held_by": F.sum("docs").over(term), "total": F.sum("n").over(term), "t": F.min("id").over(term)}).where(F.col("held_by") >= min_docs)
    kept = common.materialize(rows.select("t", "g", "n", "lang", "term", "total", (F.col("id") == F.col("t")).alias("once")), "kept")

    own = kept.groupBy("lang", "g").agg(F.sum("n").alias("own"), F.count_if("once").alias("v"))
    whole = own.groupBy("lang").agg(F.sum("own").alias("whole"), F.sum("v").alias("kept"))
    groups = groups.join(own.select("g", "own"), "g", "left").join(whole, "lang", "left").fillna(0, ["own", "whole", "kept"])
    groups = common.materialize(groups, "sizes")
    return pairs(kept, groups, scale).unionByName(leading(kept, groups, scale, top))


def dense(kept: DataFrame, groups: DataFrame, scale: int) -> DataFrame:
    """t, g and p of every kept term and every group of its language. Crossed terms and counts meet as rows of one table, dealt out once by term, as the join after it wants them."""
    zeros = salted(kept.where("once").select("t", "lang"), "t").join(salted(groups.select("lang", "g")), ["lang", "salt"]).select("t", "g", F.lit(0).cast("long").alias("n"))
    counts = kept.select("t", "g", "n").unionByName(zeros).repartition("t").groupBy("t", "g").agg(F.sum("n").alias("n"))
    return with_share(counts.join(groups.select("g", "own", "kept"), "g"), "p", "n", "own", "kept", scale).select("t", "g", "p")


def pairs(kept: DataFrame, groups: DataFrame, scale: int) -> DataFrame:
    p = dense(kept, groups, scale)
    q = p.select("t", F.col("g").alias("h"), F.col("p").alias("q"))
    sums = p.join(q, "t").where("g <> h").groupBy("g", "h").agg(F.expr(f"sum({AWAY})").alias("value"))
    other = groups.select("lang", F.col("g").alias("h"), F.col("source").alias("item"))
    every = salted(groups.select("lang", "source", "g"), "g").join(salted(other), ["lang", "salt"]).where("g <> h")
    ranked = every.join(sums, ["g", "h"], "left").fillna(0, ["value"])
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def leading(kept: DataFrame, groups: DataFrame, scale: int, top: int) -> DataFrame:
    rows = kept.select("g", "n", "total", F.col("term").alias("item")).join(groups, "g")
    rows = with_share(with_share(rows, "p", "n", "own", "kept", scale), "q", "total", "whole", "kept", scale).where("p > q")
    rows = rows.select("lang", "source", F.lit("term").alias("part"), "item", F.expr(AWAY).alias("value"))
    return rows.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))).where(F.col("rank") <= top)
