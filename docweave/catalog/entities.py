"""Resolution, similarity and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import entity as E
from ..operators import joins as J
from .base import query


@query("j8_nearest_vectors", """
WITH q AS (SELECT vec_id AS query, embedding AS e FROM embeddings WHERE vec_id % 20 = 0),
p AS (SELECT q.query, b.vec_id AS base, list_cosine_similarity(CAST(q.e AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM q, embeddings b),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY s DESC, base) AS k FROM p)
SELECT query, base, CAST(k AS INT) AS rank FROM r WHERE k <= 5""")
def nearest_vectors(t):
    e = t.embeddings
    return J.nearest_vectors(e.where("vec_id % 20 = 0"), e, query_id="vec_id", base_id="vec_id", vector="embedding", k=5).select("query", "base", "rank")


@query("j9_token_overlap", r"""
WITH w AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '')) AS ws FROM benchmark)
SELECT a.item_id AS left, b.item_id AS right, round(CAST(len(list_intersect(a.ws, b.ws)) / CAST(len(list_distinct(list_concat(a.ws, b.ws))) AS DOUBLE) AS DECIMAL(18,6)), 4) AS similarity
FROM w a, w b WHERE len(list_intersect(a.ws, b.ws)) / CAST(len(list_distinct(list_concat(a.ws, b.ws))) AS DOUBLE) >= 0.15""")
def token_overlap(t):
    b = t.benchmark
    p = J.token_overlap(b, b, left_id="item_id", right_id="item_id", left_text="text", right_text="text", threshold=0.15)
    return p.select("left", "right", F.round(F.col("similarity").cast("decimal(18,6)"), 4).alias("similarity"))


@query("j7_fuzzy_names")
def fuzzy_names(t):
    """Nations' names as they may be written: with an ending, a letter less or more, a word before, parted in two."""
    n, k = F.initcap("n_name"), F.col("n_nationkey") % 3 + 2
    written = F.array(n, F.concat(n, F.lit(" Holdings Inc.")), F.concat(F.substring(n, F.lit(1), k), F.substring(n, k + 2, F.lit(99))), F.concat(F.substring(n, F.lit(1), k), F.lit("e"), F.substring(n, k + 1, F.lit(99))), F.concat(F.lit("Great "), n), F.concat(F.substring(n, F.lit(1), k), F.lit(" "), F.substring(n, k + 1, F.lit(99))))
    names = t.nation.select(F.explode(written).alias("name")).distinct()
    return J.ranked_matches(J.fuzzy_names(names, names, name="name", candidate="name", threshold=0.85).where("name <> candidate"))


@query("j13_resolution")
def resolution(t):
    known = t.nation.select("n_nationkey", F.col("n_name").alias("canonical_name"))
    names = t.nation.select(F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).when(F.col("n_nationkey") % 3 == 1, F.concat("n_name", F.lit(" Holdings"))).otherwise(F.concat(F.lit("zz"), F.reverse("n_name"))).alias("name"))
    matches = J.fuzzy_names(names, known, name="name", candidate="canonical_name", threshold=0.9)
    return J.resolve(names, known, matches, known_id="n_nationkey")


@query("j13b_verdict", "SELECT o_orderkey, CASE WHEN (o_orderkey % 100) / 100.0 > 0.94 THEN 'accept' WHEN (o_orderkey % 100) / 100.0 > 0.85 THEN 'review' ELSE 'new' END AS verdict FROM orders")
def verdict(t):
    return t.orders.select("o_orderkey", J.match_verdict((F.col("o_orderkey") % 100) / 100.0).alias("verdict"))


@query("r8_cosine", """
SELECT a.vec_id, round(CAST(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS DECIMAL(18,8)), 5) AS similarity FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) b""")
def cosine(t):
    from ..functions.scalar import cosine as cos

    one = t.embeddings.where("vec_id = 0").select(F.col("embedding").alias("q"))
    return t.embeddings.join(F.broadcast(one)).select("vec_id", F.round(cos("embedding", "q").cast("decimal(18,8)"), 5).alias("similarity"))


@query("c5_clusters", """
WITH d AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS root, count(*) OVER (PARTITION BY sha256(text)) AS n FROM documents) SELECT doc_id AS node, root FROM d WHERE n > 1""")
def clusters(t):
    """Exact copies as a graph: each copy is tied to its group's next smaller one, a path that clusters must close."""
    from pyspark.sql import Window as W

    d = t.documents.select("doc_id", F.sha2("text", 256).alias("digest"))
    edges = d.withColumn("b", F.lag("doc_id").over(W.partitionBy("digest").orderBy("doc_id"))).where("b is not null").select(F.col("doc_id").alias("a"), "b")
    return E.clusters(edges)


@query("c5_merge_entities")
def merge_entities(t):
    """Customers whose names end in the same three digits are one entity here."""
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("canonical_name"), F.array(F.col("c_mktsegment")).alias("dba_names"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("parent"))
    least = c.groupBy((F.col("id") % 100).alias("k")).agg(F.min("id").alias("b"))
    edges = c.withColumn("k", F.col("id") % 100).join(least, "k").where("id <> b").select(F.col("id").alias("a"), "b")
    return E.merge_entities(c, edges, fill=("parent",))


@query("v22_merge_confidence", """
SELECT o_orderkey, CASE WHEN b >= 0.95 AND b - s > 0.1 THEN 'high' WHEN b >= 0.9 AND s >= 0.9 THEN 'low' ELSE 'medium' END AS confidence FROM (SELECT o_orderkey, (90 + o_orderkey % 11) / 100.0::DOUBLE AS b, (80 + o_orderkey % 17) / 100.0::DOUBLE AS s FROM orders)""")
def merge_confidence(t):
    k = F.col("o_orderkey")
    rows = t.orders.select("o_orderkey", ((90 + k % 11) / 100.0).alias("best"), ((80 + k % 17) / 100.0).alias("second"))
    return rows.select("o_orderkey", E.merge_confidence().alias("confidence"))
