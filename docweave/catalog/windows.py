"""Neighbouring rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as Wn
from .base import query
from .relational import _NATION_YEAR, nation_year


def _ny(t):
    return nation_year(t).withColumn("revenue", F.col("revenue").cast("double"))


@query("w1_continuity", f"""WITH {_NATION_YEAR}, s AS (SELECT *, lag(y) OVER w AS py, lag(revenue) OVER w AS pr FROM nation_year WINDOW w AS (PARTITION BY n_nationkey ORDER BY y))
SELECT n_nationkey, CAST(y AS INT) AS y FROM s WHERE y = py + 1 AND CAST(revenue AS BIGINT) % 7 <> CAST(pr AS BIGINT) % 7""")
def continuity(t):
    ny = nation_year(t).withColumn("r", F.round("revenue").cast("long") % 7)
    return Wn.continuity(ny, ["n_nationkey"], "y", "r", "r").select("n_nationkey", "y")


@query("w2_yearly_change", f"""WITH {_NATION_YEAR}, s AS (SELECT n_nationkey, y, CAST(revenue AS DOUBLE) AS revenue, lag(CAST(revenue AS DOUBLE)) OVER (PARTITION BY n_nationkey ORDER BY y) AS pr FROM nation_year)
SELECT n_nationkey, CAST(y AS INT) AS y, CASE WHEN pr > 0 THEN round(CAST((revenue - pr) / pr AS DECIMAL(24,8)), 4) END AS revenue_change FROM s""")
def yearly_change(t):
    return Wn.changes(_ny(t), ["n_nationkey"], "y", ["revenue"]).select("n_nationkey", "y", "revenue_change")


@query("w4_latest_order", "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def latest_order(t):
    return Wn.latest(t.orders, ["o_custkey"], F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).select("o_custkey", "o_orderkey", "o_orderdate")


@query("w5_latest_event", "SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def latest_event(t):
    return t.events.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("w6_keep_oldest", "SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1 AS keep FROM documents")
def keep_oldest(t):
    d = t.documents.select("doc_id", F.sha2("text", 256).alias("digest"))
    return Wn.oldest_kept(d, ["digest"], F.col("doc_id")).select("doc_id", "keep")


@query("w8_section_ends", """
SELECT conv_id, turn, greatest(turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn), 75)) AS end_page FROM conversations""")
def section_ends(t):
    return Wn.section_ends(t.conversations, "conv_id", "turn", "turn", default_last=75).select("conv_id", "turn", F.col("end_page").cast("long").alias("end_page"))


@query("w9_boundaries", """
WITH s AS (SELECT conv_id, turn, length(role) AS a, length(role) + turn AS b, lag(length(role)) OVER w AS pa, lag(length(role) + turn) OVER w AS pb FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, a > b AS reversed, coalesce(a < pa, false) AS out_of_order, coalesce(a > pb + 1, false) AS gap, coalesce(a < pb, false) AS overlap FROM s""")
def boundaries(t):
    c = t.conversations.withColumns({"a": F.length("role"), "b": F.length("role") + F.col("turn")})
    return Wn.boundary_flags(c, "conv_id", "a", "b", "turn").select("conv_id", "turn", "reversed", "out_of_order", "gap", "overlap")


@query("w10_increasing", """
WITH s AS (SELECT conv_id, coalesce(length(text) > lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn), true) AS ok FROM conversations) SELECT conv_id, bool_and(ok) AS increasing FROM s GROUP BY 1""")
def increasing(t):
    return Wn.strictly_increasing(t.conversations.withColumn("n", F.length("text")), "conv_id", "n", "turn")


@query("w11_trailing_mean", """
SELECT event_id, round(CAST(avg(value) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS DECIMAL(24,6)), 3) AS trailing_mean FROM events""")
def trailing_mean(t):
    m = Wn.trailing_mean(t.events, ["event_type"], "ts", "value")
    return m.select("event_id", F.round(F.col("trailing_mean").cast("decimal(24,6)"), 3).alias("trailing_mean"))


@query("w12_repeated_keys", "SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_keys(t):
    return Wn.repeated_keys(t.lineitem, ["l_partkey", "l_suppkey"])


@query("w13_running_size", "SELECT doc_id, CAST(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS running FROM documents")
def running_size(t):
    from pyspark.sql import Window as W

    return t.documents.select("doc_id", F.sum("n_chars").over(W.partitionBy("source").orderBy("doc_id")).alias("running"))


@query("w14_last_two_years", f"""WITH {_NATION_YEAR}, s AS (SELECT n_nationkey, y, CAST(revenue AS DOUBLE) AS r, lag(CAST(revenue AS DOUBLE)) OVER (PARTITION BY n_nationkey ORDER BY y) AS pr, row_number() OVER (PARTITION BY n_nationkey ORDER BY y DESC) AS k FROM nation_year)
SELECT n_nationkey, CAST(y AS INT) AS y, CASE WHEN pr > 0 THEN round(CAST((r - pr) / pr AS DECIMAL(24,8)), 4) END AS revenue_change FROM s WHERE k = 1""")
def last_two_years(t):
    changed = Wn.changes(_ny(t), ["n_nationkey"], "y", ["revenue"])
    return Wn.latest(changed, ["n_nationkey"], F.col("y").desc()).select("n_nationkey", "y", "revenue_change")
