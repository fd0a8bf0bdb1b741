"""Validation over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as R
from ..operators.aggregates import percent
from .base import query


def _item20(t):
    """Order lines as yearly outlet rows: quantities that should add up, and do for some."""
    k = F.col("l_linenumber")
    q = F.col("l_quantity").cast("long")
    return t.lineitem.select((F.col("l_orderkey") * 10 + k).alias("id"), q.alias("count_start"), k.cast("long").alias("opened"), F.lit(1).cast("long").alias("closed"), F.lit(0).cast("long").alias("transferred_in"), F.lit(0).cast("long").alias("transferred_out"), (q + k - 1 + F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("count_end"))


@query("v1_schema_rules", """
SELECT l_orderkey * 10 + l_linenumber AS id, 'l_discount_max' AS rule, 'ERROR' AS severity FROM lineitem WHERE l_discount > 0.08
UNION ALL SELECT l_orderkey * 10 + l_linenumber, 'l_quantity_min', 'ERROR' FROM lineitem WHERE l_quantity < 3
UNION ALL SELECT l_orderkey * 10 + l_linenumber, 'l_returnflag_enum', 'ERROR' FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')""")
def schema_rules(t):
    rules = R.from_spec({"l_discount": {"max": 0.08}, "l_quantity": {"min": 3, "required": True}, "l_returnflag": {"enum": ["A", "N"]}})
    rows = t.lineitem.withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return R.findings(rows, "id", rules).select("id", "rule", "severity")


@query("v5_investment_rules", """
WITH i AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS low, l_suppkey * 20 AS high FROM lineitem)
SELECT id, 'high_below_low' AS rule, 'ERROR' AS severity FROM i WHERE high < low UNION ALL SELECT id, 'wide_range', 'INFO' FROM i WHERE CAST(high AS DOUBLE) / nullif(low, 0) > 10""")
def investment_rules(t):
    rows = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_partkey").alias("low_cents"), (F.col("l_suppkey") * 20).alias("high_cents"))
    return R.findings(rows, "id", R.investment_rules()).select("id", "rule", "severity")


@query("v7_outlet_math", "SELECT l_orderkey * 10 + l_linenumber AS id, 'outlet_math' AS rule FROM lineitem WHERE l_returnflag = 'R'")
def outlet_math(t):
    return R.findings(_item20(t), "id", R.outlet_rules()).select("id", "rule")


@query("v8_balance", """
SELECT o_orderkey AS id, 'balance' AS rule FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, 'low_equity' FROM orders WHERE o_orderkey % 7 = 0""")
def balance(t):
    k = F.col("o_orderkey")
    equity = F.when(k % 7 == 0, F.lit(-1_500_000_000)).otherwise(F.lit(1000)).cast("long")
    rows = t.orders.select(k.alias("id"), (equity + 5000 + F.when(k % 5 == 0, 101).otherwise(100)).alias("assets_cents"), F.lit(5000).cast("long").alias("liabilities_cents"), equity.alias("equity_cents"), F.lit(None).cast("long").alias("revenue_cents"), F.lit(None).cast("long").alias("cost_cents"), F.lit(None).cast("long").alias("gross_profit_cents"), F.lit(None).cast("string").alias("audit_opinion"))
    return R.findings(rows, "id", R.financial_rules()).select("id", "rule")


@query("v10_cross_item", """
WITH f AS (SELECT o_orderkey, o_totalprice FROM orders), r AS (SELECT l_orderkey, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY 1)
SELECT o_orderkey FROM f JOIN r ON o_orderkey = l_orderkey WHERE o_totalprice < low OR o_totalprice > high""")
def cross_item(t):
    r = t.lineitem.groupBy("l_orderkey").agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))
    j = t.orders.join(r, F.col("o_orderkey") == F.col("l_orderkey"))
    rule = R.Rule("fee_outside_investment", "o_totalprice", ~F.col("o_totalprice").between(F.col("low"), F.col("high")), "fee outside the investment's range", R.WARNING, "CROSS_FIELD")
    return R.findings(j, "o_orderkey", [rule]).select("o_orderkey")


@query("v11_completeness", "SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL")
def completeness(t):
    from ..functions.scalar import coverage

    rows = t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality", "toxic").withColumn("coverage", coverage(["doc_id", "quality", "toxic"]))
    return R.findings(rows, "doc_id", [R.Rule("incomplete", "coverage", F.col("coverage") < 50, "under half of the fields", R.WARNING)]).select("doc_id")


@query("v14_status", """
SELECT c_custkey, CASE WHEN c_acctbal < -500 THEN 'invalid' WHEN c_acctbal < 0 THEN 'needs_review' ELSE 'validated' END AS status FROM customer""")
def status(t):
    rules = [R.Rule("deep_debt", "c_acctbal", F.col("c_acctbal") < -500, "deep in debt"), R.Rule("debt", "c_acctbal", F.col("c_acctbal") < 0, "in debt", R.WARNING)]
    return R.validated(t.customer, "c_custkey", rules).select("c_custkey", "status")


@query("v15_bypass", "SELECT c_custkey, 'debt' AS rule FROM customer WHERE c_acctbal < 0 AND NOT (c_custkey % 3 = 0 AND c_custkey % 2 = 0)")
def bypass(t):
    found = R.findings(t.customer, "c_custkey", [R.Rule("debt", "c_acctbal", F.col("c_acctbal") < 0, "in debt", R.WARNING)])
    expires = F.when(F.col("c_custkey") % 2 == 0, F.lit("2024-06-01")).otherwise(F.lit("2023-06-01")).cast("timestamp")
    waived = t.customer.where("c_custkey % 3 = 0").select("c_custkey", F.lit("debt").alias("rule"), expires.alias("expires_at"))
    return R.without_bypassed(found, waived, "c_custkey", F.lit("2024-01-01").cast("timestamp")).select("c_custkey", "rule")


@query("v17_alerts", """
WITH m AS (SELECT date_trunc('day', ts) AS day, count(*) AS n, round(CAST(avg(value) AS DECIMAL(24,6)), 4) AS mean FROM events GROUP BY 1)
SELECT day, 'busy' AS alert FROM m WHERE n > 330 UNION ALL SELECT day, 'low' FROM m WHERE CAST(mean AS DOUBLE) < 20""")
def alert_rules(t):
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("day")
    m = t.events.groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value").cast("decimal(24,6)"), 4).alias("mean"))
    return R.alerts(m, "day", [R.Alert("busy", "n", 330, "gt", "many events"), R.Alert("low", "mean", 20, "lt", "low values")]).select("day", "alert")


@query("v20_health", """
SELECT s_nationkey, count(*) AS n, count(*) FILTER (WHERE s_acctbal < 0) AS bad, round(CAST(100.0 * count(*) FILTER (WHERE s_acctbal >= 0) / count(*) AS DECIMAL(18,4)), 2) AS score,
 CASE WHEN 100.0 * count(*) FILTER (WHERE s_acctbal >= 0) / count(*) < 70 THEN 'DEGRADED' WHEN count(*) FILTER (WHERE s_acctbal < 0) > 5 THEN 'WARNING' ELSE 'HEALTHY' END AS health FROM supplier GROUP BY 1""")
def health(t):
    g = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("s_acctbal") < 0).alias("bad"))
    share = (F.col("n") - F.col("bad")) * 100.0 / F.col("n")
    return g.select("s_nationkey", "n", "bad", percent(F.col("n") - F.col("bad"), F.col("n")).alias("score"), R.health(share, F.col("bad")).alias("health"))


@query("a24_report", """
WITH v AS (SELECT c_custkey, CAST(c_acctbal < -500 AS INT) AS e, CAST(c_acctbal < 0 AS INT) AS w FROM customer)
SELECT count(*) AS total, count(*) FILTER (WHERE e = 0) AS valid, CAST(sum(e) AS BIGINT) AS errors, CAST(sum(w) AS BIGINT) AS warnings, round(CAST(100.0 * count(*) FILTER (WHERE e = 0) / greatest(count(*), 1) AS DECIMAL(18,4)), 2) AS success FROM v""")
def report(t):
    rules = [R.Rule("deep_debt", "c_acctbal", F.col("c_acctbal") < -500, "deep in debt"), R.Rule("debt", "c_acctbal", F.col("c_acctbal") < 0, "in debt", R.WARNING)]
    v = R.validated(t.customer, "c_custkey", rules)
    n = F.count(F.lit(1))
    ok = F.count_if(F.col("errors") == 0)
    return v.agg(n.alias("total"), ok.alias("valid"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"), F.coalesce(F.sum("warnings"), F.lit(0)).alias("warnings"), percent(ok, F.greatest(n, F.lit(1))).alias("success"))


@query("v2_either_or", """
WITH d AS (SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_linenumber % 3 <> 0 THEN l_extendedprice END AS a, CASE WHEN l_linenumber % 4 <> 1 THEN l_quantity * 3 END AS p, l_suppkey AS lo, CASE WHEN l_linenumber <> 2 THEN l_partkey END AS hi FROM lineitem),
e AS (SELECT id, a, p, CASE WHEN id % 7 <> 0 THEN lo END AS lo, hi FROM d)
SELECT id, 'discount_both' AS rule FROM e WHERE a IS NOT NULL AND p IS NOT NULL UNION ALL SELECT id, 'discount_none' FROM e WHERE a IS NULL AND p IS NULL UNION ALL SELECT id, 'percentage_max' FROM e WHERE p > 100
UNION ALL SELECT id, 'range_unset' FROM e WHERE lo IS NULL AND hi IS NULL UNION ALL SELECT id, 'range_reversed' FROM e WHERE hi < lo""")
def either_or(t):
    """Discounts with an amount or a percentage, ranges with an end at least and in order."""
    n, key = F.col("l_linenumber"), F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = t.lineitem.select(key.alias("id"), F.when(n % 3 != 0, F.col("l_extendedprice")).alias("amount_cents"), F.when(n % 4 != 1, F.col("l_quantity") * 3).alias("percentage"), F.when(key % 7 != 0, F.col("l_suppkey")).alias("low"), F.when(n != 2, F.col("l_partkey")).alias("high"))
    return R.findings(rows, "id", [*R.discount_rules(), *R.ordered_range("low", "high", "range")]).select("id", "rule")


@query("v8_components", """
SELECT o_orderkey AS id, 'franchise_revenue_cents_over_revenue_cents' AS rule FROM orders WHERE o_totalprice > 200000 UNION ALL SELECT o_orderkey, 'multi_unit_operators_over_total_franchisees' FROM orders WHERE o_custkey > o_orderkey""")
def components(t):
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("franchise_revenue_cents"), F.lit(200000).alias("revenue_cents"), F.col("o_custkey").alias("multi_unit_operators"), F.col("o_orderkey").alias("total_franchisees"))
    return R.findings(rows, "id", R.component_rules()).select("id", "rule")


@query("v24_typed_rules", r"""
WITH e AS (SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN ' ' || event_id WHEN 1 THEN event_id || '.5' WHEN 2 THEN 'n/a' WHEN 3 THEN NULL ELSE '-3' END AS fee, CASE event_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'maybe' WHEN 2 THEN NULL ELSE 'false' END AS refundable FROM events),
n AS (SELECT *, TRY_CAST(trim(fee) AS DOUBLE) AS number FROM e)
SELECT id, 'fee_required' AS rule FROM n WHERE fee IS NULL UNION ALL SELECT id, 'fee_type' FROM n WHERE fee IS NOT NULL AND number IS NULL UNION ALL SELECT id, 'fee_min' FROM n WHERE number < 0 UNION ALL SELECT id, 'fee_max' FROM n WHERE number > 500
UNION ALL SELECT id, 'count_type' FROM n WHERE fee IS NOT NULL AND NOT regexp_matches(trim(fee), '^[+-]?[0-9]+$') UNION ALL SELECT id, 'refundable_type' FROM n WHERE refundable = 'maybe'""")
def typed_rules(t):
    """Rules as a prompt file lists them, over texts."""
    k = F.col("event_id")
    text = k.cast("string")
    fee = F.when(k % 5 == 0, F.concat(F.lit(" "), text)).when(k % 5 == 1, F.concat(text, F.lit(".5"))).when(k % 5 == 2, "n/a").when(k % 5 == 4, "-3")
    rows = t.events.select(k.alias("id"), fee.alias("fee"), fee.alias("count"), F.when(k % 4 == 0, "true").when(k % 4 == 1, "maybe").when(k % 4 == 3, "false").alias("refundable"))
    listed = [{"field": "fee", "type": "number", "min": 0, "max": 500, "required": True}, {"field": "count", "type": "integer"}, {"field": "refundable", "type": "boolean", "default": False}]
    return R.findings(rows, "id", R.from_rule_list(listed)).select("id", "rule")
