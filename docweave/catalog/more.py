"""Facts, reports, further rules, text matching, connectors and files."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import udfs
from ..operators import facts, reports, rules as R, segments, text_match
from ..operators import windows as Wn
from ..operators.entity import written
from ..plans.query import Query
from ..session import scratch_path
from ..sources import connectors, html, sinks, tables
from .base import query


def scratch(t) -> str:
    return scratch_path(t.spark, "files")


@query("src3_fetch_all", "SELECT r_regionkey, r_name FROM region WHERE r_regionkey < 3")
def fetch_all(t):
    rows = Query(t.region).where("r_regionkey", "<", 3).frame().collect()  # a lookup of a few rows
    return t.spark.createDataFrame(rows, t.region.schema)


@query("src11_layout_text", "SELECT page_id, 0 AS page_idx, 'page ' || page_id AS text FROM pages")
def layout_text(t):
    doc = F.concat(F.lit('{"pdf_info":[{"page_idx":0,"para_blocks":[{"type":"text","lines":[{"spans":[{"content":" page "},{"content":"'), F.col("page_id").cast("string"), F.lit('"}]}]}]}]}'))
    return tables.layout_pages(t.pages.select("page_id", doc.alias("layout"))).select("page_id", "page_idx", S.span_text("blocks").alias("text"))


@query("src12_json_lines", "SELECT event_id, event_type, value FROM events WHERE event_type = 'error'")
def json_lines(t):
    path = scratch(t)
    tables.append_json_lines(t.events.where("event_type = 'error'").select("event_id", "event_type", "value"), path)
    return tables.read_json_lines(t.spark, path, "event_id long, event_type string, value double")


@query("snk1_batch_insert", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey < 5")
def batch_insert(t):
    path, rows = scratch(t), t.supplier.select("s_suppkey", "s_name")
    sinks.append(rows, path, 2)
    sinks.append(rows.where("s_suppkey < 5"), path)
    return t.spark.read.schema(rows.schema).parquet(path)


@query("snk5_csv_export", "SELECT CAST(n_nationkey AS VARCHAR) AS \"File Number\", n_name AS \"Legal Name\" FROM nation")
def csv_export(t):
    path = scratch(t)
    sinks.export_csv(t.nation, path, {"File Number": "n_nationkey", "Legal Name": "n_name"})
    return t.spark.read.schema("`File Number` string, `Legal Name` string").option("header", True).csv(path)


@query("snk8_upload_new_content", "SELECT min(doc_id) AS doc_id FROM documents d WHERE doc_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM documents k WHERE k.doc_id % 2 = 0 AND sha256(k.text) = sha256(d.text)) GROUP BY sha256(d.text)")
def upload_new_content(t):
    d = t.documents.select("doc_id", F.sha2("text", 256).alias("digest"))
    return sinks.new_content(d.where("doc_id % 2 = 1"), d.where("doc_id % 2 = 0"), "digest", "doc_id").select("doc_id")


@query("snk9_retention", "SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' - INTERVAL 7 DAY")
def retention(t):
    return sinks.expired(t.orders, F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'"), at="o_orderdate").select("o_orderkey")


@query("f6_conjunction", "SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_nationkey = 3 AND c_mktsegment LIKE 'A%'")
def conjunction(t):
    return Query(t.customer).where("c_acctbal", ">", 0).where("c_nationkey", "=", 3).where("c_mktsegment", "like", "A%").select("c_custkey").frame()


@query("f11_live_links", "SELECT page_id FROM pages WHERE url IS NOT NULL AND NOT contains(url, '?')")
def live_links(t):
    return t.pages.where(F.col("url").isNotNull() & ~F.col("url").contains("?")).select("page_id")


@query("j1_any_condition", "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def any_condition(t):
    other = t.nation.select(F.col("n_nationkey").alias("b"), F.col("n_regionkey").alias("b_region"))
    return Query(t.nation).join(other, "n_regionkey = b_region and n_nationkey < b").select(F.col("n_nationkey").alias("a"), "b").frame()


@query("j12_latest_with_errors", """
WITH l AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders)
SELECT l.o_custkey, l.o_orderkey, count(i.l_orderkey) AS n FROM l LEFT JOIN lineitem i ON i.l_orderkey = l.o_orderkey AND i.l_returnflag = 'R' WHERE k = 1 GROUP BY 1, 2""")
def latest_with_errors(t):
    """The latest run of each entity and its findings, in one join instead of a query each."""
    last = Wn.latest(t.orders, ["o_custkey"], F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    per = t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return last.join(per, "o_orderkey", "left").select("o_custkey", "o_orderkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("a12_investment_totals", """
SELECT l_orderkey, CAST(CASE WHEN l_orderkey % 3 = 0 OR sum(l_partkey) > 0 THEN sum(l_partkey) END AS BIGINT) AS total_low, CAST(CASE WHEN l_orderkey % 3 = 0 THEN sum(l_partkey) + 500 WHEN sum(l_suppkey) > 0 THEN sum(l_suppkey) END AS BIGINT) AS total_high,
 CASE WHEN l_orderkey % 3 = 0 THEN abs(sum(l_partkey) + 500 - sum(l_suppkey)) <= 100 ELSE true END AS totals_match FROM lineitem GROUP BY l_orderkey""")
def investment_totals(t):
    s = F.sum("l_partkey").over(W.partitionBy("l_orderkey"))
    said = F.col("l_orderkey") % 3 == 0
    items = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("low_cents"), F.col("l_suppkey").alias("high_cents"), F.when(said, s).alias("stated_low"), F.when(said, s + 500).alias("stated_high"))
    return facts.investment_totals(items, ["l_orderkey"])


@query("a13_minimum_total", "SELECT l_orderkey, CAST(100 + sum(l_linenumber) AS BIGINT) AS least FROM lineitem GROUP BY 1")
def minimum_total(t):
    g = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.col("l_linenumber").cast("long")).alias("extra"))
    return g.select("l_orderkey", facts.minimum_total(F.lit(100).cast("long"), F.col("extra")).alias("least"))


@query("a25_status_counts", "SELECT count(*) AS total, count(*) FILTER (WHERE role = 'user') AS started, count(*) FILTER (WHERE role = 'assistant') AS done FROM conversations")
def status_counts(t):
    from ..operators.aggregates import status_counts as counts

    return counts(t.conversations, [], F.col("role"), {"started": "user", "done": "assistant"})


@query("a26_flow_metrics", """
SELECT o_orderpriority, count(*) AS discovered, count(*) FILTER (WHERE o_orderstatus IN ('O', 'F')) AS created, count(*) FILTER (WHERE o_orderstatus = 'F') AS downloaded,
 round(CAST(100.0 * count(*) FILTER (WHERE o_orderstatus IN ('O', 'F')) / nullif(count(*), 0) AS DECIMAL(18,4)), 2) AS created_rate,
 round(CAST(100.0 * count(*) FILTER (WHERE o_orderstatus = 'F') / nullif(count(*) FILTER (WHERE o_orderstatus IN ('O', 'F')), 0) AS DECIMAL(18,4)), 2) AS download_rate FROM orders GROUP BY 1""")
def flow_metrics(t):
    status = F.when(F.col("o_orderstatus") == "F", "downloaded").when(F.col("o_orderstatus") == "O", "created").otherwise("found")
    return reports.flow_metrics(t.orders.withColumn("status", status), ["o_orderpriority"], "status")


@query("w7_best_candidate", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS k FROM events) WHERE k = 1")
def best_candidate(t):
    return Wn.latest(t.events, ["user_id", "event_type"], F.col("value").desc(), F.col("event_id")).select("user_id", "event_type", "event_id")


@query("o3_first", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def first(t):
    return Query(t.orders).order_by(("o_totalprice", "desc"), "o_orderkey").limit(1).select("o_orderkey").frame()


@query("o6_stable_similarity", "SELECT vec_id, label FROM embeddings ORDER BY -round(CAST(embedding[1] AS DECIMAL(18,8)), 3), vec_id LIMIT 20")
def stable_similarity(t):
    score = F.round(F.get("embedding", F.lit(0)).cast("decimal(18,8)"), 3)
    return t.embeddings.orderBy(score.desc(), "vec_id").limit(20).select("vec_id", "label")


@query("u3_shared_tokens", r"""
WITH w AS (SELECT p_partkey, list_distinct(string_split(lower(p_type), ' ')) AS a, list_distinct(string_split(lower(p_name), ' ')) AS b FROM part)
SELECT p_partkey, len(list_intersect(a, b)) AS shared, len(list_distinct(list_concat(a, b))) AS whole FROM w""")
def shared_tokens(t):
    words = lambda c: F.split(F.lower(F.col(c)), " ")
    return t.part.select("p_partkey", F.size(F.array_intersect(words("p_type"), words("p_name"))).cast("long").alias("shared"), F.size(F.array_union(words("p_type"), words("p_name"))).cast("long").alias("whole"))


@query("t7_address", "SELECT c_custkey, c_custkey || ' Main St' AS street, 'Madison' AS city, 'WI' AS state, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '5') AS zip FROM customer")
def address(t):
    from ..functions.text import parse_address

    key = F.col("c_custkey").cast("string")
    given = F.concat(key, F.lit(" Main St, Madison, WI "), F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "5"))
    a = parse_address(given)
    return t.customer.select("c_custkey", a["street"].alias("street"), a["city"].alias("city"), a["state"].alias("state"), a["zip"].alias("zip"))


@query("t14_title_case", "SELECT p_partkey, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS name FROM part")
def title_case(t):
    return t.part.select("p_partkey", udfs.unicode_title(F.col("p_type")).alias("name"))


@query("t20_fuzzy_headings")
def fuzzy_headings(t):
    """Every distinct line of the documents that is short enough for a heading, with the heading that it is most like."""
    lines = t.documents.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length("line").between(5, 200)).distinct()
    known = [(r["item_no"], r["heading"]) for r in segments.standard_headings(t.spark).collect()]  # a lookup of some fifty rows
    return lines.withColumn("best", segments.best_heading(known)("line")).where("best.item_no is not null").select("line", "best.item_no", "best.score")


@query("t21_heading_similarity")
def heading_similarity(t):
    items = t.benchmark.select("item_id", F.col("text").alias("heading"))
    found = text_match.heading_similarity(t.benchmark, items, text_id="item_id", text="text", heading_id="item_id", heading="heading", least=0.5)
    return found.select(F.col("text").alias("item_id"), "heading", F.round(F.col("similarity").cast("decimal(18,8)"), 6).alias("similarity"))


@query("x2_two_formats", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, make_date(2024, 1, 1) AS fallback FROM orders")
def two_formats(t):
    given = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    return t.orders.select("o_orderkey", S.parse_iso_or_us_date(given).alias("d"), S.parse_iso_or_us_date(F.lit("soon"), 2024).alias("fallback"))


@query("x9_discount", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 100000 - 2500 WHEN 1 THEN 90000 ELSE 100000 END AS fee FROM part")
def discount(t):
    some = F.array(F.struct(F.lit("Veteran").alias("kind"), F.when(F.col("p_partkey") % 3 == 0, 2500).cast("long").alias("amount_cents"), F.when(F.col("p_partkey") % 3 == 1, 10.0).alias("percentage")))
    return t.part.select("p_partkey", facts.discounted(F.lit(100000).cast("long"), some, "veteran").cast("int").alias("fee"))


@query("r4_serialised", "SELECT r_regionkey, '{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}' AS doc FROM region")
def serialised(t):
    return t.region.select("r_regionkey", F.to_json(F.struct("r_regionkey", "r_name", F.lit(None).cast("string").alias("gone"))).alias("doc"))


@query("r6_table_cleaning")
def table_cleaning(t):
    return html.clean_table(t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_acctbal") < 0, "N/A").otherwise(F.concat(F.lit("$"), F.col("c_acctbal").cast("string"))).alias("balance"), F.lit("").alias("nothing"), F.lit("12/31/2023").alias("filing_date")))


@query("r7_renamed_columns", "SELECT o_orderkey AS file_number, CASE o_orderstatus WHEN 'F' THEN 'Registered' WHEN 'O' THEN 'Pending' ELSE o_orderstatus END AS status FROM orders")
def renamed_columns(t):
    """Columns are renamed by a part of their names, on the driver; states by a map."""
    renamed = tables.renamed_by_part(t.orders.select("o_orderkey", "o_orderstatus"), {"key": "file_number", "status": "status"})
    return tables.mapped(renamed, "status", {"F": "Registered", "O": "Pending"})


@query("v2_document_rules", "SELECT conv_id * 1000 + turn AS id, 'page_range' AS rule FROM conversations WHERE length(role) < turn UNION ALL SELECT conv_id * 1000 + turn, 'item_no_max' FROM conversations WHERE turn > 24")
def document_rules(t):
    rows = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("turn").alias("start_page"), F.length("role").alias("end_page"), F.col("turn").alias("item_no"), F.lit(None).cast("date").alias("issue_date"), F.lit(None).cast("date").alias("amendment_date"))
    return R.findings(rows, "id", R.document_rules()).select("id", "rule")


@query("v3_initial_fee_rules", """
WITH f AS (SELECT o_orderkey AS id, o_totalprice * 4000 AS cents FROM orders)
SELECT id, 'refund_conditions' AS rule FROM f WHERE id % 4 = 0 UNION ALL SELECT id, 'fee_high' FROM f WHERE cents > 100000000 AND cents <= 1000000000 UNION ALL SELECT id, 'fee_too_high' FROM f WHERE cents > 1000000000""")
def initial_fee_rules(t):
    rows = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 4 == 0).alias("refundable"), F.lit("").alias("refund_conditions"), (F.col("o_totalprice") * 4000).alias("amount_cents"))
    return R.findings(rows, "id", R.initial_fee_rules()).select("id", "rule")


@query("v4_other_fee_rules", """
SELECT l_orderkey * 10 + l_linenumber AS id, 'percentage_basis' AS rule FROM lineitem WHERE l_linenumber % 2 = 0 UNION ALL SELECT l_orderkey * 10 + l_linenumber, 'amount_or_percentage' FROM lineitem WHERE l_linenumber = 3
UNION ALL SELECT l_orderkey * 10 + l_linenumber, 'royalty_high' FROM lineitem WHERE l_linenumber % 2 = 0 AND l_quantity > 50""")
def other_fee_rules(t):
    n = F.col("l_linenumber")
    rows = t.lineitem.select((F.col("l_orderkey") * 10 + n).alias("id"), F.lit("Royalty").alias("fee_name"), F.when((n % 2 == 1) & (n != 3), 5).alias("amount_cents"), F.when(n % 2 == 0, F.col("l_quantity")).alias("amount_percentage"), F.lit(None).cast("long").alias("min_cents"), F.lit(None).cast("long").alias("max_cents"), F.lit(None).cast("string").alias("calculation_basis"))
    return R.findings(rows, "id", R.other_fee_rules()).select("id", "rule")


@query("v6_performance_rules", """
WITH i AS (SELECT l_orderkey AS id, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high, sum(l_linenumber) AS med FROM lineitem GROUP BY 1)
SELECT id, 'small_sample' AS rule FROM i WHERE n < 5 UNION ALL SELECT id, 'median_outside' FROM i WHERE med < low OR med > high""")
def performance_rules(t):
    g = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.count(F.lit(1)).alias("sample_size"), F.min("l_quantity").alias("low_cents"), F.max("l_quantity").alias("high_cents"), F.sum("l_linenumber").alias("median_cents"))
    g = g.withColumns({"average_cents": F.lit(None).cast("double"), "period_years": F.lit(3)})
    return R.findings(g, "id", R.performance_rules()).select("id", "rule")


@query("v9_extraction_rules", """
SELECT p_partkey AS id, 'royalty_missing' AS rule FROM part WHERE p_size > 40 AND p_partkey % 2 = 1 UNION ALL SELECT p_partkey, 'royalty_over_limit' FROM part WHERE p_size <= 40 AND p_size * 2 > 50
UNION ALL SELECT p_partkey, 'low_confidence' FROM part WHERE p_partkey % 10 < 7""")
def extraction_rules(t):
    k, size = F.col("p_partkey"), F.col("p_size")
    other = F.when(k % 2 == 0, F.array(F.struct(F.lit("Royalty B").alias("fee_name"), F.lit(1.0).alias("amount_percentage"))))
    rows = t.part.select(k.alias("id"), ((k % 10) / 10.0).alias("extraction_confidence"), F.when(size <= 40, size * 2).alias("royalty_percentage"), F.lit(1.0).alias("marketing_fee_percentage"), other.alias("other_fees"))
    return R.findings(rows, "id", R.extraction_rules("item6")).select("id", "rule")


@query("v13_fee_relationships", """
WITH g AS (SELECT o_custkey, min_by(o_totalprice, o_orderkey) AS base FROM orders GROUP BY 1) SELECT o.o_orderkey FROM orders o JOIN g USING (o_custkey) WHERE o.o_totalprice > 2 * g.base""")
def fee_relationships(t):
    base = t.orders.groupBy("o_custkey").agg(F.min_by("o_totalprice", "o_orderkey").alias("base"))
    j = t.orders.join(base, "o_custkey")
    return R.findings(j, "o_orderkey", [R.Rule("over_twice", "o_totalprice", F.col("o_totalprice") > 2 * F.col("base"), "over twice the first", R.WARNING)]).select("o_orderkey")


@query("v16_custom_rules", "SELECT n_nationkey, 'long_name' AS rule FROM nation WHERE length(n_name) > 8")
def custom_rules(t):
    registry = R.Registry()
    registry.register("nation", R.Rule("long_name", "n_name", F.length("n_name") > 8, "a long name", R.INFO))
    return R.findings(t.nation, "n_nationkey", registry.of("nation")).select("n_nationkey", "rule")


def _runs(t):
    k = F.col("event_id")
    return t.events.select(F.col("event_type").alias("entity_type"), (k % 5 != 0).alias("is_valid"), (k % 4).alias("error_count"), (k % 3).alias("warning_count"), F.when(k % 6 == 0, "known").alias("bypass_reason"), (F.col("value") * 20).alias("duration_ms"))


_RUNS = "runs AS (SELECT event_type AS entity_type, event_id % 5 <> 0 AS is_valid, event_id % 4 AS e, event_id % 3 AS w, event_id % 6 = 0 AS bypassed, value * 20 AS ms FROM events)"


@query("x12_quality_by_entity", f"""WITH {_RUNS}, g AS (SELECT entity_type, count(*) AS runs, round(CAST(100.0 * count(*) FILTER (is_valid) / count(*) AS DECIMAL(18,4)), 2) AS pass_rate, avg(e) AS e, avg(w) AS w, round(CAST(100.0 * count(*) FILTER (bypassed) / count(*) AS DECIMAL(18,4)), 2) AS bypass_rate FROM runs GROUP BY 1)
SELECT entity_type, runs, pass_rate, bypass_rate, round(CAST(100 - least(e * 10, 50) - least(w * 2, 30) - least(CAST(bypass_rate AS DOUBLE) * 0.5, 20) AS DECIMAL(18,4)), 2) AS quality_score FROM g""")
def quality_by_entity(t):
    return reports.entity_quality(_runs(t), "entity_type").select("entity_type", "runs", "pass_rate", "bypass_rate", "quality_score")


@query("v18_recommendations", f"WITH {_RUNS} SELECT 'HIGH_BYPASS_RATE' AS type, entity_type AS subject, 'MEDIUM' AS priority FROM runs GROUP BY entity_type HAVING 100.0 * count(*) FILTER (bypassed) / count(*) > 10 AND 100.0 * count(*) FILTER (bypassed) / count(*) <= 20 AND 100 - least(avg(e) * 10, 50) - least(avg(w) * 2, 30) - least(100.0 * count(*) FILTER (bypassed) / count(*) * 0.5, 20) < 80 UNION ALL SELECT 'FREQUENT_ERROR', 'f1', 'HIGH'")
def recommendations(t):
    patterns = t.spark.createDataFrame([("f1", "HIGH", 9), ("f2", "LOW", 20)], "field_name string, severity string, frequency int")
    return reports.recommendations(reports.entity_quality(_runs(t), "entity_type"), patterns)


@query("v19_slow_entities", f"WITH {_RUNS} SELECT entity_type, round(CAST(avg(ms) AS DECIMAL(24,6)), 2) AS avg_duration_ms, round(CAST(100.0 * count(*) FILTER (ms > 100) / count(*) AS DECIMAL(18,4)), 2) AS slow_rate FROM runs GROUP BY 1 HAVING avg(ms) > 100")
def slow_entities(t):
    return reports.slow_entities(_runs(t), "entity_type", "duration_ms", 100.0)


@query("v21_financial_health")
def financial_health(t):
    from .relational import nation_year

    ny = nation_year(t).select("n_nationkey", F.col("y").alias("fiscal_year"), F.col("revenue").cast("long").alias("revenue_cents"))
    k = F.col("n_nationkey")
    rows = ny.withColumns({"net_income_cents": (F.col("revenue_cents") * (k % 5 - 1) / 10).cast("long"), "current_assets_cents": (k + 1).cast("long"), "current_liabilities_cents": F.lit(5).cast("long"), "liabilities_cents": F.lit(30).cast("long"), "equity_cents": (k * 10).cast("long")})
    return reports.financial_health(rows, "n_nationkey")


@query("v12_fpr_consistency", """
WITH r AS (SELECT o_orderkey AS id, o_orderkey % 2 = 0 AS fpr, o_orderkey % 3 = 0 AS tables, o_orderkey % 5 = 0 AS revenue, o_orderkey % 7 = 0 AS profit FROM orders)
SELECT id, 'tables_without_fpr' AS rule FROM r WHERE NOT fpr AND tables UNION ALL SELECT id, 'metrics_without_fpr' FROM r WHERE NOT fpr AND (revenue OR profit) UNION ALL SELECT id, 'fpr_without_data' FROM r WHERE fpr AND NOT tables AND NOT revenue""")
def fpr_consistency(t):
    k, none = F.col("o_orderkey"), F.lit(None).cast("long")
    money = lambda n: F.when(k % n == 0, 100).when(k % 2 == 0, 0).cast("long")  # noqa: E731  zero counts as none
    rows = t.orders.select(k.alias("id"), (k % 2 == 0).alias("has_fpr"), F.when(k % 3 == 0, F.array(F.lit("t"))).when(k % 4 == 0, F.expr("cast(array() as array<string>)")).alias("performance_tables"), money(5).alias("average_gross_revenue_cents"), none.alias("median_gross_revenue_cents"), none.alias("average_net_profit_cents"), money(7).alias("median_net_profit_cents"))
    return R.findings(rows, "id", R.fpr_consistency_rules()).select("id", "rule")


@query("v23_documented_rules", """
WITH r AS (SELECT o_orderkey AS id, o_orderkey AS k FROM orders)
SELECT id, 'stale' AS rule FROM r WHERE k % 5 = 4 UNION ALL SELECT id, 'ageing' FROM r WHERE k % 5 = 3 UNION ALL SELECT id, 'royalty_over_15' FROM r WHERE k % 20 > 15
UNION ALL SELECT id, 'current_over_total' FROM r WHERE k % 7 > 3 UNION ALL SELECT id, 'repeated_states' FROM r WHERE k % 6 = 0 UNION ALL SELECT id, 'fiscal_gap' FROM r WHERE k % 4 = 1
UNION ALL SELECT id, 'no_auditor' FROM r WHERE k % 11 > 5 AND k % 2 = 0 UNION ALL SELECT id, 'margin_outside' FROM r WHERE k % 11 > 0 AND abs((k % 13 - 6) * 1000000000 * 100.0 / (k % 11 * 1000000000)) > 50""")
def documented_rules(t):
    k = F.col("o_orderkey")
    years = lambda *y: F.array(*map(F.lit, y))
    rows = t.orders.select(
        k.alias("id"), (k % 5).alias("document_age_years"), (k % 20).alias("royalty_percentage"), (k % 7).alias("current_assets_cents"), F.lit(3).alias("assets_cents"),
        F.when(k % 6 == 0, F.array(F.lit("MN"), F.lit("WI"), F.lit("MN"))).otherwise(F.array(F.lit("MN"), F.lit("WI"))).alias("state_codes"),
        F.when(k % 4 == 0, years(2023, 2021, 2022)).when(k % 4 == 1, years(2024, 2021, 2022)).when(k % 4 == 2, years(2022)).alias("fiscal_years"),
        F.when(k % 2 == 1, "Auditors LLP").when(k % 4 == 0, " ").alias("auditor_name"), (k % 11 * 1_000_000_000).alias("revenue_cents"), ((k % 13 - 6) * 1_000_000_000).alias("net_income_cents"),
    )
    return R.findings(rows, "id", R.documented_rules()).select("id", "rule")


@query("c3_repaired_sections")
def repaired_sections(t):
    c = t.conversations.select(F.col("conv_id").alias("doc_id"), F.pmod("turn", F.lit(25)).cast("int").alias("item_no"), (F.col("turn") + 1).cast("int").alias("start_page"), F.lit(40).alias("total_pages"))
    return segments.repair(c)


@query("c6_ingestion", """
WITH d AS (SELECT doc_id, sha256(text) AS digest FROM documents), f AS (SELECT doc_id, row_number() OVER (PARTITION BY digest ORDER BY doc_id) AS k FROM d)
SELECT count(*) FILTER (k = 1) AS created, count(*) FILTER (k > 1) AS duplicates, count(*) AS found FROM f""")
def ingestion(t):
    d = Wn.oldest_kept(t.documents.select("doc_id", F.sha2("text", 256).alias("digest")), ["digest"], F.col("doc_id"))
    return d.agg(F.count_if("keep").alias("created"), F.count_if(~F.col("keep")).alias("duplicates"), F.count(F.lit(1)).alias("found"))


@query("c8_initial_fee_facts", """
SELECT p_partkey, 0 AS fact_no, 'Initial Franchise Fee' AS fee_name, CAST(p_size * 100 AS BIGINT) AS amount_cents FROM part UNION ALL SELECT p_partkey, 1, 'Training', CAST(p_size AS BIGINT) FROM part
UNION ALL SELECT p_partkey, 2, 'Additional Unit Fee', CAST(50 AS BIGINT) FROM part WHERE p_partkey % 2 = 0""")
def initial_fee_facts(t):
    more = F.array(F.struct(F.lit("Training").alias("fee_name"), F.col("p_size").cast("long").alias("amount_cents")))
    rows = t.part.select("p_partkey", (F.col("p_size") * 100).alias("initial_franchise_fee_cents"), more.alias("additional_fees"), F.when(F.col("p_partkey") % 2 == 0, 50).alias("additional_unit_fee_cents"))
    return facts.initial_fees(rows, ["p_partkey"]).select("p_partkey", "fact_no", "fee_name", "amount_cents")


@query("c8_other_fee_facts", """
SELECT p_partkey, 0 AS fact_no, 'Royalty Fee' AS fee_name, CAST(p_size AS DOUBLE) AS amount_percentage, 'Gross Sales' AS calculation_basis FROM part WHERE p_size < 25
UNION ALL SELECT p_partkey, CASE WHEN p_size < 25 THEN 1 ELSE 0 END, 'Marketing/Advertising Fee', 2.0, 'Gross Sales' FROM part""")
def other_fee_facts(t):
    none = F.lit(None)
    empty = F.array().cast("array<struct<fee_name:string,amount_cents:bigint,amount_percentage:double>>")
    rows = t.part.select("p_partkey", F.when(F.col("p_size") < 25, F.col("p_size").cast("double")).alias("royalty_percentage"), F.lit("Gross Sales").alias("royalty_basis"), F.lit(2.0).alias("marketing_fee_percentage"), none.cast("long").alias("marketing_fee_cents"), empty.alias("other_fees"))
    return facts.other_fees(rows, ["p_partkey"]).select("p_partkey", "fact_no", "fee_name", "amount_percentage", "calculation_basis")


@query("c9_isolated_validation", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) IS NULL OR event_id % 50 = 0 AS malformed FROM events")
def isolated_validation(t):
    """Malformed rows become findings that say so; none stops the batch."""
    broken = F.when(F.col("event_id") % 50 == 0, "{oops").otherwise(F.col("props"))
    found = R.validated_json(t.events.select("event_id", broken.alias("doc")), "event_id", "doc", "k bigint", [R.required("k")])
    return found.select("event_id", (F.col("status") == "invalid").alias("malformed"))


@query("c11_update_stamp", "SELECT s_suppkey, s_acctbal < 0 AS touched FROM supplier")
def update_stamp(t):
    stamped = sinks.updated(t.supplier.withColumn("updated_at", F.lit("2024-01-01")), F.col("s_acctbal") < 0, {"updated_at": F.lit("2024-06-01")})
    return stamped.select("s_suppkey", (F.col("updated_at") == "2024-06-01").alias("touched"))


@query("udf_embedding")
def embedding(t):
    return t.nation.select("n_nationkey", udfs.hashed_embedding(F.col("n_name")).alias("embedding"))


@query("udf_remote_answers", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'A' || n_name ELSE 'B' || n_name END AS answer, CASE WHEN n_nationkey % 2 = 0 THEN 'one' ELSE 'two' END AS provider FROM nation")
def remote_answers(t):
    def one(prompt: str) -> str:
        if int(prompt.split(":")[0]) % 2:
            raise TimeoutError
        return "A" + prompt.split(":")[1]

    def two(prompt: str) -> str:
        return "B" + prompt.split(":")[1]

    asked = t.nation.select("n_nationkey", F.concat_ws(":", F.col("n_nationkey").cast("string"), "n_name").alias("prompt"))
    return connectors.first_answer(asked, "prompt", {"one": connectors.remote(one), "two": connectors.remote(two)}).select("n_nationkey", "answer", "provider")


@query("api_upload_rules", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 2 END AS n FROM part")
def upload_rules(t):
    odd = F.col("p_partkey") % 2 == 1
    problems = connectors.upload_problems(F.when(odd, "a.txt").otherwise("a.PDF"), F.lit(10), F.when(odd, "CA").otherwise("MN"), F.lit("2024-01-01"))
    return t.part.select("p_partkey", F.size(problems).alias("n"))
