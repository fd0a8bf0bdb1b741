"""Scans, projections, filters, joins, aggregates, order, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators.joins import duplicates_by_hash, first_substring_match
from ..plans.query import Query, sql
from ..sources import sinks, tables
from .base import query


@query("extraction_status", """
SELECT c.c_custkey, c.c_name, count(DISTINCT o.o_orderkey) AS total, count(DISTINCT o.o_orderkey) FILTER (WHERE o.o_orderstatus = 'F') AS completed,
  round(CAST(100.0 * count(DISTINCT o.o_orderkey) FILTER (WHERE o.o_orderstatus = 'F') / nullif(count(DISTINCT o.o_orderkey), 0) AS DECIMAL(18,4)), 2) AS pct
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey, c.c_name""")
def extraction_status(t):
    """A4, J3: distinct counts with a filter over a left join, per cent of it. Order keys are unique, so plain counts do."""
    per = t.orders.groupBy("o_custkey").agg(F.count_distinct("o_orderkey").alias("total"), F.count_distinct(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("completed"))
    joined = t.customer.join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "c_name", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("completed", F.lit(0)).alias("completed"), A.percent(F.col("completed"), F.col("total")).alias("pct"))


@query("src1_scan_project", "SELECT n_nationkey, n_name FROM nation")
def scan_project(t):
    return Query(t.nation).select("n_nationkey", "n_name").frame()


@query("src2_sql_params", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000.0")
def sql_params(t):
    t.orders.createOrReplaceTempView("orders")
    return sql(t.spark, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = :status AND o_totalprice > :least", status="F", least=1000.0)


@query("src4_table_function", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey = 3 AND c_acctbal >= 0")
def table_function(t):
    """A stored function as a table: a SQL table function."""
    t.customer.createOrReplaceTempView("customer")
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION customers_of(nation INT, least DOUBLE) RETURNS TABLE (c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE) RETURN SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey = nation AND c_acctbal >= least")
    return sql(t.spark, "SELECT * FROM customers_of(:nation, :least)", nation=3, least=0.0)


@query("src5_by_id", "SELECT * FROM supplier WHERE s_suppkey = 7")
def by_id(t):
    return tables.by_id(t.supplier, "s_suppkey", 7)


@query("src9_page_range", "SELECT conv_id, turn, text FROM conversations WHERE turn BETWEEN 1 AND 2")
def page_range(t):
    return tables.pages_between(t.conversations, 1, 2, "turn").select("conv_id", "turn", "text")


@query("src10_page_chunks", """
SELECT conv_id, turn // 2 AS chunk, count(*) AS n_pages, string_agg(text, chr(10) ORDER BY turn, text) AS text FROM conversations GROUP BY conv_id, turn // 2""")
def page_chunks(t):
    return tables.page_chunks(t.conversations, "conv_id", "turn", "text", 2)


@query("src8_document_text", """
SELECT conv_id, string_agg('--- Page ' || turn || ' ---' || chr(10) || coalesce(text, ''), chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id""")
def document_text(t):
    return tables.document_text(t.conversations, "conv_id", "turn", "text")


@query("src14_file_type", """
SELECT page_id, CASE WHEN upper(hex(encode(substr(html, 1, 8)))) LIKE '3C21%' OR upper(hex(encode(substr(html, 1, 8)))) LIKE '3C68%' OR upper(hex(encode(substr(html, 1, 8)))) LIKE '3C48%' THEN 'html' ELSE 'unknown' END AS file_type FROM pages""")
def file_type(t):
    return t.pages.select("page_id", tables.file_type(F.col("html").cast("binary")).alias("file_type"))


@query("src15_prompts", "SELECT part.p_partkey, 'Describe ' || p_name || ' of ' || p_brand || '.' AS prompt FROM part")
def prompts(t):
    return t.part.select("p_partkey", tables.render_prompt("Describe {{ name }} of {{brand}}.", name=F.col("p_name"), brand=F.col("p_brand")).alias("prompt"))


@query("src16_listing", "SELECT doc_id, source FROM documents WHERE lang = 'de'")
def listing(t):
    return tables.listing(t.documents, "de", "lang").select("doc_id", "source")


@query("src13_json_schema")
def json_schema(t):
    return t.spark.createDataFrame([(tables.infer_json_schema(t.spark, t.events, "props"), tables.required_fields(t.events, "props"))], "schema string, required array<string>")


@query("f1_comparisons", """
SELECT p_partkey, p_size FROM part WHERE p_size >= 10 AND p_size < 40 AND p_size <> 20 AND p_retailprice > 900 AND p_size <= 39""")
def comparisons(t):
    return Query(t.part).where("p_size", ">=", 10).where("p_size", "<", 40).where("p_size", "!=", 20).where("p_retailprice", ">", 900).where("p_size", "<=", 39).select("p_partkey", "p_size").frame()


@query("f2_like", "SELECT p_partkey, p_name, p_type FROM part WHERE p_name LIKE '%a%' AND p_type ILIKE '%econ%'")
def like(t):
    return Query(t.part).where("p_name", "like", "%a%").where("p_type", "ilike", "%ECON%").select("p_partkey", "p_name", "p_type").frame()


@query("f3_in", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O'")
def isin(t):
    return Query(t.orders).where_in("o_orderpriority", ["1-URGENT", "2-HIGH"]).where_in("o_orderstatus", "O").select("o_orderkey").frame()


@query("f4_between", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity BETWEEN 10 AND 12")
def between(t):
    return Query(t.lineitem).where_between("l_quantity", 10, 12).select("l_orderkey", "l_linenumber").frame()


@query("f5_nulls", "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL AND d.text IS NOT NULL")
def nulls(t):
    labels = t.labels.select(F.col("doc_id").alias("l_doc"), "quality")
    return Query(t.documents).join(labels, "doc_id = l_doc", "left").where_null("quality").where_not_null("text").select("doc_id").frame()


@query("f7_equals_null", "SELECT c_custkey FROM customer WHERE c_name = NULL")
def equals_null(t):
    return Query(t.customer).where("c_name", "=", None).select("c_custkey").frame()


@query("f8_json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') = '7'")
def json_field(t):
    k = F.get_json_object("props", "$.k")
    return Query(t.events).matching(k == "7").select("event_id", k.cast("long").alias("k")).frame()


@query("f9_recent", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOUR")
def recent(t):
    return t.events.where(F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-30 00:00:00' - INTERVAL 24 HOURS")).select("event_id", "ts")


@query("f10_row_security", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def row_security(t):
    """The view of a role that sees completed rows alone."""
    views = {"service": F.lit(True), "anonymous": F.col("o_orderstatus") == "F"}
    return t.orders.where(views["anonymous"]).select("o_orderkey", "o_orderstatus")


@query("f12_item_subset", "SELECT p_partkey, p_size FROM part WHERE p_size IN (5, 6, 7, 19, 20, 21)")
def item_subset(t):
    return t.part.where(F.col("p_size").isin(5, 6, 7, 19, 20, 21)).select("p_partkey", "p_size")


@query("f13_keywords", "SELECT doc_id FROM documents WHERE contains(lower(text), 'worthless') OR contains(lower(text), 'idiot')")
def keywords(t):
    from ..functions.text import contains_any

    return t.documents.where(contains_any(F.lower("text"), ("worthless", "idiot"))).select("doc_id")


@query("j2_inner_join", "SELECT n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")
def inner_join(t):
    return Query(t.nation).join(t.region, "n_regionkey = r_regionkey").select("n_name", "r_name").frame()


@query("j3_left_fanout", "SELECT c.c_custkey, count(*) AS n_rows FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY 1")
def left_fanout(t):
    """A left join's fan-out counts a row for those without any."""
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return t.customer.join(per, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(1)).alias("n_rows"))


@query("j4_exists", "SELECT s_suppkey, EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'R') AS returned FROM supplier")
def exists(t):
    hit = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("k")).distinct().withColumn("hit", F.lit(True))
    return t.supplier.join(hit, F.col("s_suppkey") == F.col("k"), "left").select("s_suppkey", F.coalesce("hit", F.lit(False)).alias("returned"))


@query("j5_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti(t):
    return t.customer.join(t.orders.where("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("j6_first_substring", """
WITH m AS (SELECT p.p_partkey, r.r_regionkey, r.r_name FROM part p JOIN region r ON contains(lower(p.p_name), lower(substr(r.r_name, 1, 1))) OR contains(p.p_name, CAST(r.r_regionkey AS VARCHAR)))
SELECT p.p_partkey, m.r_name AS first_region FROM part p LEFT JOIN (SELECT p_partkey, min_by(r_name, r_regionkey) AS r_name FROM m GROUP BY 1) m USING (p_partkey)""")
def first_substring(t):
    lookup = t.region.select("r_regionkey", "r_name", F.substring("r_name", 1, 1).alias("letter"))
    out = first_substring_match(t.part, F.col("p_name"), lookup, "letter", "r_regionkey", "r_regionkey", "p_partkey")
    return out.select("p_partkey", F.col("r_name").alias("first_region"))


@query("j11_lookup", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'processing' END AS state FROM orders")
def lookup(t):
    states = F.create_map(*[F.lit(x) for kv in {"F": "completed", "O": "pending", "P": "processing"}.items() for x in kv])
    return t.orders.select("o_orderkey", F.try_element_at(states, "o_orderstatus").alias("state"))


@query("j14_hash_duplicates", """
WITH d AS (SELECT doc_id, lang, sha256(text) AS digest FROM documents), k AS (SELECT * FROM d WHERE doc_id % 2 = 0), r AS (SELECT * FROM d WHERE doc_id % 2 = 1)
SELECT r.doc_id, coalesce((SELECT min(k.doc_id) FROM k WHERE k.digest = r.digest AND k.lang = r.lang), (SELECT min(k.doc_id) FROM k WHERE k.digest = r.digest)) AS duplicate_of FROM r""")
def hash_duplicates(t):
    """Odd ids are the arriving documents here, even ones the known: two sides of one table."""
    d = t.documents.select("doc_id", "lang", F.sha2("text", 256).alias("digest"))
    found = duplicates_by_hash(d.where("doc_id % 2 = 1"), d.where("doc_id % 2 = 0"), digest="digest", scope="lang", known_id="doc_id")
    return found.select("doc_id", "duplicate_of")


@query("a1_count", "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def count(t):
    return Query(t.orders).where("o_orderstatus", "=", "F").limit(1).counted()


@query("a2_count_distinct", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def count_distinct(t):
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("a3_filtered_counts", """
SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS completed, count(*) FILTER (WHERE o_orderstatus = 'O') AS pending FROM orders""")
def filtered_counts(t):
    s = F.col("o_orderstatus")
    return t.orders.agg(F.count(F.lit(1)).alias("total"), F.count_if(s == "F").alias("completed"), F.count_if(s == "O").alias("pending"))


@query("a5_average", "SELECT event_type, round(CAST(avg(value) AS DECIMAL(24,6)), 4) AS mean FROM events GROUP BY 1")
def average(t):
    return t.events.groupBy("event_type").agg(F.round(F.avg("value").cast("decimal(24,6)"), 4).alias("mean"))


@query("a6_having", """
SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS quantity FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 100""")
def having(t):
    g = t.lineitem.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(28,2)").alias("quantity"))
    return g.where("n > 100")


@query("a7_duplicate_groups", """
SELECT sha256(text) AS digest, count(*) AS n, array_to_string(list_sort(list(doc_id)), ',') AS ids FROM documents GROUP BY 1 HAVING count(*) > 1""")
def duplicate_groups(t):
    d = t.documents.groupBy(F.sha2("text", 256).alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("doc_id")).alias("ids"))
    return d.where("n > 1").select("digest", "n", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query("a8_distinct_values", "SELECT event_type, array_to_string(list_sort(list(DISTINCT CAST(json_extract_string(props, '$.k') AS INT))), ',') AS ks FROM events GROUP BY 1")
def distinct_values(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.groupBy("event_type").agg(F.array_join(F.array_sort(F.collect_set(k)).cast("array<string>"), ",").alias("ks"))


@query("a9_summary", """
SELECT count(*) AS suppliers, count(*) FILTER (WHERE s_acctbal < 0) AS in_debt,
 count(*) FILTER (WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'R')) AS with_returns FROM supplier""")
def summary(t):
    hit = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("s_suppkey")).distinct().withColumn("hit", F.lit(True))
    return t.supplier.join(hit, "s_suppkey", "left").agg(F.count(F.lit(1)).alias("suppliers"), F.count_if(F.col("s_acctbal") < 0).alias("in_debt"), F.count_if("hit").alias("with_returns"))


@query("a10_scalar_subqueries", "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM documents) AS documents, (SELECT max(o_orderdate) FROM orders) AS last_order")
def scalar_subqueries(t):
    for n in ("orders", "customer", "documents"):
        getattr(t, n).createOrReplaceTempView(n)
    return sql(t.spark, "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM documents) AS documents, (SELECT max(o_orderdate) FROM orders) AS last_order")


@query("a11_category_breakdown", "SELECT p_brand, CAST(sum(CAST(coalesce(p_retailprice, 0) AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS low, count(*) AS n FROM part GROUP BY 1")
def category_breakdown(t):
    return t.part.groupBy("p_brand").agg(F.sum(F.coalesce("p_retailprice", F.lit(0)).cast("decimal(18,2)")).cast("decimal(28,2)").alias("low"), F.count(F.lit(1)).alias("n"))


_NATION_YEAR = """nation_year AS (SELECT n.n_nationkey, n.n_name, n.n_regionkey, year(o.o_orderdate) AS y, sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS revenue
 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2, 3, 4)"""


def nation_year(t):
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return o.groupBy("n_nationkey", "n_name", "n_regionkey", F.year("o_orderdate").alias("y")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"))


@query("a14_latest_totals", f"WITH {_NATION_YEAR} SELECT n_nationkey, y, CAST(revenue AS DECIMAL(28,2)) AS revenue FROM nation_year WHERE y = (SELECT max(y) FROM nation_year)")
def latest_totals(t):
    ny = nation_year(t)
    return ny.join(F.broadcast(ny.agg(F.max("y").alias("y"))), "y", "left_semi").select("n_nationkey", "y", F.col("revenue").cast("decimal(28,2)").alias("revenue"))


@query("a15_concentration", f"""WITH {_NATION_YEAR}, p AS (SELECT n_regionkey, n_nationkey, sum(revenue) AS v FROM nation_year GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY v DESC, n_nationkey) AS k FROM p)
 SELECT n_regionkey, round(CAST(CAST(sum(v) FILTER (WHERE k <= 2) AS DOUBLE) * 100.0 / CAST(sum(v) AS DOUBLE) AS DECIMAL(18,4)), 2) AS top_share, count(*) FILTER (WHERE v > 0) AS present FROM r GROUP BY 1""")
def concentration(t):
    ny = nation_year(t).withColumn("revenue", F.col("revenue").cast("decimal(28,2)"))
    v = ny.groupBy("n_regionkey", "n_nationkey").agg(F.sum("revenue").cast("double").alias("v"))
    return A.concentration(v, ["n_regionkey"], "n_nationkey", "v", k=2)


@query("a16_growth", f"""WITH {_NATION_YEAR}, g AS (SELECT n_nationkey, min(y) AS first_year, max(y) AS last_year, CAST(min_by(revenue, y) AS DOUBLE) AS first_value, CAST(max_by(revenue, y) AS DOUBLE) AS last_value FROM nation_year GROUP BY 1)
 SELECT n_nationkey, CAST(first_year AS INT) AS first_year, CAST(last_year AS INT) AS last_year, first_value, last_value, round(CAST(last_value / first_value - 1 AS DECIMAL(24,8)), 4) AS growth,
 CASE WHEN last_year > first_year AND first_value > 0 THEN round(CAST(pow(last_value / first_value, 1.0 / (last_year - first_year)) - 1 AS DECIMAL(24,8)), 4) END AS cagr FROM g""")
def growth(t):
    return A.growth(nation_year(t).withColumn("revenue", F.col("revenue").cast("double")), ["n_nationkey"], "y", "revenue")


@query("a17_attempt_metrics", """
SELECT event_type, count(*) AS attempts, count(*) FILTER (WHERE value > 20) AS successes, round(CAST(CAST(count(*) FILTER (WHERE value > 20) AS DOUBLE) / count(*) AS DECIMAL(18,6)), 4) AS success_rate,
 round(CAST(avg(value) AS DECIMAL(24,6)), 4) AS avg_duration, round(CAST(avg(user_id) FILTER (WHERE value > 20) AS DECIMAL(24,6)), 4) AS avg_tokens FROM events GROUP BY 1""")
def attempt_metrics(t):
    return A.attempt_metrics(t.events, ["event_type"], F.col("value") > 20, "value", "user_id")


@query("a18_top_messages", "SELECT lower(trim(p_type)) AS message, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_messages(t):
    return A.top_messages(t.part, "p_type")


@query("a19_percentiles", """
WITH r AS (SELECT event_type, value AS v, row_number() OVER (PARTITION BY event_type ORDER BY value) AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL),
q AS (SELECT *, greatest(1, least(floor((n + 1) * 0.5), n - 1)) AS a50, greatest(1, least(floor((n + 1) * 0.9), n - 1)) AS a90, greatest(1, least(floor((n + 1) * 0.95), n - 1)) AS a95, greatest(1, least(floor((n + 1) * 0.99), n - 1)) AS a99 FROM r),
m AS (SELECT event_type, max(n) AS n, max(v) FILTER (k = a50) AS l50, max(v) FILTER (k = a50 + 1) AS h50, max((n + 1) * 0.5 - a50) AS f50, max(v) FILTER (k = a90) AS l90, max(v) FILTER (k = a90 + 1) AS h90, max((n + 1) * 0.9 - a90) AS f90,
 max(v) FILTER (k = a95) AS l95, max(v) FILTER (k = a95 + 1) AS h95, max((n + 1) * 0.95 - a95) AS f95, max(v) FILTER (k = a99) AS l99, max(v) FILTER (k = a99 + 1) AS h99, max((n + 1) * 0.99 - a99) AS f99 FROM q GROUP BY 1)
SELECT event_type, n, round(CAST(l50 + (h50 - l50) * f50 AS DECIMAL(24,6)), 3) AS p50, round(CAST(CASE WHEN n >= 10 THEN l90 + (h90 - l90) * f90 ELSE 0 END AS DECIMAL(24,6)), 3) AS p90,
 round(CAST(CASE WHEN n >= 20 THEN l95 + (h95 - l95) * f95 ELSE 0 END AS DECIMAL(24,6)), 3) AS p95, round(CAST(CASE WHEN n >= 100 THEN l99 + (h99 - l99) * f99 ELSE 0 END AS DECIMAL(24,6)), 3) AS p99 FROM m""")
def percentiles(t):
    p = A.exclusive_percentiles(t.events, ["event_type"], "value")
    return p.select("event_type", "n", *[F.round(F.col(c).cast("decimal(24,6)"), 3).alias(c) for c in ("p50", "p90", "p95", "p99")])


@query("a20_duration_range", "SELECT user_id, min(value) AS least, max(value) AS most, round(CAST(avg(value) AS DECIMAL(24,6)), 4) AS mean FROM events GROUP BY 1")
def duration_range(t):
    return t.events.groupBy("user_id").agg(F.min("value").alias("least"), F.max("value").alias("most"), F.round(F.avg("value").cast("decimal(24,6)"), 4).alias("mean"))


@query("a21_peak_hour", """
WITH h AS (SELECT event_type, CAST(hour(ts) AS INT) AS h, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, h) AS k FROM h)
SELECT event_type, h AS peak_hour, n FROM r WHERE k = 1""")
def peak_hour(t):
    h = t.events.groupBy("event_type", F.hour("ts").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    best = h.groupBy("event_type").agg(F.max_by(F.struct("h", "n"), F.struct("n", -F.col("h"))).alias("b"))
    return best.select("event_type", F.col("b.h").alias("peak_hour"), F.col("b.n").alias("n"))


@query("a22_hourly_trend", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(24,6))) AS DECIMAL(34,6)) AS total FROM events GROUP BY 1, 2")
def hourly_trend(t):
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("hour")
    return t.events.groupBy(hour, "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(24,6)")).cast("decimal(34,6)").alias("total"))


@query("a23_value_counts", "SELECT lang AS value, count(*) AS n, round(CAST(count(*) * 100.0 / (SELECT count(*) FROM documents) AS DECIMAL(18,4)), 2) AS pct FROM documents GROUP BY 1")
def value_counts(t):
    return A.value_counts(t.documents, "lang")


@query("a23_null_profile", """
WITH d AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT 'doc_id' AS column_name, count(*) AS n_rows, count(*) FILTER (doc_id IS NULL) AS n_null, round(CAST(100.0 * count(*) FILTER (doc_id IS NULL) / count(*) AS DECIMAL(18,4)), 2) AS pct_null FROM d
UNION ALL SELECT 'quality', count(*), count(*) FILTER (quality IS NULL), round(CAST(100.0 * count(*) FILTER (quality IS NULL) / count(*) AS DECIMAL(18,4)), 2) FROM d""")
def null_profile(t):
    return A.null_profile(t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality"))


@query("a27_rates", """
SELECT round(CAST(100.0 * count(*) FILTER (WHERE event_type = 'error') / greatest(count(*), 1) AS DECIMAL(18,4)), 2) AS error_rate,
 round(CAST(count(*) / 24.0 AS DECIMAL(18,4)), 2) AS per_hour FROM events WHERE ts >= TIMESTAMP '2024-01-29 00:00:00'""")
def rates(t):
    day = t.events.where(F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-29 00:00:00'"))
    n = F.count(F.lit(1))
    return day.agg(F.coalesce(A.percent(F.count_if(F.col("event_type") == "error"), n), F.lit(0).cast("decimal(18,2)")).alias("error_rate"), F.round((n / 24.0).cast("decimal(18,4)"), 2).alias("per_hour"))


@query("a28_table_statistics")
def table_statistics(t):
    return A.table_statistics(t.orders, "orders", f"{t.folder}/orders.parquet")


@query("a29_entity_summary", """
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS states, CAST(max(year(o_orderdate)) AS INT) AS latest, CAST(max(year(o_orderdate)) - min(year(o_orderdate)) + 1 AS INT) AS years FROM orders GROUP BY 1""")
def entity_summary(t):
    y = F.year("o_orderdate")
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("states"), F.max(y).alias("latest"), (F.max(y) - F.min(y) + 1).alias("years"))


@query("o1_order_nulls", "SELECT doc_id, quality FROM (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)) ORDER BY quality ASC NULLS LAST, doc_id DESC LIMIT 50")
def order_nulls(t):
    return Query(t.documents.join(t.labels, "doc_id", "left")).order_by("quality", ("doc_id", "desc")).limit(50).select("doc_id", "quality").frame()


@query("o2_limit_offset", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5")
def limit_offset(t):
    return Query(t.orders).order_by(("o_totalprice", "desc"), "o_orderkey").offset(5).limit(10).select("o_orderkey").frame()


@query("o4_page", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 50")
def page(t):
    return Query(t.orders).order_by("o_orderkey").select("o_orderkey", "o_custkey").page(3, 25)


@query("o4_page_info", "SELECT 3 AS page, 25 AS page_size, count(*) AS total, CAST(ceil(count(*) / 25.0) AS BIGINT) AS pages, 3 < ceil(count(*) / 25.0) AS has_next, true AS has_prev FROM orders")
def page_info(t):
    return Query(t.orders).page_info(3, 25)


@query("u1_array_union", "SELECT l_orderkey, array_to_string(list_sort(list_distinct(list_concat(list(l_returnflag), list(l_linestatus)))), ',') AS flags FROM lineitem GROUP BY 1")
def array_union(t):
    g = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("a"), F.collect_set("l_linestatus").alias("b"))
    return g.select("l_orderkey", F.array_join(F.array_sort(F.array_union("a", "b")), ",").alias("flags"))


@query("u2_missing_items", "SELECT l_orderkey, array_to_string(list_filter([1,2,3,4,5,6,7], lambda x: NOT list_contains(list(l_linenumber), x)), ',') AS missing FROM lineitem GROUP BY 1")
def missing_items(t):
    g = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("there"))
    wanted = F.array(*[F.lit(i) for i in range(1, 8)])
    return g.select("l_orderkey", F.array_join(F.array_sort(F.array_except(wanted, "there")).cast("array<string>"), ",").alias("missing"))


@query("u4_concat", "SELECT c_custkey AS id, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier")
def concat(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind")).unionByName(t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind")))


@query("snk2_upsert", """
WITH u AS (SELECT c_custkey, c_name || '!' AS c_name, c_nationkey, CAST(0 AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 10 = 0
 UNION ALL SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 100 = 1)
SELECT * FROM u UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM u)""")
def upsert(t):
    c = t.customer
    first = c.where("c_custkey % 10 = 0").withColumn("c_acctbal", F.lit(1.0)).withColumn("seq", F.lit(1))
    last = c.where("c_custkey % 10 = 0").withColumns({"c_name": F.concat("c_name", F.lit("!")), "c_acctbal": F.lit(0.0), "seq": F.lit(2)})
    new = c.where("c_custkey % 100 = 1").withColumns({"c_custkey": F.col("c_custkey") + 1000000, "seq": F.lit(3)})
    return sinks.upserted(c, first.unionByName(last).unionByName(new), ["c_custkey"], "seq")


@query("snk3_update", "SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 0 ELSE s_acctbal END AS s_acctbal FROM supplier")
def update(t):
    return sinks.updated(t.supplier, F.col("s_acctbal") < 0, {"s_acctbal": F.lit(0.0)}).select("s_suppkey", "s_acctbal")


@query("snk4_delete", "SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49)")
def delete(t):
    return sinks.deleted(t.supplier, t.lineitem.where("l_returnflag = 'R' and l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey")), "s_suppkey").select("s_suppkey")


@query("snk6_content_cache", """
WITH f AS (SELECT doc_id, sha256(text) AS sha256, n_chars AS size, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (doc_id % 2000) AS cached_at FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY cached_at DESC, size DESC) AS k FROM f),
l AS (SELECT * FROM n WHERE k = 1 AND cached_at >= TIMESTAMP '2024-02-10' - INTERVAL 30 DAY),
s AS (SELECT *, sum(size) OVER (ORDER BY cached_at DESC, sha256) AS running, sum(size) OVER () AS total FROM l)
SELECT sha256, size, cached_at FROM s WHERE total <= 500000 OR running <= 450000""")
def content_cache(t):
    at = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, cast(doc_id % 2000 as int), 0, 0)").alias("cached_at")
    files = t.documents.select("doc_id", F.sha2("text", 256).alias("sha256"), F.col("n_chars").alias("size"), at)
    return sinks.content_cache(files, as_of=F.expr("TIMESTAMP_NTZ '2024-02-10 00:00:00'"), most_bytes=500_000).select("sha256", "size", "cached_at")


@query("snk7_routed_facts", "SELECT event_id, CAST(event_id % 3 + 5 AS INT) AS item_no, CASE event_id % 3 WHEN 0 THEN 'initial_fees' ELSE 'other_fees' END AS target, 0 AS fact_no, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS fact FROM events WHERE event_id % 3 < 2")
def routed_facts(t):
    rows = t.events.select("event_id", (F.col("event_id") % 3 + 5).cast("int").alias("item_no"), F.concat(F.lit('{"fees":['), F.get_json_object("props", "$.k"), F.lit("]}")).alias("payload"))
    return sinks.exploded_facts(rows, "event_id", "payload", {5: ("initial_fees", "fees"), 6: ("other_fees", "fees")})
