"""Text and scalar functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import text as T
from .base import query

_CLEAN = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(html, '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&quot;', '"'), '&nbsp;', ' '), '[\s\x0B]+', ' ', 'g'))"""


@query("t1_sanitize_filename", r"""
WITH a AS (SELECT page_id, trim(regexp_replace(regexp_replace(url, '[\\/*?:"<>|]', '', 'g'), '\s+', ' ', 'g'), '. ') AS x FROM pages)
SELECT page_id, CASE WHEN x = '' THEN 'unnamed' ELSE rtrim(substr(x, 1, 40)) END AS name FROM a""")
def sanitize(t):
    return t.pages.select("page_id", T.sanitize_filename("url", 40).alias("name"))


@query("t2_clean_text", f"SELECT page_id, {_CLEAN} AS cleaned FROM pages")
def clean(t):
    return t.pages.select("page_id", T.clean_text("html").alias("cleaned"))


#: Names as they may be written, by customer; the same text in both dialects.
_NAMES = """CASE c_custkey % 10 WHEN 0 THEN upper(c_mktsegment) || ', LLC' WHEN 1 THEN 'élan ' || lower(c_mktsegment) || ' café, inc.' WHEN 2 THEN 'SEÑOR  ' || c_mktsegment || ' (of Ohio)' WHEN 3 THEN 'o''neil fdd llc ' || lower(c_mktsegment)
 WHEN 4 THEN '  ' WHEN 5 THEN 'ÉLAN ÜBER ' || c_name || ' L.L.C.' WHEN 6 THEN '日a ' || c_mktsegment || ' corporation' WHEN 7 THEN 'жизнь-ΣΟΦΊΑ ' || c_custkey || 'b (x) (y)' WHEN 8 THEN c_name || ', LLC' END"""


@query("t3_franchise_name", rf"""
WITH n AS (SELECT c_custkey, trim(regexp_replace(coalesce({_NAMES}, ''), '\s+', ' ', 'g')) AS x FROM customer),
y AS (SELECT *, lower(regexp_replace(regexp_replace(x, '(?i)\s*,?\s*(LLC|L\.L\.C\.|Inc\.|INC\.|Corp\.|Corporation)$', ''), '\s*\([^)]*\)$', '')) AS y FROM n),
z AS (SELECT *, array_to_string(list_transform(regexp_extract_all(y, '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+'), lambda p: upper(p[1]) || p[2:]), '') AS z FROM y)
SELECT c_custkey, CASE WHEN x = '' THEN 'Unknown Franchise' ELSE regexp_replace(regexp_replace(z, '\bLlc\b', 'LLC', 'g'), '\bFdd\b', 'FDD', 'g') END AS shown FROM z""")
def franchise_name(t):
    return t.customer.select("c_custkey", T.format_franchise_name(F.expr(_NAMES)).alias("shown"))


@query("t4_filing_number", r"SELECT c_custkey, CASE WHEN regexp_matches(c_name, '#\s*[0-9]{4,}') THEN regexp_extract(c_name, '#\s*([0-9]{4,})', 1) END AS number FROM customer")
def filing_number(t):
    return t.customer.select("c_custkey", T.extract_filing_number("c_name").alias("number"))


@query("t5_state_code")
def state_code(t):
    return t.documents.select("doc_id", T.extract_state_code("text").alias("state"))


@query("t6_year", r"""
SELECT page_id, CASE WHEN regexp_matches(html, '20[0-9]{2}') THEN regexp_extract(html, '20[0-9]{2}') WHEN regexp_matches(html, '''([0-9]{2})|19([0-9]{2})')
 THEN CASE WHEN CAST(right(regexp_extract(html, '''([0-9]{2})|19([0-9]{2})'), 2) AS INT) <= 30 THEN '20' ELSE '19' END || right(regexp_extract(html, '''([0-9]{2})|19([0-9]{2})'), 2) END AS y FROM pages""")
def year(t):
    return t.pages.select("page_id", T.extract_year("html").alias("y"))


@query("t8_document_filename", "SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '_' || o_orderpriority || CASE WHEN o_orderstatus = 'F' THEN '' ELSE '_' || o_orderstatus END || '_#' || o_orderkey || '.pdf' AS name FROM orders")
def document_filename(t):
    kind = F.when(F.col("o_orderstatus") == "F", "FDD").otherwise(F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", T.document_filename(F.col("o_orderpriority"), F.year("o_orderdate"), F.col("o_orderkey"), kind, F.lit(None)).alias("name"))


@query("t9_normalize_url", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN 'https://example.com/a/file' || page_id || '.pdf' ELSE 'https://cdn.example.com/' || page_id END AS url FROM pages")
def normalize_url(t):
    given = F.when(F.col("page_id") % 3 == 0, F.col("url")).when(F.col("page_id") % 3 == 1, F.concat(F.lit("../file"), F.col("page_id").cast("string"), F.lit(".pdf"))).otherwise(F.concat(F.lit("//cdn.example.com/"), F.col("page_id").cast("string")))
    return t.pages.select("page_id", T.normalize_url(given, F.lit("https://example.com/a/b/")).alias("url"))


@query("t10_file_size", "SELECT p_partkey, CAST(trunc(p_size * 1.5 * 1048576) AS BIGINT) AS bytes FROM part")
def file_size(t):
    return t.part.select("p_partkey", T.parse_file_size(F.concat((F.col("p_size") * 1.5).cast("string"), F.lit(" MB"))).alias("bytes"))


@query("t11_name_endings", r"SELECT p_partkey, regexp_replace(trim(regexp_replace(lower(p_name), '\s+', ' ', 'g')), '[^A-Za-z0-9_\s-]', '', 'g') AS name FROM part")
def name_endings(t):
    return t.part.select("p_partkey", T.normalize_name_endings(F.concat("p_name", F.lit(", Inc."))).alias("name"))


_SUFFIX = "|".join(f"\\b({g})" for g in T.SUFFIX_GROUPS).replace("'", "''")


@query("t12_name_suffixes", f"SELECT p_partkey, lower(trim(regexp_replace(regexp_replace(regexp_replace(p_type, '{_SUFFIX}', '', 'gi'), '[^A-Za-z0-9_\\s-]', ' ', 'g'), '[-\\s]+', ' ', 'g'))) AS name FROM part")
def name_suffixes(t):
    return t.part.select("p_partkey", T.normalize_name_suffixes("p_type").alias("name"))


@query("t15_contacts", """
WITH d AS (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 10, '2') AS n FROM customer)
SELECT c_custkey, '(' || substr(n, 1, 3) || ') ' || substr(n, 4, 3) || '-' || substr(n, 7, 4) AS phone, 'https://c' || c_custkey || '.example.com' AS website, true AS mail FROM d""")
def contacts(t):
    key = F.col("c_custkey").cast("string")
    return t.customer.select("c_custkey", T.phone(F.lpad(key, 10, "2")).alias("phone"), T.website(F.concat(F.lit("c"), key, F.lit(".example.com"))).alias("website"), T.is_email(F.concat(key, F.lit("@example.com"))).alias("mail"))


@query("t16_truncate", "SELECT doc_id, CASE WHEN length(text) > 1000 THEN substr(text, 1, 985) || '... [truncated]' ELSE text END AS message FROM documents")
def truncate(t):
    return t.documents.select("doc_id", T.truncate("text", 1000).alias("message"))


@query("t17_item_number", "SELECT p_partkey, CASE WHEN p_size <= 24 THEN p_size END AS item_no FROM part")
def item_number(t):
    return t.part.select("p_partkey", T.item_number(F.concat(F.lit("ITEM "), F.col("p_size").cast("string"), F.lit(": fees"))).alias("item_no"))


#: Lines as documents have them, by part; the same text in both dialects.
_LINES = """CASE p_partkey % 11 WHEN 0 THEN p_type WHEN 1 THEN 'our initial fees and costs for ' || lower(p_type) WHEN 2 THEN 'see item ' || p_size || ' for ' || lower(p_type) WHEN 3 THEN ' ' || p_type WHEN 4 THEN 'Élan Café ' || p_size
 WHEN 5 THEN p_size || '.' WHEN 6 THEN repeat(p_type || ' ', 8) WHEN 7 THEN repeat('the territory of ' || lower(p_type), 3) WHEN 8 THEN 'Élan café' WHEN 9 THEN 'Notes on ' || lower(p_name) WHEN 10 THEN '' END"""


@query("t18_header_like", rf"""
SELECT p_partkey, length(x) <= 150 AND (upper(trim(x)) = x OR regexp_matches(x, '^[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]*[\p{{Lu}}\p{{Lt}}]\p{{Ll}}*([^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+[\p{{Lu}}\p{{Lt}}]\p{{Ll}}*)*[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]*$')
  OR (contains(upper(x), 'ITEM ') AND regexp_matches(x, '[0-9]')) OR (length(x) < 100 AND list_bool_or(list_transform([{", ".join("'" + p.replace("'", "''") + "'" for p in T.HEADER_PHRASES)}], lambda p: contains(upper(x), p))))) AS header
FROM (SELECT p_partkey, {_LINES} AS x FROM part)""")
def header_like(t):
    return t.part.select("p_partkey", T.is_header_like(F.expr(_LINES)).alias("header"))


@query("t19_section_keywords", "SELECT p_partkey, (contains(lower(p_type), 'brass') OR contains(lower(p_type), 'steel')) AND NOT contains(lower(p_type), 'economy') AS hit FROM part")
def section_keywords(t):
    return t.part.select("p_partkey", T.has_keywords("p_type", ("brass", "steel"), ("economy",)).alias("hit"))


_CASES = " ".join(f"WHEN x = '{k}' THEN '{v}'" for k, v in T.CATEGORIES.items()) + " " + " ".join(f"WHEN contains(x, '{k}') OR contains('{k}', x) THEN '{v}'" for k, v in T.CATEGORIES.items())
_SYNONYMS = " ".join(f"WHEN {' OR '.join(f'''contains(x, '{w}')''' for w in ws)} THEN '{T.CATEGORIES[k]}'" for ws, k in T.CATEGORY_SYNONYMS)


@query("t23_category", f"WITH a AS (SELECT p_partkey, p_type, upper(p_type) AS x FROM part) SELECT p_partkey, CASE {_CASES} {_SYNONYMS} ELSE p_type END AS category FROM a")
def category(t):
    return t.part.select("p_partkey", T.standard_category("p_type").alias("category"))


@query("t24_classifiers", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'unqualified' WHEN 1 THEN 'qualified' WHEN 2 THEN 'adverse' END AS opinion, CASE o_orderkey % 4 WHEN 1 THEN 'summary' WHEN 2 THEN 'by_state' ELSE 'other' END AS table_kind,
 CASE o_orderkey % 4 WHEN 0 THEN 'notes' WHEN 1 THEN 'income_statement' WHEN 2 THEN 'balance_sheet' ELSE 'cash_flow' END AS statement FROM orders""")
def classifiers(t):
    k = F.col("o_orderkey") % 4
    opinion = F.when(k == 0, "An Unqualified opinion").when(k == 1, "Qualified").when(k == 2, "adverse opinion").otherwise("none")
    headers = F.when(k == 1, "Fiscal revenue").when(k == 2, "State assets").when(k == 3, "Cash flows").otherwise("")
    return t.orders.select("o_orderkey", T.audit_opinion(opinion).alias("opinion"), T.table_type(headers, F.lit("")).alias("table_kind"), T.statement_type(headers, F.lit("")).alias("statement"))


@query("t25_cache_name", r"SELECT page_id, substr(regexp_replace(url, '[^A-Za-z0-9._\- ]', '', 'g'), 1, 100) AS name FROM pages")
def cache_name(t):
    return t.pages.select("page_id", T.cache_name("url").alias("name"))


@query("x1_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) AS b, CAST(o_orderdate AS DATE) AS c, make_date(2023, 1, 1) AS d FROM orders")
def dates(t):
    fmt = lambda f: S.parse_date(F.date_format(F.col("o_orderdate"), f))
    return t.orders.select("o_orderkey", fmt("MM/dd/yyyy").alias("a"), fmt("MMMM d, yyyy").alias("b"), fmt("dd-MMM-yyyy").alias("c"), S.parse_date(F.lit("Filed in 2023 somewhere")).alias("d"))


@query("x3_money", "SELECT s_suppkey, CAST(round_even(CAST(s_acctbal AS DECIMAL(18,4)) * 100, 0) AS BIGINT) AS cents FROM supplier")
def money(t):
    return t.supplier.select("s_suppkey", S.cents("s_acctbal").alias("cents"))


@query("x4_amounts", "SELECT p_partkey, CAST(p_size * 100 AS BIGINT) AS a, CAST(-p_size * 100 AS BIGINT) AS b, CAST(p_size AS BIGINT) * 100000000 AS c FROM part")
def amounts(t):
    s = F.col("p_size").cast("string")
    return t.part.select("p_partkey", S.parse_amount(F.concat(F.lit("$"), s)).alias("a"), S.parse_amount(F.concat(F.lit("("), s, F.lit(")"))).alias("b"), S.parse_amount(F.concat(s, F.lit(" million"))).alias("c"))


@query("x5_fiscal_year", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y FROM orders")
def fiscal_year(t):
    return t.orders.select("o_orderkey", S.fiscal_year(F.lit("Balance"), F.array(F.lit("item"), F.concat(F.lit("FY "), F.year("o_orderdate").cast("string")))).alias("y"))


@query("x6_ratios", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 AND l_extendedprice <> 0 THEN round(CAST(l_extendedprice / l_quantity AS DECIMAL(24,8)), 4) END AS r FROM lineitem")
def ratios(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_discount") != 0, S.ratio("l_extendedprice", "l_quantity")).alias("r"))


@query("x8_average_cents", "SELECT l_orderkey, l_linenumber, CAST(floor((l_partkey + l_suppkey) / 2.0) AS BIGINT) AS mid FROM lineitem")
def average_cents(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", S.average_cents("l_partkey", "l_suppkey").alias("mid"))


@query("x10_coverage", "SELECT d.doc_id, round(CAST((CASE WHEN l.quality IS NULL THEN 1 ELSE 2 END) * 100.0 / 2 AS DECIMAL(18,4)), 2) AS coverage FROM documents d LEFT JOIN labels l USING (doc_id)")
def coverage(t):
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", S.coverage(["doc_id", "quality"]).alias("coverage"))


@query("x11_section_quality", "SELECT doc_id, CAST(greatest(0.0, least(1.0, 1.0 - 0.3 * (doc_id % 3) - CASE WHEN n_chars < 1024 THEN 0.4 WHEN n_chars < 10240 THEN 0.2 ELSE 0 END)) AS DECIMAL(10,2)) AS score FROM documents")
def section_quality(t):
    return t.documents.select("doc_id", S.section_quality(F.col("doc_id") % 3, "n_chars", F.lit(False), F.lit(False)).cast("decimal(10,2)").alias("score"))


@query("x12_entity_quality", "SELECT s_suppkey, CAST(greatest(0, 100 - least((s_suppkey % 7) * 10, 50) - least((s_suppkey % 20) * 2, 30) - least((s_suppkey % 50) * 0.5, 20)) AS DECIMAL(10,2)) AS score FROM supplier")
def entity_quality(t):
    k = F.col("s_suppkey")
    return t.supplier.select("s_suppkey", S.entity_quality(k % 7, k % 20, k % 50).cast("decimal(10,2)").alias("score"))


@query("x13_tokens", "SELECT doc_id, length(text) // 4 AS tokens, round(CAST((length(text) // 4) * 0.000125 AS DECIMAL(18,6)), 4) AS cost FROM documents")
def tokens(t):
    n = S.tokens_estimate("text")
    return t.documents.select("doc_id", n.alias("tokens"), F.round((n * 0.000125).cast("decimal(18,6)"), 4).alias("cost"))


@query("x14_backoff", "SELECT r_regionkey, least(1.0 * pow(2, r_regionkey * 3), 60.0) AS delay FROM region")
def backoff(t):
    return t.region.select("r_regionkey", S.backoff(F.col("r_regionkey") * 3).alias("delay"))


@query("x15_digests", "SELECT doc_id, sha256(text) AS sha, md5(text) AS md FROM documents")
def digests(t):
    return t.documents.select("doc_id", F.sha2("text", 256).alias("sha"), F.md5("text").alias("md"))


@query("x16_even_pages", "SELECT p_partkey, i AS item_no, CAST(floor(i * (p_size + 24) / 25.0) + 1 AS INT) AS page FROM part, range(25) r(i)")
def even_pages(t):
    pages = S.interpolated_pages(F.col("p_size") + 25)
    return t.part.select("p_partkey", F.posexplode(pages).alias("item_no", "page")).select("p_partkey", F.col("item_no").cast("long").alias("item_no"), "page")


@query("r2_table_cells", "SELECT o_orderkey, 'b' || o_orderkey AS second, 'z' AS last FROM orders")
def table_cells(t):
    headers = F.array(F.lit("year"), F.lit("value"))
    rows = F.array(F.array(F.lit("Total assets"), F.concat(F.lit("b"), F.col("o_orderkey").cast("string"))), F.array(F.lit("other"), F.lit("z")))
    return t.orders.select("o_orderkey", F.get(S.column_values(headers, rows, "value"), F.lit(0)).alias("second"), S.cell_value(rows, "other").alias("last"))


@query("r3_fit_rows", "SELECT n_nationkey, 'a' AS first, CAST(NULL AS VARCHAR) AS third, true AS ragged FROM nation")
def fit_rows(t):
    headers, rows = F.array(F.lit("x"), F.lit("y"), F.lit("z")), F.array(F.array(F.lit("a")), F.array(F.lit("b"), F.lit("c"), F.lit("d"), F.lit("e")))
    fitted = S.fit_rows(headers, rows)
    return t.nation.select("n_nationkey", F.get(F.get(fitted, F.lit(0)), F.lit(0)).alias("first"), F.get(F.get(fitted, F.lit(0)), F.lit(2)).alias("third"), S.is_ragged(headers, rows).alias("ragged"))


@query("r5_json_explode", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) + i AS v FROM events, range(2) r(i)")
def json_explode(t):
    k = F.get_json_object("props", "$.k").cast("long")
    made = F.to_json(F.array(k, k + 1))
    return t.events.select("event_id", F.explode(F.from_json(made, "array<bigint>")).alias("v"))


@query("t22_begins_item", """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size = 0 WHEN 1 THEN p_size BETWEEN 1 AND 23 ELSE p_size = 24 END AS hit FROM part""")
def begins_item(t):
    k = F.col("p_partkey") % 3
    heading = F.when(k == 0, "Table  of contents").when(k == 1, F.concat(F.lit("ITEM "), F.col("p_size").cast("string"), F.lit(": fees"))).otherwise("Exhibit A")
    return t.part.select("p_partkey", T.begins_item(heading, F.col("p_size")).alias("hit"))


@query("x7_outlet_math", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) + l_linenumber - 1 + 2 - 3 AS count_end FROM lineitem")
def outlet_math(t):
    n = S.outlet_math(F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long"), F.lit(1).cast("long"), F.lit(2).cast("long"), F.lit(3).cast("long"))
    return t.lineitem.select("l_orderkey", "l_linenumber", n.alias("count_end"))


@query("r1_span_text", "SELECT o_orderkey, o_orderpriority || ' ' || o_orderstatus AS text FROM orders")
def flattened_spans(t):
    span = lambda c: F.struct(F.concat(F.lit("  "), F.col(c)).alias("content"))
    line = F.struct(F.array(span("o_orderpriority"), span("o_orderstatus")).alias("spans"))
    block = F.struct(F.array(line).alias("lines"), F.array().cast("array<struct<lines:array<struct<spans:array<struct<content:string>>>>>>").alias("blocks"))
    return t.orders.select("o_orderkey", S.span_text(F.array(block)).alias("text"))
