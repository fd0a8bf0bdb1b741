"""HTML, sections and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import segments
from ..session import scratch_path
from ..plans import policies, workflow
from ..sources import connectors, html, listing, pdf, sinks, table_functions
from ..streaming import metrics, monitor, upserts
from .base import query


@query("src6_html_titles", r"""
SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM pages""")
def html_titles(t):
    return t.pages.select("page_id", html.title_of("html").alias("title"))


@query("src7_html_links")
def html_links(t):
    return html.links_of(t.pages.select("page_id", "html", "url"), base="url").select("page_id", "link_no", "href", "link_text")


@query("src6_html_tables")
def html_tables(t):
    made = t.nation.select("n_nationkey", F.concat(F.lit("<table><tr><th>Name</th><th>Key</th></tr><tr><td>"), F.col("n_name"), F.lit("</td><td>"), F.col("n_nationkey").cast("string"), F.lit("</td></tr></table>")).alias("html"))
    return html.tables_of(made)


@query("src6_page_grids", r"""
WITH l AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav><ul>(.*?)</ul>', 1), '<li><a [^>]*>([^<]*)</a></li>', 1) AS cells FROM pages)
SELECT page_id, 0 AS table_no, r.r AS row_no, replace(replace(replace(replace(replace(array_to_string(cells, ' / '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS cells FROM l, (VALUES (0), (1)) r(r) WHERE len(cells) > 0""")
def page_grids(t):
    """The pages' lists read as tables: cells that span two rows, that nothing ends, in tables that nothing ends."""
    changed = F.col("html")
    for old, new in (("<ul>", "<table><tr>"), ("</ul>", "</tr>"), ("<li>", "<td rowspan='2'>"), ("</li>", "")):
        changed = F.replace(changed, F.lit(old), F.lit(new))
    found = html.tables_of(t.pages.select("page_id", changed.alias("html")), first_only=True)
    return found.select("page_id", "table_no", F.posexplode("rows").alias("row_no", "row")).select("page_id", "table_no", "row_no", F.array_join("row", " / ").alias("cells"))


@query("src8_pdf_pages", r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents)
SELECT doc_id, CAST(n // 50 + 1 AS INT) AS page_no, string_agg(line, chr(10) ORDER BY n) AS text FROM l GROUP BY doc_id, n // 50""")
def pdf_pages(t):
    """Every document as a PDF file of 50 lines a page, and the text of each page read back from it."""
    files = t.documents.where("text is not null").select("doc_id", pdf.files_of(F.col("text")).alias("content"))
    return pdf.page_texts(files, keep=("doc_id",)).select("doc_id", "page_no", "text")


def _pages(t):
    """Conversations as documents, turns as pages: each a heading of its own and its whole text."""
    c = t.conversations
    total = c.groupBy(F.col("conv_id").alias("doc_id")).agg((F.max("turn") + 1).cast("int").alias("total_pages"))
    page = c.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page"), "role", "text")
    # what headings read like: numbered, plain, misspelt, or within other words, by page
    names = F.array(*map(F.lit, segments.HEADINGS))
    name = F.get(names, F.pmod(F.col("doc_id") + F.col("page"), F.lit(25)).cast("int"))
    heading = F.when(F.col("page") % 4 == 0, F.concat(F.lit("ITEM "), F.col("page").cast("string"), F.lit(". "), name)).when(F.col("page") % 4 == 1, F.upper(name)).when(F.col("page") % 4 == 2, F.concat(F.regexp_replace(name, "e", "c"))).otherwise(F.concat(F.lit("Notes on the "), F.lower(name), F.lit(" of this company")))
    blocks = F.array(F.struct(heading.alias("text"), F.when(F.col("role") == "user", "title").otherwise("text").alias("kind")), F.struct(F.col("text"), F.lit("text").alias("kind")))
    return page.select("doc_id", "page", F.inline(blocks)).join(total, "doc_id")


@query("c1_section_candidates")
def section_candidates(t):
    return segments.best_per_page(segments.candidates(_pages(t)))


@query("c2_section_assignment")
def section_assignment(t):
    p = _pages(t)
    found = segments.best_per_page(segments.candidates(p)).join(p.select("doc_id", "total_pages").distinct(), "doc_id")
    return segments.assign(found)


@query("c4_even_fallback", "SELECT conv_id AS doc_id, i AS item_no, CAST(floor(i * (n - 1) / 25.0) + 1 AS INT) AS start_page FROM (SELECT conv_id, CAST(max(turn) + 1 AS INT) AS n FROM conversations GROUP BY 1), range(25) r(i)")
def even_fallback(t):
    docs = t.conversations.groupBy(F.col("conv_id").alias("doc_id")).agg((F.max("turn") + 1).cast("int").alias("total_pages"))
    return segments.even_sections(docs).select("doc_id", F.col("item_no").cast("long").alias("item_no"), "start_page")


@query("c10_resume", "SELECT doc_id FROM documents WHERE doc_id % 4 <> 0")
def resume(t):
    """What a checkpointed job still has to do."""
    return sinks.still_to_do(t.documents.select("doc_id"), t.documents.where("doc_id % 4 = 0"), ["doc_id"])


@query("c7_model_routing", "SELECT doc_id, CASE WHEN doc_id % 25 IN (19, 20, 21) OR length(text) // 4 > 1000 THEN 'large' ELSE 'small' END AS model, CASE WHEN doc_id % 5 = 0 THEN 'second' ELSE 'first' END AS provider, doc_id % 5 = 0 AS asked_again FROM documents")
def model_routing(t):
    """By item and size to a model; the first provider that answers gives the result, and the next is asked for the rest alone."""
    model = connectors.model_for(F.col("doc_id") % 25, F.floor(F.length("text") / 4), limit=1000)
    prompts = t.documents.select("doc_id", model.alias("model"), F.col("doc_id").cast("string").alias("prompt"))
    answered = connectors.first_answer(prompts, "prompt", {"first": connectors.remote(lambda x: None if int(x) % 5 == 0 else "one"), "second": connectors.remote(lambda x: "two")})
    return answered.select("doc_id", "model", "provider", (F.col("answer") == "two").alias("asked_again"))


@query("st1_hourly_stream", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def hourly_stream(t):
    """The stream run to its end over the table's file, in append mode into Parquet; a marker at its end closes the last hours."""
    path, events = _events(t)
    out = metrics.run_to_files(metrics.hourly_counts(events), path)
    return out.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "event_type", "n")


def _events(t):
    """A path of their own, and the events as a stream that ends."""
    path = scratch_path(t.spark, "stream")
    return path, metrics.event_stream(t.spark, t.folder, t.events.schema, end=f"{path}/end", pathGlobFilter="events.parquet", recursiveFileLookup="true")


@query("st2_sliding_means", """
WITH w AS (SELECT time_bucket(INTERVAL '15 minutes', ts) + k * INTERVAL '15 minutes' + INTERVAL '15 minutes' AS until, event_type, value FROM events, range(4) r(k))
SELECT until, event_type, round(CAST(avg(value) AS DECIMAL(24,6)), 3) AS mean FROM w GROUP BY 1, 2""")
def sliding_means(t):
    path, events = _events(t)
    out = metrics.run_to_files(metrics.sliding_means(events), path)
    return out.select(F.col("until").cast("timestamp_ntz").alias("until"), "event_type", F.round(F.col("mean").cast("decimal(24,6)"), 3).alias("mean"))


@query("st3_first_of_content", "SELECT DISTINCT sha256(user_id || event_type) AS sha256 FROM events")
def first_of_content(t):
    path, events = _events(t)
    files = events.where("event_id is not null").withColumn("sha256", F.sha2(F.concat(F.col("user_id").cast("string"), "event_type"), 256))
    return metrics.run_to_files(metrics.first_of_content(files).select("sha256"), path)


@query("st4_failure_runs", """
WITH f AS (SELECT event_type, value > 20 AS failed, row_number() OVER w - row_number() OVER (PARTITION BY event_type, value > 20 ORDER BY ts, event_id) AS run FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
SELECT event_type, 3 AS failures FROM f WHERE failed GROUP BY event_type, run HAVING count(*) >= 3""")
def failure_runs(t):
    path, events = _events(t)
    failed = events.where("event_id is not null").withColumn("failed", F.coalesce(F.col("value") > 20, F.lit(False)))
    return metrics.run_to_files(metrics.consecutive_failures(failed, "event_type", "failed", 3, order=("ts", "event_id")), path)


@query("st5_monitoring", """
WITH e AS (SELECT event_type, ts, event_id, date_trunc('minute', ts) AS minute, coalesce(value > 20, false) AS f FROM events),
r AS (SELECT *, row_number() OVER w - row_number() OVER (PARTITION BY event_type, f ORDER BY ts, event_id) AS part FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
s AS (SELECT *, CASE WHEN f THEN row_number() OVER (PARTITION BY event_type, f, part ORDER BY ts, event_id) ELSE 0 END AS run FROM r),
m AS (SELECT event_type, minute, count(*) AS n, count(*) FILTER (f) AS failed, arg_max(run, (ts, event_id)) AS run, max(run) AS most FROM s GROUP BY 1, 2),
h AS (SELECT *, sum(n) OVER w AS n1, sum(failed) OVER w AS f1, max(most) OVER (PARTITION BY event_type ORDER BY minute) >= 5 AS stopped FROM m WINDOW w AS (PARTITION BY event_type ORDER BY minute RANGE BETWEEN INTERVAL 59 MINUTES PRECEDING AND CURRENT ROW))
SELECT event_type, minute, n, failed, round(f1 / CAST(n1 AS DOUBLE), 6) AS failed_1h, CAST(run AS INT) AS run, CAST(CASE WHEN run = 0 THEN 0 ELSE least(60 * pow(2, least(run, 10) - 1), 300) END AS INT) AS wait_s, stopped FROM h""")
def monitoring(t):
    """Each event type's minutes with failures over the last hour, backoff and stop, as a stream run to its end."""
    path, events = _events(t)
    failed = events.withColumn("failed", F.col("value") > 20)
    with monitor.keyed_state(t.spark):
        out = metrics.run_to_files(monitor.monitored(failed, key="event_type", at="ts", failed="failed", order="event_id"), path)
    return out.select("event_type", F.col("minute").cast("timestamp_ntz").alias("minute"), "n", "failed", F.round("failed_1h", 6).alias("failed_1h"), "run", "wait_s", "stopped")


@query("st6_upserted_stream", """
SELECT user_id, event_type, ts, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k FROM events) WHERE k = 1""")
def upserted_stream(t):
    """Each user's last event of a type, from a stream of three batches into a table of versions, a part an event type."""
    path = scratch_path(t.spark, "upserts")
    rows = t.events.select("user_id", "event_type", "ts", "event_id", "value")
    rows.repartition(3, "event_id").write.parquet(f"{path}/in")
    table = upserts.VersionedTable(t.spark, f"{path}/table", rows.schema, part="event_type")
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    upserts.start(stream, table, f"{path}/checkpoint", keys=["user_id", "event_type"], order="event_id").awaitTermination()
    return table.current()


@query("src4_last_of", """
SELECT user_id, event_type, ts, event_id, n_rows FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, count(*) OVER (PARTITION BY user_id) AS n_rows FROM events) WHERE k = 1""")
def last_of(t):
    """A table function over a table dealt out by user: its schema follows its argument."""
    table_functions.register(t.spark)
    t.events.select("user_id", "event_type", "ts", "event_id").createOrReplaceTempView("docweave_events")
    return t.spark.sql("SELECT * FROM last_of(TABLE(docweave_events) PARTITION BY user_id ORDER BY (ts, event_id))")


@query("src4_json_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM events")
def json_fields(t):
    table_functions.register(t.spark)
    t.events.select("event_id", "props").createOrReplaceTempView("docweave_props")
    return t.spark.sql("SELECT event_id, f.* FROM docweave_props, LATERAL json_fields(props, 'k long, absent string') f")


@query("f10_row_policies", """
SELECT 'service_role' AS role, o_orderkey, o_orderstatus, o_orderpriority FROM orders UNION ALL SELECT 'authenticated', o_orderkey, o_orderstatus, substr(o_orderpriority, 1, 1) FROM orders UNION ALL SELECT 'anon', o_orderkey, o_orderstatus, NULL FROM orders WHERE o_orderstatus = 'F'""")
def row_policies(t):
    """Three roles' rows of one table, with a column masked for two of them; the policies are a table."""
    rows = [("orders", "service_role", "all", "true", None), ("orders", "authenticated", "select", "true", {"o_orderpriority": "substring(o_orderpriority, 1, 1)"}), ("orders", "anon", "select", "o_orderstatus = 'F'", {"o_orderpriority": "NULL"})]
    known = policies.read(t.spark.createDataFrame(rows, policies.SCHEMA))
    policies.secured(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), "docweave_orders", known, "orders")
    seen = []
    for role in ("service_role", "authenticated", "anon"):
        policies.use_role(t.spark, role)
        seen.append(t.spark.table("docweave_orders").select(F.lit(role).alias("role"), "*"))
    policies.use_role(t.spark, policies.NOBODY)
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@query("src16_folder_listing", "SELECT DISTINCT 'lang=' || lang || '/source=' || source AS folder, 'text/csv' AS mime_type FROM documents WHERE lang = 'de'")
def folder_listing(t):
    """Documents written a file a language and source, and the files of one language listed: folder and kind are pushed into the listing."""
    path = scratch_path(t.spark, "listing")
    d = t.documents.select("lang", "source", "doc_id")
    d.repartition("lang", "source").write.partitionBy("lang", "source").csv(path)
    found = listing.scan(t.spark, path).where(F.col("folder").startswith("lang=de/") & (F.col("mime_type") == "text/csv"))
    return found.select("folder", "mime_type")


@query("c10_workflow", """
WITH l AS (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem WHERE l_quantity >= 10 GROUP BY 1)
SELECT o_custkey, count(*) AS orders, CAST(sum(quantity) AS DOUBLE) AS quantity FROM l JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def resumed_workflow(t):
    """Three stages; the run breaks off in the last one, and the next run does that one alone."""
    done = []

    def large(lines, least):
        done.append("large")
        return lines.where(F.col("l_quantity") >= least)

    def by_order(lines):
        done.append("by_order")
        return lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))

    def by_customer(totals, orders):
        done.append("by_customer")
        if done.count("by_customer") == 1:
            raise RuntimeError("broken off")
        return totals.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("quantity").cast("double").alias("quantity"))

    flow = workflow.Workflow(t.spark, scratch_path(t.spark, "workflow"))
    sources = {name: f"{t.folder}/{name}.parquet" for name in ("lineitem", "orders")}
    stages = [workflow.Stage("large", large, ("lineitem",), {"least": 10}), workflow.Stage("by_order", by_order, ("large",)), workflow.Stage("by_customer", by_customer, ("by_order", "orders"))]
    out = flow.run(sources, stages)["by_customer"]
    if done != ["large", "by_order", "by_customer", "by_customer"]:
        raise RuntimeError(f"stages ran as {done}")
    return out
