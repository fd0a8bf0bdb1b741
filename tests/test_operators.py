"""Operators on small fixtures, with their edge cases."""

import statistics

import pytest
from pyspark.sql import functions as F

from docweave.operators import aggregates as A
from docweave.operators import entity as E
from docweave.operators import joins as J
from docweave.operators import rules as R
from docweave.operators import segments as G
from docweave.operators import windows as W
from docweave.plans.query import Query, condition
from docweave.sources import html, sinks, tables


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "ann", 3.0), (2, "bob", None), (3, None, 1.0)], "id long, name string, v double")


def test_builder_filters_and_order(people):
    q = Query(people)
    assert rows(q.where("v", ">=", 1).frame(), "id") == [(1,), (3,)]
    assert q.where("name", "=", None).count() == 0
    assert q.where_in("id", []).count() == 0
    assert q.limit(0).frame().count() == 0
    assert q.limit(1).count() == 3
    assert [r.id for r in q.order_by("name").frame().collect()] == [1, 2, 3]
    assert [r.id for r in q.order_by(("v", "desc")).frame().collect()] == [2, 1, 3]
    assert q.order_by("id").page(2, 2).first().id == 3
    info = q.page_info(2, 2).first()
    assert (info.total, info.pages, info.has_next, info.has_prev) == (3, 2, False, True)
    with pytest.raises(ValueError):
        condition("id", "~", 1)


def test_filters_reach_the_scan(spark, sf_dir):
    df = Query(spark.read.parquet(f"{sf_dir}/orders.parquet")).where("o_orderstatus", "=", "F").select("o_orderkey").frame()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_exclusive_percentiles(spark):
    data = [float(x * x % 101) for x in range(150)]
    got = A.exclusive_percentiles(spark.createDataFrame([("a", x) for x in data] + [("b", 5.0)], "k string, v double"), ["k"], "v")
    by = {r.k: r for r in got.collect()}
    want = statistics.quantiles(data, n=100)
    assert [by["a"].p50, by["a"].p90, by["a"].p95, by["a"].p99] == pytest.approx([want[49], want[89], want[94], want[98]])
    assert (by["b"].p50, by["b"].p90) == (5.0, 0.0)


def test_first_substring_match(spark):
    names = spark.createDataFrame([(1, "FDD Acme 2024.pdf"), (2, "other.pdf")], "id int, key string")
    known = spark.createDataFrame([(0, "", ""), (1, "acme", "77"), (2, "fdd", "")], "pos int, name string, number string")
    got = J.first_substring_match(names, F.col("key"), known, "name", "number", "pos", "id")
    assert rows(got, "id", "pos") == [(1, 1), (2, None)]


def test_sides_beyond_the_bound_are_taken_in_parts(spark, monkeypatch):
    import random

    rng = random.Random(0)
    v = spark.createDataFrame([(i, [rng.random() - 0.5 for _ in range(4)]) for i in range(60)], "id int, e array<double>")
    names = spark.createDataFrame([(i, f"x {i % 13} y{i % 7}") for i in range(40)], "id int, key string")
    known = spark.createDataFrame([(i, f"y{i}", str(i * 3)) for i in range(12)], "pos int, name string, number string")
    ask = lambda: (rows(J.nearest_vectors(v.where("id % 3 = 0"), v, query_id="id", base_id="id", vector="e", k=4), "query", "base", "rank"), rows(J.first_substring_match(names, F.col("key"), known, "name", "number", "pos", "id"), "id", "pos"))
    whole = ask()
    monkeypatch.setattr(J, "SMALL_ROWS", 5)
    assert len(J.parts(known)) == 3 and ask() == whole


def test_token_overlap_is_complete(spark):
    import itertools
    import random

    rng = random.Random(1)
    texts = [(i, " ".join(rng.choices("a b c d e f g h".split(), k=rng.randint(1, 6)))) for i in range(60)] + [(60, ""), (61, None)]
    df = spark.createDataFrame(texts, "id int, t string")
    got = {(r.left, r.right) for r in J.token_overlap(df, df, left_id="id", right_id="id", left_text="t", right_text="t", threshold=0.5).collect()}
    words = {i: set((t or "").split()) for i, t in texts}
    want = {(a, b) for a, b in itertools.product(words, words) if words[a] | words[b] and len(words[a] & words[b]) / len(words[a] | words[b]) >= 0.5}
    assert got == want


def test_clusters_close_long_paths(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in E.clusters(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert E.clusters(edges.limit(0)).count() == 0


def test_merge_entities(spark):
    e = spark.createDataFrame([(1, "Acme", ["A"], None), (2, "Acme Inc", None, "Parent"), (3, "Zeta", [], None)], "id long, canonical_name string, dba_names array<string>, parent string")
    got = E.merge_entities(e, spark.createDataFrame([(2, 1)], "a long, b long"), fill=("parent",))
    assert sorted(map(tuple, got.collect())) == [(1, "Acme", ["A", "Acme Inc"], "Parent"), (3, "Zeta", [], None)]


def test_resolution(spark):
    known = spark.createDataFrame([(1, "Burger King"), (2, "Subway")], "id long, canonical_name string")
    names = spark.createDataFrame([("Burger King",), ("Subway LLC",), ("Nobody",)], "name string")
    m = J.fuzzy_names(names, known, name="name", candidate="canonical_name", threshold=0.9)
    assert rows(J.resolve(names, known, m)) == [("Burger King", 1, "exact"), ("Nobody", None, "new"), ("Subway LLC", 2, "fuzzy")]


def test_continuity_looks_at_adjacent_years_alone(spark):
    df = spark.createDataFrame([("x", 2020, 1, 5), ("x", 2021, 6, 7), ("x", 2023, 1, 2), ("y", 2021, 9, 9)], "k string, y int, s int, e int")
    assert rows(W.continuity(df, ["k"], "y", "s", "e"), "k", "y") == [("x", 2021)]


def test_section_ends_and_flags(spark):
    df = spark.createDataFrame([("d", 0, 1), ("d", 1, 4), ("d", 2, 4)], "doc string, item int, start int")
    ends = W.section_ends(df, "doc", "start", "item", default_last=9)
    assert rows(ends, "item", "end_page") == [(0, 4), (1, 4), (2, 9)]
    flags = W.boundary_flags(ends, "doc", "start", "end_page", "item")
    assert not flags.where("reversed or out_of_order or gap or overlap").count()


def test_rules_and_status(spark):
    df = spark.createDataFrame([(1, 100, 50), (2, 1, 50), (3, None, 50), (4, 10, 20)], "id long, low_cents long, high_cents long")
    found = R.findings(df, "id", R.investment_rules())
    assert rows(found, "id", "rule", "severity") == [(1, "high_below_low", "ERROR"), (2, "wide_range", "INFO")]
    assert rows(R.validated(df, "id", R.investment_rules()), "id", "status") == [(1, "invalid"), (2, "validated"), (3, "validated"), (4, "validated")]
    reg = R.Registry()
    reg.register("x", R.required("low_cents"))
    assert rows(R.findings(df, "id", reg.of("x")), "id") == [(3,)]


def test_standard_rules_cover_the_items(spark):
    assert set(R.standard_rules().rules) == {"item5", "item6", "item7", "item19", "item20", "item21"}


def test_upsert_takes_the_last_change(spark):
    now = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    changes = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "id long, v string, seq int")
    assert rows(sinks.upserted(now, changes, ["id"], "seq")) == [(1, "a"), (2, "y"), (3, "z")]


def test_html(spark):
    page = "<title> A &amp; B </title><a href='/x'>go <b>on</b></a><table><tr><th>H1<th>H2</tr><tr><td>1<br>2</td></tr></table><table><tr><td>q</td></tr></table>"
    got = html.parse_html(page)
    assert got["title"] == "A & B" and got["links"] == [{"href": "/x", "text": "go on"}]
    assert got["tables"] == [{"headers": ["H1", "H2"], "rows": [["1 | 2", None]]}, {"headers": [], "rows": [["q"]]}]
    assert html.parse_html(None) == {"title": None, "links": [], "tables": []}
    df = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    assert rows(html.tables_of(df, first_only=True), "id", "table_no") == [(1, 0)]


def test_clean_table(spark):
    df = spark.createDataFrame([("1", "N/A", " x ", "12/31/2023"), ("2.5", "", None, ""), (None, None, None, None)], "n string, gone string, s string, filing_date string")
    got = html.clean_table(df)
    assert got.dtypes == [("n", "double"), ("s", "string"), ("filing_date", "date")]
    assert got.count() == 2


def test_layout_and_spans(spark):
    from docweave.functions.scalar import span_text

    doc = '{"pdf_info":[{"page_idx":0,"para_blocks":[{"type":"text","lines":[{"spans":[{"content":" a "},{"content":"b"}]}],"blocks":[{"lines":[{"spans":[{"content":"c"}]}]}]}]}]}'
    df = spark.createDataFrame([(1, doc), (2, "{}"), (3, "broken")], "id int, layout string")
    assert rows(tables.layout_pages(df).select("id", "page_idx", span_text("blocks").alias("t"))) == [(1, 0, "a b c")]


def test_assignment_never_goes_back(spark):
    found = spark.createDataFrame(
        [("d", 1, 3, 0.95, "title", 20), ("d", 2, 2, 0.95, "title", 20), ("d", 2, 5, 0.8, "pattern", 20), ("d", 3, 20, 0.95, "title", 20)],
        "doc_id string, item_no int, page int, confidence double, method string, total_pages int",
    )
    got = rows(G.assign(found), "item_no", "start_page")
    assert got == [(0, 1), (1, 3), (2, 5)]
    assert G.repaired_starts([1, 10, 10], [0, 7, 20], 11) == [1, 8, 9]


def test_fallback(spark):
    docs = spark.createDataFrame([("d", 50)], "doc_id string, total_pages int")
    none = G.even_sections(docs).limit(0)
    got = G.with_fallback(none, docs)
    assert got.count() == 25 and got.agg(F.max("start_page")).first()[0] <= 50


def test_fuzzy_names_loses_no_pair(spark):
    """All pairs of a nested loop, at thresholds on either side of the parts' own values."""
    import random

    from docweave.functions.udfs import similarity

    rng = random.Random(3)
    base = ["Burger King", "Subway", "McDonalds", "Homewell Care", "Great American Cookies", "Ace Hardware Stores of America", "Jazz", "Ab", "7 Eleven", "Kumon Math and Reading Centers"]
    names = {"Mcdonalds", "Macdonalds", "Sub Way", "Homwell Care", "Burgerking", "King", "", "Inc.", "The Burger King Company LLC", "Ace", "Reading and Math Kumon Centers", "a", "É"}
    for b in base:
        names.add(b)
        for _ in range(8):
            c = list(b)
            for _ in range(rng.randint(1, 3)):
                i = rng.randrange(len(c) + 1)
                if rng.random() < 0.5:
                    c.insert(i, rng.choice("abc eyx"))
                elif len(c) > 1:
                    del c[min(i, len(c) - 1)]
            names.add("".join(c))
    names = sorted(names)
    df = spark.createDataFrame([(n,) for n in [*names, None, names[0]]], "n string")
    for t in (0.6, 0.85, 0.9, 0.94, 0.95, 0.97, 1.0):
        got = {(r.name, r.candidate): r.similarity for r in J.fuzzy_names(df, df, name="n", candidate="n", threshold=t).collect()}
        want = {(a, b): s for a in names for b in names if (s := similarity(a, b)) >= t}
        assert got.keys() == want.keys(), t
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_linked_tables(spark):
    page = "<table><tr><th>Name</th><th>Doc</th><th>Year</th></tr><tr><td>Acme</td><td><a href='../x/1.pdf'>pdf</a></td><td>2024</td></tr><tr><td>Zeta</td><td>none</td></tr></table>"
    df = spark.createDataFrame([(1, page, "https://h.org/a/b/list"), (2, None, None)], "id int, html string, base string")
    got = html.linked_tables_of(df, "base").collect()
    assert [(r.id, r.headers, r.rows) for r in got] == [(1, ["Name", "Document Link", "Year"], [["Acme", "https://h.org/a/x/1.pdf", "2024"], ["Zeta", "none", None]])]
    links = html.links_of(df, base="base").collect()
    assert [(r.id, r.href, r.link_text) for r in links] == [(1, "https://h.org/a/x/1.pdf", "pdf")]


def test_upsert_keeps_the_last(spark):
    current = spark.createDataFrame([(1, "a"), (2, "z")], "k int, v string")
    changes = spark.createDataFrame([(1, "b"), (1, "c"), (None, "x"), (None, "y"), (3, "n")], "k int, v string").coalesce(1)
    assert rows(sinks.upserted(current, changes, ["k"])) == sorted([(1, "c"), (2, "z"), (3, "n"), (None, "x"), (None, "y")], key=str)
    timed = spark.createDataFrame([(1, "late", 2), (1, "early", 1), (1, "none", None), (2, "one", 5), (2, "two", 5)], "k int, v string, at int").coalesce(1)
    assert rows(sinks.upserted(current, timed, ["k"], order="at")) == [(1, "late"), (2, "two")]


def test_new_content_orphans_and_resume(spark):
    up = spark.createDataFrame([(1, "d1"), (2, "d1"), (3, "d2"), (4, None), (5, None)], "id int, sha256 string").coalesce(1)
    known = spark.createDataFrame([("d2",), (None,)], "sha256 string")
    assert rows(sinks.new_content(up, known)) == [(1, "d1"), (4, None), (5, None)]
    assert rows(sinks.orphans(up, spark.createDataFrame([(1,), (3,)], "id int"), "id"), "id") == [(2,), (4,), (5,)]
    work = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    assert rows(sinks.still_to_do(work, spark.createDataFrame([(1,), (None,)], "id int"), ["id"])) == [(2,), (None,)]


def test_snapshots(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id int")
    for stamp in ("2024-01-01", "2024-01-05", "2024-01-09"):
        sinks.snapshot(spark, df.selectExpr(f"'{stamp}' as stamp"), f"file://{tmp_path}/s", stamp)
    assert sinks.restored(spark, f"file://{tmp_path}/s").first().stamp == "2024-01-09"
    assert sinks.restored(spark, f"file://{tmp_path}/s", "2024-01-05").first().stamp == "2024-01-05"
    assert sinks.remove_expired(spark, f"file://{tmp_path}/s", "2024-01-05") == ["2024-01-01"]
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["2024-01-05", "2024-01-09"]


def test_later_providers_are_asked_for_the_rest(spark, tmp_path):
    from docweave.sources import connectors

    def one(prompt):
        return prompt.upper() if prompt < "c" else None

    def two(prompt):
        with open(f"{tmp_path}/asked", "a") as f:
            f.write(prompt)
        return "two"

    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "p string").coalesce(1)
    got = connectors.first_answer(df, "p", {"one": connectors.remote(one), "two": connectors.remote(two)})
    assert rows(got) == sorted([("a", "A", "one"), ("b", "B", "one"), ("c", "two", "two"), ("d", "two", "two"), (None, None, None)], key=str)
    assert set((tmp_path / "asked").read_text()) == {"c", "d"}


def test_sections_assigned_without_python(spark):
    """Against a plain version of the phases, in one pass of Spark's own functions: a pandas group a document took a tenth of a second each."""
    import random

    from docweave.operators import segments

    rng, rows = random.Random(1), []
    for doc in [None, *range(1, 60)]:
        total = rng.randint(1, 30)
        rows += [(doc, rng.randint(0, 25), rng.randint(1, total + 1), rng.choice([0.5, 0.75, 0.8, 0.95]), rng.choice([*segments.METHODS, "other"]), total) for _ in range(rng.randint(1, 60))]
    want = []
    for doc in {r[0] for r in rows}:
        least = 1
        want.append((doc, 0, 1, "fixed"))
        for item in range(1, segments.ITEMS):
            fits = [(list(segments.METHODS).index(r[4]), -r[3], r[2]) for r in rows if r[0] == doc and r[1] == item and least <= r[2] < r[5] and r[4] in segments.METHODS]
            if fits:
                method, _, least = min(fits)
                want.append((doc, item, least, list(segments.METHODS)[method]))
    found = segments.assign(spark.createDataFrame(rows, "doc_id long, item_no int, page int, confidence double, method string, total_pages int"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert "InPandas" not in found._jdf.queryExecution().toString()


def test_titles_as_they_are_written(spark):
    """A named character without its semicolon stays, as at the end of a title that was cut."""
    pages = ["<title>a &amp;&amp;amp;\n &lt;b&gt; &amp</title>", "<title> x\t y </title><title>z</title>", "<title>a<b></title>", "no title", "", None]
    got = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").select("i", html.title_of("html").alias("t")).collect()
    assert [r["t"] for r in sorted(got)] == ["a &&amp; <b> &amp", "x y", "", "", "", None]


def test_pages_are_read_few_at_a_time(spark, monkeypatch):
    """Neither links nor tables hold more than a few pages' results, and Spark sends a bounded number of pages; as many results as pages."""
    import pandas as pd

    page = "<a href='x'>y</a><table><tr><td>1</td></tr></table>"
    for f, size in ((html.html_links, 1), (html.html_tables, 2)):
        out = list(f.func(iter([pd.Series([page] * 100), pd.Series([None])])))
        assert max(map(len, out)) <= html.PAGES and sum(map(len, out)) == 101
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    df = spark.range(1200).selectExpr("id", f'"{page}" AS html')
    assert html.links_of(df).count() == 1200 and html.tables_of(df).count() == 1200
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= html.PAGES_SENT
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_trailing_means_of_a_full_hour(spark):
    """Null times, null values, ties and both ends of the interval, in doubles and decimals; and running sums, not a frame for each row."""
    import datetime
    import random

    from docweave.operators import windows

    rng, start = random.Random(2), datetime.datetime(2024, 1, 1)
    rows = [(rng.choice("ab"), None if i % 50 == 7 else start + datetime.timedelta(minutes=10 * rng.randint(0, 40)), None if i % 11 == 3 else i % 97) for i in range(600)]
    hour = datetime.timedelta(hours=1)
    df = spark.createDataFrame([(i, k, t, None if v is None else float(v)) for i, (k, t, v) in enumerate(rows)], "i int, k string, t timestamp_ntz, v double")
    for kind in ("double", "decimal(10,2)", "int"):
        found = windows.trailing_mean(df.withColumn("v", F.col("v").cast(kind)), ["k"], "t", "v")
        got = {r["i"]: r["trailing_mean"] for r in found.collect()}
        assert len(got) == len(rows)
        for i, (k, t, _) in enumerate(rows):
            near = [w for l, u, w in rows if l == k and w is not None and (u is None if t is None else u is not None and t - hour <= u <= t)]
            assert (got[i] is None) if not near else float(got[i]) == pytest.approx(sum(near) / len(near), abs=1e-5)
    assert "specifiedwindowframe(RangeFrame, -" not in found._jdf.queryExecution().toString()
