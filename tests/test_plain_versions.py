"""Registered queries that no SQL expresses, on whole small tables against plain Python."""

import json
import os
import re
import subprocess
import sys
from pathlib import Path

import pandas as pd
import pytest

from docweave.catalog import ORACLES, QUERIES
from docweave.functions import text as T
from docweave.functions.fuzzy import partial
from docweave.functions.udfs import similarity
from docweave.operators import segments as G


@pytest.fixture(scope="module")
def read(sf_dir):
    return lambda name: pd.read_parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="module")
def got(spark, sf_dir):
    return lambda name: [r.asDict(recursive=True) for r in QUERIES[name](spark, sf_dir).collect()]


def test_state_codes(got, read):
    def code(text):
        for x in (text, text.upper()):
            for found in re.findall(r"\b([A-Z]{2})\b", x):
                if found in T.STATES_51:
                    return found

    docs = read("documents")
    assert {r["doc_id"]: r["state"] for r in got("t5_state_code")} == {i: code(t) for i, t in zip(docs["doc_id"], docs["text"])}


def nation_variants(read):
    names = set()
    for name, key in zip(read("nation")["n_name"], read("nation")["n_nationkey"]):
        n, k = " ".join(w.capitalize() for w in name.split(" ")), key % 3 + 2
        names |= {n, f"{n} Holdings Inc.", n[:k] + n[k + 1 :], f"{n[:k]}e{n[k:]}", f"Great {n}", f"{n[:k]} {n[k:]}"}
    return sorted(names)


def test_fuzzy_names(got, read):
    names, want = nation_variants(read), {}
    for a in names:
        near = sorted(((-round(s, 3), b) for b in names if b != a and (s := similarity(a, b)) >= 0.85))
        want |= {(a, b): i + 1 for i, (_, b) in enumerate(near[:10])}
    assert len(want) > 100 and {(r["name"], r["candidate"]): r["rank"] for r in got("j7_fuzzy_names")} == want


def test_resolution(got, read):
    known = dict(zip(read("nation")["n_name"], read("nation")["n_nationkey"]))
    want = set()
    for name, key in known.items():
        x = name if key % 3 == 0 else f"{name} Holdings" if key % 3 == 1 else "zz" + name[::-1]
        best = max(((similarity(x, k), k) for k in known), key=lambda s: s)
        want.add((x, known.get(x, known[best[1]] if best[0] >= 0.95 else None), "exact" if x in known else "fuzzy" if best[0] >= 0.95 else "new"))
    assert {(r["name"], r["id"], r["resolution"]) for r in got("j13_resolution")} == want


def test_links(got, read):
    from urllib.parse import urljoin

    pages = read("pages")
    want = {}
    for i, url, page in zip(pages["page_id"], pages["url"], pages["html"]):
        for k, (href, text) in enumerate(re.findall(r'<a [^>]*?href="([^"]*)"[^>]*>(.*?)</a>', page or "", re.S)):
            want[i, k] = urljoin(url, href.replace("&amp;", "&"))
    assert want and {(r["page_id"], r["link_no"]): r["href"] for r in got("src7_html_links")} == want


def test_tables(got, read):
    want = {k: (["Name", "Key"], [[n, str(k)]]) for n, k in zip(read("nation")["n_name"], read("nation")["n_nationkey"])}
    assert {r["n_nationkey"]: (r["headers"], r["rows"]) for r in got("src6_html_tables")} == want


def test_json_schema(got, read):
    keys = [set(json.loads(p)) for p in read("events")["props"]]
    (row,) = got("src13_json_schema")
    assert row["required"] == sorted(set.intersection(*keys)) and all(k in row["schema"] for k in set.union(*keys))


def test_fuzzy_headings(got, read):
    from .test_fuzzy import plain

    found = {r["line"]: (r["item_no"], r["score"]) for r in got("t20_fuzzy_headings")}
    lines = {x for t in read("documents")["text"] if t for x in t.split("\n") if 5 <= len(x) <= 200}
    assert found.keys() == {x for x in lines if not any(p in x.lower() for p in G.BOILERPLATE)} and len(found) > 50
    for line in sorted(found, key=lambda x: (len(x), x))[:12] + sorted(found)[::40][:4]:  # the quadratic definition takes a second a line
        best = max(((i, plain(line.lower(), h.lower())) for i, standard in enumerate(G.HEADINGS) for h in dict.fromkeys([standard, *G.OTHER_HEADINGS.get(i, [])])), key=lambda s: s[1])
        assert found[line] == (best[0], pytest.approx(best[1]))


def test_heading_similarity(got, read):
    from collections import Counter
    from math import log, sqrt

    from docweave.operators.text_match import STOP_WORDS

    texts = dict(zip(read("benchmark")["item_id"], read("benchmark")["text"]))

    def grams(t):
        w = [x for x in re.findall(r"\b(\w\w+)\b", t.lower()) if x not in STOP_WORDS]
        return Counter(" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))

    of = {i: grams(t) for i, t in texts.items()}
    total, df = Counter(), Counter()
    for g in of.values():
        total.update(g)
        df.update(g.keys())
    kept = {g: log((1 + len(of)) / (1 + df[g])) + 1 for g, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:1000]}

    def vector(g):
        v = {k: n * kept[k] for k, n in g.items() if k in kept}
        n = sqrt(sum(x * x for x in v.values()))
        return {k: x / n for k, x in v.items()}

    of = {i: vector(g) for i, g in of.items()}
    want = {(a, b): s for a in of for b in of if (s := sum(x * of[b].get(k, 0) for k, x in of[a].items())) >= 0.5}
    found = {(r["item_id"], r["heading"]): float(r["similarity"]) for r in got("t21_heading_similarity")}
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k], abs=1e-5) for k in want)


def heading_of(text):
    if not 5 <= len(text) <= 200 or any(p in text.lower() for p in G.BOILERPLATE):
        return None
    return max(((i, partial(text.lower(), h.lower())) for i, standard in enumerate(G.HEADINGS) for h in dict.fromkeys([standard, *G.OTHER_HEADINGS.get(i, [])])), key=lambda s: s[1])


def test_section_candidates(spark):
    """Each of the generators on blocks made for it; what looks like running text has none."""
    blocks = [
        ("d", 1, "ITEM 5: INITIAL FEES", "title"), ("d", 2, "see Item 6. Other Fees", "text"), ("d", 3, "BUSINESS EXPERIENCF", "text"), ("d", 4, "notes on the estimated initial investment of this", "text"),
        ("d", 9, "LITIGATION", "text"), ("d", 5, "THIS DISCLOSURE DOCUMENT: TERRITORY", "text"), ("d", 6, "x" * 300, "text"), ("d", 7, None, "text"), ("d", 8, "", None),
    ]
    df = spark.createDataFrame([(*b, 10) for b in blocks], "doc_id string, page int, text string, kind string, total_pages int")
    found = {(r.page, r.method): (r.item_no, r.confidence) for r in G.candidates(df).collect()}
    assert found[1, "title"] == (5, 0.95) and (1, "pattern") not in found
    assert found[2, "pattern"] == (6, 0.8)
    for page in (3,):
        item, score = heading_of(blocks[page - 1][2])
        assert found[page, "fuzzy"] == (item, pytest.approx(score / 100)) and item == 2
    assert found[4, "cosine"][0] == 7 and found[4, "cosine"][1] >= 0.5
    assert not {p for p, _ in found} & {6, 7, 8}
    assert (9, "fuzzy") not in found and (9, "cosine") not in found  # in the last fifth
    assert (5, "fuzzy") not in found  # boilerplate
    with pytest.raises(ValueError):
        G.candidates(df, spark.range(G.MOST_HEADINGS + 1).selectExpr("1 as item_no", "'h' as heading"))


def test_registered_sections(got, read):
    c = read("conversations")
    total = (c.groupby("conv_id")["turn"].max() + 1).to_dict()
    candidates = got("c1_section_candidates")
    fuzzy = 0
    for conv, turn in zip(c["conv_id"], c["turn"]):
        page = turn + 1
        name = G.HEADINGS[(conv + page) % 25]
        mine = {(r["item_no"], r["method"]): r["confidence"] for r in candidates if (r["doc_id"], r["page"]) == (conv, page)}
        if page % 4 == 0 and page <= 24:
            assert any(i == page for i, _ in mine)
        if page % 4 == 1 and page <= max(1, int(total[conv] * 0.8)):
            item, score = heading_of(name.upper())
            assert any(i == item for i, _ in mine)
            fuzzy += 1
    assert fuzzy > 10
    starts = {}
    for r in got("c2_section_assignment"):
        starts.setdefault(r["doc_id"], []).append((r["item_no"], r["start_page"]))
    for conv, found in starts.items():
        pages = [p for _, p in sorted(found)]
        assert pages == sorted(pages) and pages[0] == 1 and all(1 <= p <= total[conv] for p in pages)


def test_repaired_sections(got, read):
    want = set()
    for conv, rows in read("conversations").groupby("conv_id"):
        parts = sorted((int(t) % 25, int(t) + 1) for t in rows["turn"])
        for (item, _), start in zip(parts, G.repaired_starts([p for _, p in parts], [i for i, _ in parts], 40)):
            want.add((conv, item, start))
    assert {(r["doc_id"], r["item_no"], r["start_page"]) for r in got("c3_repaired_sections")} == want


def test_merged_entities(got, read):
    c = read("customer")
    groups = {}
    for i, name, segment, balance in zip(c["c_custkey"], c["c_name"], c["c_mktsegment"], c["c_acctbal"]):
        groups.setdefault(i % 100, []).append((i, name, segment, segment if balance > 0 else None))
    want = {}
    for rows in groups.values():
        rows.sort()
        want[rows[0][0]] = (rows[0][1], sorted({r[2] for r in rows} | {r[1] for r in rows[1:]}), next((r[3] for r in rows if r[3]), None))
    assert {r["id"]: (r["canonical_name"], r["dba_names"], r["parent"]) for r in got("c5_merge_entities")} == want


def test_cleaned_table(got, read):
    c = read("customer")
    want = {str(i): None if b < 0 else b for i, b in zip(c["c_custkey"], c["c_acctbal"])}
    rows = got("r6_table_cleaning")
    assert {str(int(r["id"])): r["balance"] for r in rows} == want
    assert set(rows[0]) == {"id", "balance", "filing_date"} and {str(r["filing_date"]) for r in rows} == {"2023-12-31"}


def test_table_statistics(got, read):
    rows = got("a28_table_statistics")
    assert {r["column_name"] for r in rows} == set(read("orders").columns) and {(r["table_name"], r["n_rows"]) for r in rows} == {("orders", len(read("orders")))}


def test_embeddings(got, read):
    import zlib

    for r in got("udf_embedding"):
        (name,) = read("nation").loc[read("nation")["n_nationkey"] == r["n_nationkey"], "n_name"]
        hashes = [zlib.crc32(w.encode()) for w in name.lower().split()]
        assert len(r["embedding"]) == 384 and {i for i, x in enumerate(r["embedding"]) if x} <= {h % 384 for h in hashes}
        assert sum(x * x for x in r["embedding"]) == pytest.approx(1, abs=1e-5)


def test_every_query_without_sql_has_a_plain_version():
    source = Path(__file__).read_text() + (Path(__file__).parent / "test_facts_reports.py").read_text()
    tested_elsewhere = {"v21_financial_health"}
    assert {q for q in QUERIES if q not in ORACLES and q not in source} <= tested_elsewhere


def test_functions_reach_executors_from_another_folder(tmp_path, sf_dir):
    """A session started elsewhere, whose workers can't import this package."""
    root = Path(__file__).resolve().parents[1]
    script = f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as e
for name in ("src7_html_links", "c3_repaired_sections", "j7_fuzzy_names", "udf_embedding", "t20_fuzzy_headings", "udf_remote_answers", "st4_failure_runs", "c1_section_candidates"):
    print(name, e.queries()[name](spark, {sf_dir!r}).count() > 0)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.count("True") == 8, done.stderr[-2000:]
