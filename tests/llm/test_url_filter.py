"""The cascade against plain rules."""

import random

from pyspark.sql import functions as F

from docweave.llm import url_filter as U
from docweave.llm.queries import RULES


def slow(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, path = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.key), r.host.count("."), r.action), default=None)
    return host, path, best.key if best else None, best.action if best else "allow"


URLS = [None, "", "no scheme/com/en/", "http://EXAMPLE.com/en/7#x", "https://example.com/en/8?q=/en/7", "ftp://a.example.net/de/8", "http://net/de/", "http://xnet/de/1", "http://org", "http://org/es/?", "://com/en/", "http://a://b.com/en/", "http://É.com/en/\nx", "http://com/en", "http://notexample.com/en/7"]


def judged(spark, urls, rules, **kw):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    return [(r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(df, rules, **kw).orderBy("page_id").collect()]


def test_against_plain_rules(spark):
    want = [slow(u, RULES) for u in URLS]
    assert judged(spark, URLS, RULES) == want
    assert judged(spark, URLS, RULES, max_keys=2) == want  # by join
    assert judged(spark, [], RULES) == []
    assert judged(spark, URLS, []) == [(*slow(u, [])[:2], None, "allow") for u in URLS]


def test_many_rules(spark):
    rng = random.Random(0)
    label = lambda: rng.choice("abcd")
    rules = [U.Rule(rng.choice(["block", "allow"]), ".".join(label() for _ in range(rng.randint(1, 3))), "/" + label() * rng.randint(0, 2)) for _ in range(120)]
    urls = [f"http://{'.'.join(label() for _ in range(rng.randint(1, 4)))}/{label()}{label()}{label()}" for _ in range(400)]
    assert judged(spark, urls, rules) == [slow(u, rules) for u in urls]


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where("key % 7 = 0")
    c = U.build_cascade(listed, universe)
    assert len(c.levels) > 1
    wrong = universe.where(c.listed(F.col("key")) != (F.col("key") % 7 == 0))
    assert wrong.count() == 0
    assert U.build_cascade(listed.limit(0), universe).levels == ()


def test_plan_has_neither_python_nor_join(spark, sf_dir):
    df = U.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), RULES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan and "ReadSchema: struct<page_id:bigint,url:string>" in plan
