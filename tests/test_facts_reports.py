"""Facts, reports, text matching and connectors on small fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from docweave.operators import facts, reports, rules as R, text_match
from docweave.sources import connectors


def test_initial_fees(spark):
    schema = "id int, initial_franchise_fee_cents long, additional_fees array<struct<fee_name:string,amount_cents:bigint>>, additional_unit_fee_cents long"
    df = spark.createDataFrame([(1, 100, [("Tech", 5), ("Site", None)], 40), (2, 7, None, 0), (3, None, [], None)], schema)
    got = sorted((r.id, r.fact_no, r.fee_name, r.amount_cents) for r in facts.initial_fees(df, ["id"]).collect())
    assert got == [(1, 0, "Initial Franchise Fee", 100), (1, 1, "Tech", 5), (1, 2, "Site", None), (1, 3, "Additional Unit Fee", 40), (2, 0, "Initial Franchise Fee", 7), (3, 0, "Initial Franchise Fee", None)]


def test_other_fees(spark):
    schema = "id int, royalty_percentage double, royalty_basis string, marketing_fee_percentage double, marketing_fee_cents long, other_fees array<struct<fee_name:string,amount_cents:bigint,amount_percentage:double>>"
    df = spark.createDataFrame([(1, 6.0, "Gross", None, 300, [("X", 1, None)]), (2, None, None, 2.0, 9, None), (3, None, None, None, None, None)], schema)
    got = [(r.id, r.fee_name, r.amount_cents, r.amount_percentage, r.calculation_basis) for r in facts.other_fees(df, ["id"]).orderBy("id", "fact_no").collect()]
    assert got == [(1, "Royalty Fee", None, 6.0, "Gross"), (1, "Marketing/Advertising Fee", 300, None, None), (1, "X", 1, None, None), (2, "Marketing/Advertising Fee", None, 2.0, "Gross Sales")]


def test_totals_and_discounts(spark):
    items = spark.createDataFrame([("a", 10, 20, None, None), ("a", 5, None, None, None), ("b", 10, 20, 300, 20), ("c", 0, 0, None, None)], "k string, low_cents long, high_cents long, stated_low long, stated_high long")
    got = {r.k: (r.total_low, r.total_high, r.totals_match) for r in facts.investment_totals(items, ["k"]).collect()}
    assert got == {"a": (15, 20, True), "b": (300, 20, False), "c": (None, None, True)}
    d = spark.createDataFrame([([("Vet", None, 10.0), ("vet", 5, None)],), ([],), (None,)], "d array<struct<kind:string,amount_cents:bigint,percentage:double>>")
    assert [r[0] for r in d.select(facts.discounted(F.lit(1000).cast("long"), F.col("d"), "VET")).collect()] == [900, 1000, 1000]
    e = spark.createDataFrame([([1, None, 2],), (None,)], "x array<bigint>")
    assert [r[0] for r in e.select(facts.minimum_total(F.lit(5).cast("long"), F.col("x"))).collect()] == [8, 5]


def test_financial_health(spark):
    schema = "e string, fiscal_year int, revenue_cents long, net_income_cents long, current_assets_cents long, current_liabilities_cents long, liabilities_cents long, equity_cents long"
    df = spark.createDataFrame([("good", 2022, 100, 1, 1, 1, 1, 1), ("good", 2023, 150, 30, 30, 10, 1, 10), ("bad", 2022, 100, 1, 1, 1, 1, 1), ("bad", 2023, 50, -5, 1, 10, 30, 10), ("none", 2023, None, None, None, None, None, None)], schema)
    got = {r.e: r for r in reports.financial_health(df, "e").collect()}
    assert (got["good"].overall, got["bad"].overall, got["none"].overall) == ("Good", "Concerning", "Mixed")
    assert got["good"].indicators == ["Strong revenue growth", "Strong profitability", "Strong liquidity", "Conservative capital structure"]
    assert "High leverage" in got["bad"].indicators and float(got["bad"].revenue_growth) == -50.0


def test_recommendations(spark):
    scores = spark.createDataFrame([("a", 50.0, 25.0, 3.0), ("b", 79.0, 15.0, 1.0), ("c", 95.0, 50.0, 9.0)], "entity_type string, quality_score double, bypass_rate double, avg_errors double")
    patterns = spark.createDataFrame([(f"f{i}", "HIGH", i) for i in range(8)] + [("z", "LOW", 99)], "field_name string, severity string, frequency int")
    got = sorted(map(tuple, reports.recommendations(scores, patterns).collect()))
    assert got == sorted([("HIGH_BYPASS_RATE", "a", "HIGH"), ("HIGH_BYPASS_RATE", "b", "MEDIUM"), ("HIGH_ERROR_RATE", "a", "HIGH"), *[("FREQUENT_ERROR", f"f{i}", "HIGH") for i in range(3, 8)]])


def slow_tfidf(texts, headings):
    """The same by dictionaries: all grams, no limit of features."""
    import re
    from collections import Counter

    def grams(t):
        w = [x for x in re.findall(r"\b\w\w+\b", t.lower()) if x not in text_match.STOP_WORDS]
        return Counter(" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))

    h = [grams(x) for x in headings]
    idf = {g: math.log((1 + len(h)) / (1 + sum(g in x for x in h))) + 1 for g in set().union(*h)}

    def vector(c):
        v = {g: n * idf[g] for g, n in c.items() if g in idf}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {g: x / size for g, x in v.items()}

    hv = [vector(x) for x in h]
    return {(i, j): s for i, t in enumerate(texts) for j, v in enumerate(hv) if (s := sum(x * v[g] for g, x in vector(grams(t)).items() if g in v)) > 0}


def test_heading_similarity(spark):
    headings = ["Initial franchise fees", "Other fees", "Estimated initial investment", "Financial performance"]
    texts = ["initial fees and other initial franchise fees", "the investment", "nothing shared", ""]
    t = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    h = spark.createDataFrame(list(enumerate(headings)), "item long, heading string")
    got = {(r["text"], r.heading): r.similarity for r in text_match.heading_similarity(t, h, text_id="id", text="text", heading_id="item", heading="heading").collect()}
    want = slow_tfidf(texts, headings)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_providers_are_asked_in_turn(spark):
    def broken(prompt):
        raise OSError

    df = spark.createDataFrame([("x",), (None,)], "prompt string")
    got = connectors.first_answer(df, "prompt", {"a": connectors.remote(broken), "b": connectors.remote(str.upper)}).collect()
    assert sorted(map(tuple, got), key=str) == [("x", "X", "b"), (None, None, None)]


def test_routing_and_uploads(spark):
    df = spark.createDataFrame([(19, 10), (5, 9000), (5, 10)], "item int, tokens int")
    assert [r[0] for r in df.select(connectors.model_for(F.col("item"), F.col("tokens"))).collect()] == ["large", "large", "small"]
    u = spark.createDataFrame([("a.pdf", 1, "MN", "2024-01-01"), ("a.doc", 2**30, "XX", "soon"), (None, None, None, None)], "n string, s long, src string, d string")
    assert [len(r[0]) for r in u.select(connectors.upload_problems(F.col("n"), F.col("s"), F.col("src"), F.col("d"))).collect()] == [0, 4, 3]


def test_rule_sets(spark):
    row = spark.createDataFrame([(1, 0.9, True, None, 5, 100, 10, 30, 20, 15)], "id int, extraction_confidence double, has_fpr boolean, disclaimers string, units_included int, total_units int, bottom_quartile_cents int, median_cents int, top_quartile_cents int, average_cents int")
    assert sorted(r.rule for r in R.findings(row, "id", R.extraction_rules("item19")).collect()) == ["low_coverage", "no_disclaimers", "quartile_order"]
    inv = spark.createDataFrame([(1, 0.5, ["Working Capital"], 10, 5)], "id int, extraction_confidence double, categories array<string>, total_low_cents int, total_high_cents int")
    assert sorted(r.rule for r in R.findings(inv, "id", R.extraction_rules("item7")).collect()) == ["low_confidence", "missing_initial_franchise_fee", "total_reversed"]
