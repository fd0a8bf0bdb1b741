"""Roles over one table: rows, masks, pushed filters, refusals."""

import pytest
from pyspark.sql import functions as F

from docweave.plans import policies as P


@pytest.fixture
def table(spark, tmp_path):
    spark.createDataFrame([(1, "a", "completed"), (2, "b", "failed"), (3, "c", None)], "id int, secret string, status string").write.parquet(f"{tmp_path}/t")
    yield spark.read.parquet(f"{tmp_path}/t")
    P.use_role(spark, P.NOBODY)


def seen(spark, view, role):
    P.use_role(spark, role)
    return sorted(tuple(r) for r in spark.table(view).collect())


def test_three_roles(spark, table):
    P.secured(table, "papers", P.standard("papers", "status = 'completed'"))
    assert seen(spark, "papers", "service_role") == seen(spark, "papers", "authenticated") == [(1, "a", "completed"), (2, "b", "failed"), (3, "c", None)]
    assert seen(spark, "papers", "anon") == [(1, "a", "completed")]  # a null predicate leaves a row out
    assert seen(spark, "papers", P.NOBODY) == seen(spark, "papers", "x' OR true --") == []
    mine = P.standard("papers")
    assert P.allowed(mine, "papers", "service_role", "delete") and not P.allowed(mine, "papers", "authenticated", "insert") and not P.allowed(mine, "other", "service_role", "select")
    with pytest.raises(ValueError, match="no command"):
        P.allowed(mine, "papers", "anon", "drop")


def test_filters_reach_the_scan(spark, table):
    """With the role's value folded, its predicate alone is pushed down, and nothing is left for the service."""
    P.secured(table, "papers", P.standard("papers", "status = 'completed'"))
    plan = lambda: spark.table("papers")._jdf.queryExecution().executedPlan().toString()
    P.use_role(spark, "anon")
    kept = spark.table("papers")
    assert "EqualTo(status,completed)" in plan()
    P.use_role(spark, "service_role")
    assert ") Filter " not in plan() and "PushedFilters: []" in plan()
    assert kept.count() == 1  # planned for the other role
    P.use_role(spark, "nobody")
    assert "LocalTableScan <empty>" in plan() or "FileScan" not in plan()


def test_policies_from_a_table(spark, table):
    """Alternatives of a role, masks, null predicates, roles with odd names."""
    rows = [("papers", "o'neil\\", "select", "id = 1", {"secret": "upper(secret)"}), ("papers", "o'neil\\", "select", "id = 3", {"secret": "'?'"}), ("papers", "b", "all", None, None), ("others", "b", "all", "true", None), ("papers", None, "all", "true", None)]
    known = P.read(spark.createDataFrame(rows, P.SCHEMA))
    P.secured(table, "papers_2", known, "papers")
    assert seen(spark, "papers_2", "o'neil\\") == [(1, "A", "completed"), (3, "C", None)]
    assert seen(spark, "papers_2", "b") == []
    with pytest.raises(ValueError, match="aren't there"):
        P.secured(table, "papers_3", [P.Policy("papers_3", "a", masks={"none": "1"})])
    assert spark.table("papers_2").where(F.col("id") == 1).count() == 0
