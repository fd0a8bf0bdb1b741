"""Listings of folder trees: pages, pushed filters, partitions, streams, files that are gone."""

import os

import pytest
from pyspark.sql import functions as F

from docweave.sources import listing as L


@pytest.fixture
def root(tmp_path, monkeypatch):
    for name in ("a.pdf", "x/b.pdf", "x/c.csv", "x/y/d.pdf", "x/y/e", "z/.hidden", "_temporary/f.pdf"):
        (tmp_path / "r" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "r" / name).write_text(name)
    (tmp_path / "r" / "empty").mkdir()
    return f"{tmp_path}/r"


ALL = {"a.pdf": "", "x/b.pdf": "x", "x/c.csv": "x", "x/y/d.pdf": "x/y", "x/y/e": "x/y"}


def test_pages(root):
    """Tokens lead through a folder whatever a page's size; a filter makes pages short, not fewer."""
    tree = L.Tree(root)
    assert list(L.all_folders(tree)) == ["", "empty", "x", "x/y", "z"]
    for size in (1, 2, 3):
        names, token = [], None
        while True:
            rows, token = tree.page("x", token, None, size)
            names += [r[2] for r in rows]
            if token is None:
                break
        assert names == ["b.pdf", "c.csv"]
    assert tree.page("x", None, ["text/csv"], 1) == ([], "b.pdf")
    with pytest.raises(L.NotFound):
        tree.page("gone", None)
    assert list(L.files_of(tree, "gone")) == []


def test_scan_and_pushed_filters(spark, root):
    got = L.scan(spark, root)
    assert {r["id"]: r["folder"] for r in got.collect()} == ALL and got.where("size <> length(id)").count() == 0
    assert {r["id"] for r in L.scan(spark, root, "x/y").collect()} == {"x/y/d.pdf", "x/y/e"}
    some = got.where((F.col("mime_type") == "application/pdf") & F.col("folder").startswith("x") & (F.col("size") > 5))
    assert sorted(r["id"] for r in some.collect()) == ["x/b.pdf", "x/y/d.pdf"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "size" in plan.split("Filter")[1] and "mime_type" not in plan.split("Filter")[1].split("\n")[0]  # only the size is left to Spark
    reader = L.ListingReader({"path": root})
    left = list(reader.pushFilters([L.EqualTo(("mime_type",), "text/csv"), L.In(("folder",), ("x", "z")), L.EqualTo(("name",), "c.csv")]))
    assert left == [L.EqualTo(("name",), "c.csv")] and [p.names for p in reader.partitions()] == [("x",), ("z",)]
    assert [r[0] for p in reader.partitions() for r in reader.read(p)] == ["x/c.csv"]
    assert got.where("mime_type = 'text/csv' AND mime_type = 'application/pdf'").count() == 0


def test_stream_remembers_its_offset(spark, root, tmp_path):
    for k, name in enumerate(ALL):
        os.utime(f"{root}/{name}", (1_700_000_000 + k // 2, 1_700_000_000 + k // 2))
    out, state = f"file://{tmp_path}/out", f"file://{tmp_path}/state"

    def run():
        L.stream(spark, root).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        return sorted(r["id"] for r in spark.read.schema(L.SCHEMA).parquet(out).collect())

    assert run() == sorted(ALL)
    assert run() == sorted(ALL)  # nothing new
    for name in ("x/new.csv", "x/same.csv"):
        with open(f"{root}/{name}", "w") as f:
            f.write("new")
    os.utime(f"{root}/x/same.csv", (1_700_000_002, 1_700_000_002))  # of the last moment that was seen
    assert run() == sorted([*ALL, "x/new.csv", "x/same.csv"])


def test_fresh_metadata(spark, root):
    ids = spark.createDataFrame([("x/b.pdf",), ("gone",), (None,), ("x",), ("a.pdf",)], "id string")
    assert sorted(r["id"] for r in L.fresh_metadata(ids, root).collect()) == ["a.pdf", "x/b.pdf"]
    assert L.fresh_metadata(ids.limit(0), root).collect() == []
