"""The vector index against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.functions.scalar import cosine
from docweave.operators import vector_index as V


def frame(spark, vectors, kind="array<double>"):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], "x") for i, v in enumerate(vectors)], f"id long, v {kind}, block string").repartition(3)


def plain(df, queries, k, threshold=None):
    """By the nested loop with the engine's own cosine."""
    q = queries.select(F.col("id").alias("query"), F.col("v").alias("qv"))
    pairs = df.join(q).select("query", F.col("id").alias("base"), cosine("qv", "v").alias("similarity")).where("similarity is not null and not isnan(similarity)")
    if threshold is not None:
        pairs = pairs.where(F.col("similarity") >= threshold)
    return sorted(map(tuple, V.ranked(pairs, k).select("query", "base", "similarity", "rank").collect()))


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def clustered(n, dim, centres, spread, seed):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    return c[rng.integers(centres, size=n)] + spread * rng.normal(size=(n, dim))


@pytest.mark.parametrize(("spread", "centres", "block_rows", "most"), [(0.05, 20, 20, 0.2), (1.0, 1, 50, 1.0)])
def test_all_rows(spark, spread, centres, block_rows, most):
    """Equal to all pairs with clusters, where few pairs are compared, and without any."""
    df = frame(spark, clustered(900, 8, centres, spread, 1).tolist()).cache()
    index = V.build(df, base_id="id", vector="v", copies=5, block_rows=block_rows)
    got, met = V.nearest(index, df, query_id="id", vector="v", k=5)
    assert rows_of(got) == plain(df, df, 5)
    assert V.share_compared(index, met, 900) <= most


def test_floats_and_threshold(spark):
    df = frame(spark, clustered(300, 6, 5, 0.3, 2).tolist(), "array<float>")
    index = V.build(df, base_id="id", vector="v", copies=4, block_rows=16)
    asked = df.where("id % 7 = 0")
    got, _ = V.nearest(index, asked, query_id="id", vector="v", k=4, threshold=0.97)
    assert rows_of(got) == plain(df, asked, 4, 0.97)


def test_copies_ties_and_vectors_without_direction(spark, monkeypatch):
    """A third of all rows are one vector; multiples tie; nulls, zeros, no numbers and infinities are nobody's neighbours."""
    monkeypatch.setattr(V, "QUERY_ROWS", 16)
    rng = np.random.default_rng(4)
    vectors = [[1.0, 2.0, 3.0]] * 100 + [[2.0, 4.0, 6.0]] * 5 + rng.normal(size=(180, 3)).tolist() + [None, [0.0, 0.0, 0.0], [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 1.0, 0.0], [1e200, -1e200, 1e-200], [-1e-160, 1e-160, 0.0]]
    df = frame(spark, vectors)
    index = V.build(df, base_id="id", vector="v", copies=7, block_rows=10)
    assert index.rows.count() == 7 + 5 + 180 and index.count == 285
    got, _ = V.nearest(index, df, query_id="id", vector="v", k=7)
    clean = df.where("id < 285")
    assert rows_of(got) == plain(clean, clean, 7)
    assert [r[1] for r in rows_of(got) if r[0] == 0] == [0, 1, 2, 3, 4, 5, 6]


def test_odd_calls(spark):
    df = frame(spark, [[1.0, 0.0], [0.0, 1.0]])
    index = V.build(df, base_id="id", vector="v", copies=5)
    assert len(rows_of(V.nearest(index, df, query_id="id", vector="v", k=5)[0])) == 4  # fewer than k
    with pytest.raises(ValueError, match="copies"):
        V.nearest(index, df, query_id="id", vector="v", k=6)
    with pytest.raises(ValueError, match="2 to 3"):
        V.build(frame(spark, [[1.0, 2.0], [1.0, 2.0, 3.0]]), base_id="id", vector="v")
    with pytest.raises(Exception, match="have 2 numbers"):
        V.nearest(index, frame(spark, [[1.0, 2.0, 3.0]]), query_id="id", vector="v", k=1)[0].collect()
    none = V.build(df.limit(0), base_id="id", vector="v")
    assert V.nearest(none, df, query_id="id", vector="v", k=3)[0].collect() == []
    assert V.nearest(index, df.limit(0), query_id="id", vector="v", k=3)[0].collect() == []
