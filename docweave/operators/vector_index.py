"""Nearest vectors by an index of cells, exactly: what cannot be near isn't compared.

Vectors count by their direction, so cosine and distance on the unit sphere order alike. Building: centroids by k-means on a bounded sample;
every row goes to its nearest centroid's cell; a cell is cut into blocks by distance from its centroid, each with its least and largest
such distance. Asking: the triangle inequality gives the least distance that any row of a block can have from a query. A query first
meets its nearest blocks, as many as hold ``k`` rows; the k-th best of these then rules out every block that lies further away, and the query meets
the rest. Both meetings are joins by block, dealt out by salts where many queries want one block, and compare a block of rows with
a block of queries as matrices. Neither side is broadcast; the centroids and the blocks' bounds are, whose number is bounded.

Of rows with the very same vector only the ``copies`` smallest ids can be among so many nearest, so the others are left out: a
vector that a third of all rows share makes no large cell. Vectors that are null, empty or all zero, hold a null or no number, or whose squares
leave the range of doubles have no direction: they are nobody's neighbours and have none. Other lengths than the index's raise an error. Query ids are keys. On data without any
clusters bounds rule little out, and all pairs are compared, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import runs_on_executors
from .entity import written

runs_on_executors(__name__)

#: Cells at most, rings that a cell's rows are counted by, and rows that a block aims at where the blocks would not be too many.
MAX_CELLS, RINGS, BLOCK_ROWS, MAX_BLOCKS = 1024, 64, 1024, 65_536
#: What rounding may add to a distance or a similarity.
SLACK = 1e-6
#: Queries of one block that are compared at once.
QUERY_ROWS = 4096


@dataclass
class VectorIndex:
    rows: DataFrame  # block, id, v
    centroids: np.ndarray
    cell: np.ndarray  # a block's cell, bounds of its rows' distances from the centroid, and their number
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray
    copies: int
    count: int  # of the rows given, copies included, less those without direction

    @property
    def dimension(self) -> int:
        return self.centroids.shape[1]


def directed(v: Column) -> Column:
    """Whether a vector has a direction: the sum of its squares is a number over zero (null with any null in it, no number with a NaN)."""
    squares = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    return (squares > 1e-290) & (squares < float("inf"))


def prepared(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    rows = df.select(F.col(key).alias(name), F.col(vector).cast("array<double>").alias("v"))
    return rows.where(F.coalesce(directed(F.col("v")), F.lit(False)))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return np.asarray(column.flatten()).reshape(n, -1) if n else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1), 0))


def k_means(x: np.ndarray, cells: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's rounds from rows far apart; a cell that loses all rows keeps its centroid."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(x)))]
    near = distances(x, x[chosen])[:, 0]
    while len(chosen) < cells and near.max() > 0:
        chosen.append(int(rng.choice(len(x), p=near**2 / (near**2).sum())))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    c = x[chosen].copy()
    for _ in range(rounds):
        own = distances(x, c).argmin(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def build(base: DataFrame, *, base_id: str, vector: str, copies: int = 10, cells: int | None = None, sample_rows: int = 20_000, block_rows: int | None = None) -> VectorIndex:
    """Index every row of ``base``; centroids come from the ``sample_rows`` rows whose ids have the least hashes. ``copies`` bounds the ``k`` that can be asked for."""
    rows = prepared(base, base_id, vector, "id")
    count, least, most = rows.agg(F.count(F.lit(1)), F.min(F.size("v")), F.max(F.size("v"))).head()
    if least != most:
        raise ValueError(f"vectors have {least} to {most} numbers")
    if not count:
        return VectorIndex(rows.select(F.lit(0).alias("block"), "id", "v"), np.zeros((0, 0)), *np.zeros((4, 0)), copies, 0)
    same = W.partitionBy(F.xxhash64("v"), "v").orderBy("id")
    rows = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= copies).drop("copy")
    rows = written(rows)
    sample = rows.orderBy(F.xxhash64("id")).limit(sample_rows).select("v").toArrow()
    centroids = k_means(unit(matrix(sample["v"])), min(cells or max(1, int(count**0.5)), MAX_CELLS))

    @F.arrow_udf("struct<cell int, distance double>")
    def assigned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in batches:
            if not len(v):
                yield pa.array([], pa.struct([("cell", pa.int32()), ("distance", pa.float64())]))
                continue
            d = distances(unit(matrix(v)), centroids)
            own = d.argmin(1)
            yield pa.StructArray.from_arrays([pa.array(own.astype(np.int32)), pa.array(d[np.arange(len(own)), own])], ["cell", "distance"])

    rows = rows.withColumn("at", assigned("v")).select("id", "v", "at.cell", "at.distance").withColumn("ring", F.least(F.floor(F.col("distance") * (RINGS / 2)), F.lit(RINGS - 1)).cast("int"))
    rows = written(rows)
    # at most MAX_CELLS times RINGS rows reach the driver
    rings = rows.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")).orderBy("cell", "ring").collect()
    want = block_rows or max(BLOCK_ROWS, count // MAX_BLOCKS)
    dealt, blocks = [], []  # of a ring: its first block and how many; of a block: cell, low, high, rows
    for r in rings:
        if blocks and blocks[-1][0] == r["cell"] and blocks[-1][3] + r["n"] <= want:
            cell, low, high, n = blocks[-1]
            blocks[-1] = (cell, min(low, r["low"]), max(high, r["high"]), n + r["n"])
            dealt.append((r["cell"], r["ring"], len(blocks) - 1, 1))
        else:
            parts = -(-r["n"] // want)
            dealt.append((r["cell"], r["ring"], len(blocks), parts))
            blocks += [(r["cell"], r["low"], r["high"], r["n"] / parts)] * parts
    table = base.sparkSession.createDataFrame(dealt, "cell int, ring int, first int, parts int")
    placed = rows.join(F.broadcast(table), ["cell", "ring"]).select((F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("block"), "id", "v")
    cell, low, high, size = (np.array(c) for c in zip(*blocks))
    return VectorIndex(written(placed), centroids, cell.astype(int), low, high, size.astype(float), copies, count)


class Bounds:
    """Which blocks a query has to meet; travels to the executors."""

    def __init__(self, index: VectorIndex, k: int):
        self.centroids, self.cell, self.low, self.high, self.size, self.k = index.centroids, index.cell, index.low, index.high, index.size, k

    def least(self, v: np.ndarray) -> np.ndarray:
        """For each query and block the least distance that the triangle inequality leaves."""
        d = distances(unit(v), self.centroids)[:, self.cell]
        return np.maximum(np.maximum(d - self.high, self.low - d), 0)

    def first(self, least: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(least, 1, kind="stable")
        held = np.cumsum(self.size[order], 1)
        # parts of a ring hold their share only about, so ask for twice as many
        return [o[: np.searchsorted(h, 2 * self.k) + 1] for o, h in zip(order, held)]

    def meet(self, v: np.ndarray, worst: np.ndarray | None) -> list[np.ndarray]:
        """The first blocks; or, given the similarity of the k-th best so far (NaN: fewer were found), all others within reach."""
        out = []
        for i in range(0, len(v), step := max(1, 4_000_000 // len(self.cell))):
            least = self.least(v[i : i + step])
            first = self.first(least)
            if worst is None:
                out += first
                continue
            reach = np.sqrt(np.maximum(2 - 2 * worst[i : i + step], 0))
            for b, f, r in zip(least, first, reach):
                near = ~(b > r + SLACK)  # all of them where r is no number
                near[f] = False
                out.append(np.flatnonzero(near))
        return out


def meetings(queries: DataFrame, bounds: Bounds, worst: str | None = None) -> DataFrame:
    """query, v and block for each block that a query has to meet."""

    @F.arrow_udf("array<int>")
    def first(v: pa.Array) -> pa.Array:
        return pa.array(bounds.meet(matrix(v), None) if len(v) else [], pa.list_(pa.int32()))

    @F.arrow_udf("array<int>")
    def others(v: pa.Array, worst: pa.Array) -> pa.Array:
        return pa.array(bounds.meet(matrix(v), worst.to_numpy(zero_copy_only=False).astype(float)) if len(v) else [], pa.list_(pa.int32()))

    asked = others("v", worst) if worst else first("v")
    return queries.withColumn("blocks", asked).select("query", "v", F.explode("blocks").alias("block"))


def exact_cosines(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of the pairs (i, j), added up one number after another as ``scalar.cosine`` does."""
    dot, aa, bb = np.zeros(len(i)), np.zeros(len(a)), np.zeros(len(b))
    for d in range(a.shape[1]):
        dot += a[i, d] * b[j, d]
        aa += a[:, d] * a[:, d]
        bb += b[:, d] * b[:, d]
    return dot / (np.sqrt(aa)[i] * np.sqrt(bb)[j])


def compared(met: DataFrame, index: VectorIndex, k: int) -> DataFrame:
    """query, base and similarity: of each meeting the ``k`` best, and what ties with them."""
    salts = met.groupBy("block").agg((F.floor(F.count(F.lit(1)) / QUERY_ROWS) + 1).alias("salts"))  # a row a block
    asked = met.join(salts, "block").withColumn("salt", F.pmod(F.xxhash64("query"), F.col("salts")))
    rows = index.rows.join(salts, "block").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    types = {f.name: f.dataType.simpleString() for f in met.schema}, {f.name: f.dataType.simpleString() for f in index.rows.schema}
    out = pa.float64()

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = matrix(left["v"]), matrix(right["v"])
        i = j = np.zeros(0, np.int64)
        if len(a) and len(b):
            parts, ub = [], unit(b).T
            for lo in range(0, len(a), step := max(1, 4_000_000 // len(b))):
                s = unit(a[lo : lo + step]) @ ub
                kth = -np.partition(-s, min(k, len(b)) - 1, 1)[:, min(k, len(b)) - 1]
                x, y = np.nonzero(s >= kth[:, None] - SLACK)
                parts.append((x + lo, y))
            i, j = (np.concatenate(p) for p in zip(*parts))
        similarity = exact_cosines(a, b, i, j) if len(i) else np.zeros(0)
        return pa.table({"query": left["query"].take(pa.array(i)), "base": right["id"].take(pa.array(j)), "similarity": pa.array(similarity, out)})

    schema = f"query {types[0]['query']}, base {types[1]['id']}, similarity double"
    pairs = asked.select("block", "salt", "query", "v").groupBy("block", "salt").cogroup(rows.select("block", "salt", "id", "v").groupBy("block", "salt"))
    return pairs.applyInArrow(best, schema)


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.col("similarity").desc(), "base")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(index: VectorIndex, queries: DataFrame, *, query_id: str, vector: str, k: int = 10, threshold: float | None = None) -> tuple[DataFrame, DataFrame]:
    """query, base, similarity and rank of the ``k`` nearest rows, as if all were compared, ties by base id; and (query, block) of all meetings, for what was compared."""
    if k > index.copies:
        raise ValueError(f"the index holds {index.copies} copies of a vector; {k} nearest can't be told")
    asked = prepared(queries, query_id, vector, "query")
    if not index.count:
        types = asked.schema["query"].dataType.simpleString(), index.rows.schema["id"].dataType.simpleString()
        spark = queries.sparkSession
        return spark.createDataFrame([], f"query {types[0]}, base {types[1]}, similarity double, rank int"), spark.createDataFrame([], f"query {types[0]}, block int")
    asked = asked.withColumn("v", F.when(F.size("v") == index.dimension, F.col("v")).otherwise(F.raise_error(F.lit(f"vectors of the index have {index.dimension} numbers"))))
    bounds = Bounds(index, k)
    first = written(meetings(asked, bounds))
    found = written(ranked(compared(first, index, k), k).drop("rank"))
    worst = found.groupBy("query").agg(F.min("similarity").alias("worst"), F.count(F.lit(1)).alias("n")).select("query", F.when(F.col("n") >= k, F.col("worst")).alias("worst"))
    if threshold is not None:  # nothing below it is wanted
        worst = worst.withColumn("worst", F.greatest(F.col("worst"), F.lit(threshold)))
    second = written(meetings(asked.join(worst, "query"), bounds, "worst"))
    pairs = found.unionByName(compared(second, index, k))
    if threshold is not None:
        pairs = pairs.where(F.col("similarity") >= threshold)
    return ranked(pairs, k).select("query", "base", "similarity", "rank"), first.select("query", "block").unionByName(second.select("query", "block"))


def share_compared(index: VectorIndex, met: DataFrame, queries: int) -> float:
    """Pairs compared over all pairs."""
    sizes = index.rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    return (met.join(sizes, "block").agg(F.sum("n")).head()[0] or 0) / max(queries * index.count, 1)
