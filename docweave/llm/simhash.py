"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming distance, components.

A text's fingerprint has a bit set where over half of its shingles' hashes have it. Two fingerprints that differ in at most
``distance`` bits agree in all but ``distance`` of their blocks, so joining on every choice of agreeing blocks finds each
such pair. Distinct fingerprints are the nodes: copies fall together before any join. Rows that share a block choice are
sorted side by side and compared by arrays; a key with many rows is split by further choices of the bits that it leaves open, and what
still has many is cut into chunks whose pairs go to tasks of their own; and of the links within a run only a spanning forest goes out, so that no group is emitted as all its pairs and no link
between components is lost.

Null texts are empty: fingerprint zero, linked like any other. Null ids stay, and count as the largest. Repeated rows stay, each with its component.
Columns that the result would repeat are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common
from .components import connected_components

#: Rows of one block key that a task compares with one another, or with as many others.
CHUNK = 4096


def fingerprint(words: list[bytes], shingle: int, seed: int = 42) -> int:
    """The fingerprint of a word sequence as an unsigned number; no words: zero."""
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest = xxhash.xxh64_digest
    n = len(words) - shingle + 1
    hashes = b"".join([digest(b" ".join(w), seed) for w in zip(*(words[i:] for i in range(shingle)))])
    # digests are big-endian: the first byte's first bit is bit 63
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(n, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(0, dtype=np.int64) > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, *, text: str = "text", out: str = "fp", shingle: int = 3) -> DataFrame:
    """``docs`` with a signed 64-bit column of fingerprints."""
    common.ship(docs.sparkSession)

    @F.pandas_udf("long")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(common.lower_words_of(t), shingle) for t in s], np.uint64).view(np.int64))

    return docs.withColumn(out, prints(F.col(text)))


def choices(distance: int, blocks: int) -> list[int]:
    """Masks over 64 bits: each choice of ``blocks - distance`` of the blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    return [sum(block[i] for i in c) for c in combinations(range(blocks), blocks - distance)]


def finer_choices(mask: int, distance: int) -> list[int]:
    """``mask`` with each choice of two of ``distance`` + 2 blocks of its zeros: two fingerprints that agree on the mask and differ in ``distance`` bits agree on one of these."""
    free = [i for i in range(64) if not mask >> i & 1]
    n = distance + 2
    blocks = [sum(1 << i for i in free[len(free) * k // n : len(free) * (k + 1) // n]) for k in range(n)]
    return [mask | a | b for a, b in combinations(blocks, 2)]


def blocks_for(n: int, distance: int) -> int:
    """The least number of blocks whose keys have 16 bits or more and leave some 64 of ``n`` fingerprints together by chance; the result is the same for any."""
    for blocks in range(distance + 1, distance + 5):
        bits = 64 * (blocks - distance) // blocks
        if bits >= 16 and n / 2**bits <= 64:
            return blocks
    return distance + 4


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _forest(prints: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """Of the links between positions, those that join two trees; each goes to the tree's root, so that paths stay short."""
    root = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    made = []
    for i, j in zip(rows.tolist(), cols.tolist()):
        a, b = find(i), find(j)
        if a != b:
            a, b = min(a, b), max(a, b)
            root[b] = a
            made.append((int(prints[a]), int(prints[b])))
    return made


def run_links(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one run, by growing each tree from its first member through array comparisons.

    Every member is compared with those that no tree holds yet, so that a group of near copies costs few comparisons.
    """
    left = np.arange(len(prints))
    made: list[tuple[int, int]] = []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        root = int(prints[front[0]])
        while front and len(left):
            x = front.pop()
            near = _popcount(prints[left] ^ prints[x]) <= distance
            if near.any():
                found = left[near]
                # the tree's members are all one component: tie each to the root
                made += [(root, int(p)) for p in prints[found]]
                front += found.tolist()
                left = left[~near]
    return made


def cross_links(one: np.ndarray, two: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two chunks of one key."""
    both = np.concatenate([one, two])
    rows, cols = [], []
    for i, p in enumerate(one):
        hit = np.flatnonzero(_popcount(two ^ p) <= distance)
        if len(hit):
            rows.append(np.full(len(hit), i))
            cols.append(hit + len(one))
    return _forest(both, np.concatenate(rows), np.concatenate(cols)) if rows else []


def near_links(nodes: DataFrame, fp: str, distance: int, n: int) -> DataFrame:
    """``a, b``: links between distinct fingerprints that keep every component whole; ``n``: about how many there are."""
    masks = choices(distance, blocks_for(n, distance))
    signed = [m - 2**64 if m >= 2**63 else m for m in masks]
    keyed = nodes.select(F.col(fp).alias("fp"), F.posexplode(F.array(*[F.col(fp).bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("t", "k"))

    def hot(keyed: DataFrame) -> DataFrame | None:
        """Keys of more rows than a chunk, and how many chunks they fill: counts are summed before they move."""
        sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK).select("t", "k", F.ceil(F.col("n") / CHUNK).cast("int").alias("c"))
        sizes = common.materialize(sizes, "hot-blocks")
        return sizes if sizes.limit(1).count() else None

    if (sizes := hot(keyed)) is None:
        keyed = keyed.withColumn("c", F.lit(1))
    else:
        # rows of hot keys agree on finer choices too, of the bits that the key leaves open
        marked = keyed.join(sizes, ["t", "k"], "left")
        finer = F.array(*[F.array(*[F.lit(m - 2**64 if m >= 2**63 else m).cast("long") for m in finer_choices(mask, distance)]) for mask in masks])
        split = marked.where("c is not null").select("fp", "t", F.posexplode(F.transform(F.get(finer, F.col("t")), lambda m: F.col("fp").bitwiseAND(m))).alias("j", "k")).select("fp", ((F.col("t") + 1) * 1000 + F.col("j")).alias("t"), "k")
        if (sizes := hot(split)) is None:
            split = split.withColumn("c", F.lit(1))
        else:
            split = split.join(sizes, ["t", "k"], "left").withColumn("c", F.coalesce("c", F.lit(1)))
        keyed = marked.where("c is null").withColumn("c", F.lit(1)).unionByName(split)
    mine = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    # a chunk meets itself and every other one: cells (i, j), i <= j
    cells = F.transform(F.sequence(F.lit(0), F.col("c") - 1), lambda j: F.struct(F.least("m", j).alias("i"), F.greatest("m", j).alias("j")))
    rows = keyed.withColumn("m", mine).select("t", "k", "fp", "m", F.explode(cells).alias("cell")).select("t", "k", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), F.col("m"), "fp")
    common.ship(nodes.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pd.DataFrame | None = None

        def links(part: pd.DataFrame) -> pa.RecordBatch:
            prints = part["fp"].to_numpy().view(np.uint64)
            key = part[["t", "k", "i", "j"]].to_numpy()
            begins = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)]))
            ends = np.append(begins[1:], len(part))
            sizes = ends - begins
            made: list[tuple[int, int]] = []
            # short runs: rows s apart are compared all at once; runs in which any pair links are then linked one by one
            small = np.repeat(sizes <= 256, sizes)
            run = np.repeat(np.arange(len(begins)), sizes)
            linked: set[int] = set()
            for s in range(1, int(sizes[sizes <= 256].max(initial=1))):
                here = np.flatnonzero(small[:-s] & (run[s:] == run[:-s]))
                if not len(here):
                    break
                linked.update(run[here[_popcount(prints[here] ^ prints[here + s]) <= distance]].tolist())
            for r in [*linked, *np.flatnonzero(sizes > 256).tolist()]:
                lo, hi = begins[r], ends[r]
                if key[lo, 2] == key[lo, 3]:
                    made += run_links(prints[lo:hi], distance)
                else:
                    side = part["m"].to_numpy()[lo:hi] == key[lo, 2]
                    made += cross_links(prints[lo:hi][side], prints[lo:hi][~side], distance)
            a = np.array([x for x, _ in made], np.uint64).view(np.int64)
            b = np.array([y for _, y in made], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            now = batch.to_pandas()
            now = now if held is None else pd.concat([held, now], ignore_index=True)
            if not len(now):
                continue
            last = now[["t", "k", "i", "j"]].iloc[-1]
            same = (now[["t", "k", "i", "j"]] == last).all(axis=1).to_numpy()
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            held = now.iloc[cut:]
            if cut:
                yield links(now.iloc[:cut])
        if held is not None and len(held):
            yield links(held)

    return rows.repartition(F.col("t"), F.col("k"), F.col("i"), F.col("j")).sortWithinPartitions("t", "k", "i", "j").mapInArrow(compare, "a long, b long")


def roots(nodes: DataFrame, distance: int) -> DataFrame:
    """``nodes``, a row per distinct ``fp``, with ``root``: a fingerprint that stands for its component."""
    links = near_links(nodes, "fp", distance, nodes.count())
    found = connected_components(links)
    return nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """A row per row of ``docs``: key, fp (signed), fingerprint (16 hex digits), component_id (the component's smallest key)."""
    prints = common.materialize(with_fingerprint(docs.select(F.col(key), F.col(text)), text=text, out="fp", shingle=shingle).select(key, "fp"), "prints")
    nodes = common.materialize(prints.groupBy("fp").agg(F.min(key).alias("least")), "nodes")
    grouped = roots(nodes, distance)
    of_root = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = grouped.select("fp", "root").join(of_root, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select(key, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """Of each component one row of ``docs``: that of the smallest key, nulls last; of several, that of the smallest fingerprint, then the least text and other columns."""
    fp, n = common.unused(docs, "__fp"), common.unused(docs, "__n")
    marked = common.materialize(with_fingerprint(docs, text=text, out=fp, shingle=shingle), "prints")
    nodes = common.materialize(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(key).alias("least")), "nodes")
    best = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("best")
    kept = roots(nodes, distance).groupBy("root").agg(best).select(F.col("best.fp").alias(fp))
    # of copies all but one go before they move
    first = W.partitionBy(fp).orderBy(F.col(key).asc_nulls_last(), text, *[F.col(f"`{c}`") for c in docs.columns if c not in (key, text)])
    return marked.withColumn(n, F.row_number().over(first)).where(F.col(n) == 1).join(kept, fp, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
