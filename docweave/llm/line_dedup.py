"""Line dedup: lines that many documents hold go from all of them but the last.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least ``least`` code points that at least
``min_docs`` documents hold lose their lines everywhere but in the largest id that holds them. The lines left stay as they were, in order.

Two Bloom filters find the keys worth a shuffle. A task hashes its documents' keys (each once a document) and gives, by segment of the filters,
the bits of all hashes and those of the hashes it saw twice; segments meet by union, and a bit that two tasks set is also one seen twice. The
once-seen filter ends there. A second pass asks the twice-seen filter for each line: only the suspected ones, as SHA-256 digests, are
counted exactly, partially before they move, and the documents without any go by unmoved. Filters have ``bits_per_line`` bits for each line of the
input, up to ``max_bits``; beyond that more lines are suspected in vain, and results stay the same.

Each row is a document; rows that share an id each count, and all rows of the largest id keep the line. A null id is smaller than
all others. Null and empty texts are one empty line. A line repeated within a document counts once, and all its places go or stay together. Other
columns stay; the new ones must not be there already. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Parts of a filter that are built and merged apart; a hash's upper bits choose one.
SEGMENTS, SEGMENT_SHIFT = 64, np.uint64(58)
HASHES = 4
#: Hashes that a task holds before it gives its filters away and begins new ones.
HELD = 4_000_000
#: Lines at most that count as common ones.
COMMON = 10_000


def lines_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def key_of(line: bytes, least: int) -> bytes | None:
    """The line's key, None where it is too short to count. ``strip`` takes just the six characters, ``lower`` A-Z."""
    key = line.strip().lower()
    if len(key) < least or len(key) < 4 * least and len(key.decode("utf-8", "surrogatepass")) < least:
        return None
    return key


def keys_of(text: str | None, least: int) -> list[bytes]:
    """Distinct keys in their order."""
    keys = dict.fromkeys(key_of(x, least) for x in lines_of(text))
    keys.pop(None, None)
    return list(keys)


def digest(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()


# --- filters --------------------------------------------------------------------------------------------------------


def hashed(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """A row of HASHES places within its segment of ``bits`` for each hash."""
    low, step = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return (low[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)


def packed(at: np.ndarray, bits: int) -> bytes:
    """Places as numbers where these are shorter, else as a bitmap."""
    at = np.unique(at)
    if 32 * len(at) < bits:
        return b"n" + at.astype("<u4").tobytes()
    of = np.zeros(bits, bool)
    of[at] = True
    return b"b" + np.packbits(of).tobytes()


def unpacked(data: memoryview) -> np.ndarray:
    body = np.frombuffer(data, np.uint8, offset=1)
    return body.view("<u4") if data[:1] == b"n" else np.flatnonzero(np.unpackbits(body))


def partial_filters(hashes: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """A row for each segment: the bits of all hashes, and of those that are there twice."""
    found, times = np.unique(np.concatenate(hashes), return_counts=True)
    ends = np.searchsorted(found >> SEGMENT_SHIFT, np.arange(SEGMENTS + 1))
    rows = []
    for s, (lo, hi) in enumerate(zip(ends, ends[1:])):
        if lo < hi:
            at = places(found[lo:hi], bits)
            rows.append((s, packed(at, bits), packed(at[times[lo:hi] > 1], bits)))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["segment", "once", "twice"])


class Filter:
    """The twice-seen filter, its segments mapped from the shared folder; those without any hash weren't written."""

    def __init__(self, folder: str, bits: int, written: set[int]):
        self.bits = bits
        self.segments = {s: np.frombuffer(common.read_file(f"{folder}/{s:02d}"), np.uint8) for s in written}

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), bool)
        order = np.argsort(hashes, kind="stable")
        ends = np.searchsorted(hashes[order] >> SEGMENT_SHIFT, np.arange(SEGMENTS + 1))
        for s, (lo, hi) in enumerate(zip(ends, ends[1:])):
            if lo < hi and s in self.segments:
                at = places(hashes[order[lo:hi]], self.bits)
                out[order[lo:hi]] = (self.segments[s][at >> np.uint64(3)] << (at & np.uint64(7)).astype(np.uint8) & 128).all(1)
        return out


def filter_size(lines: int, bits_per_line: int, max_bits: int) -> int:
    """Bits of a segment, a power of two."""
    return 1 << max(10, (min(bits_per_line * lines, max_bits) // SEGMENTS - 1).bit_length()) if lines else 1 << 10


def n_lines(text: str):
    t = F.coalesce(F.col(text), F.lit(""))
    return (F.octet_length(t) - F.octet_length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("long")


def build_filter(docs: DataFrame, folder: str, *, text: str, least: int, bits_per_line: int, max_bits: int) -> tuple[int, set[int]]:
    """Write the twice-seen filter's segments under ``folder``; the bits of a segment, and which were written."""
    bits = filter_size(docs.agg(F.sum(n_lines(text))).head()[0] or 0, bits_per_line, max_bits)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in common.slices(batches):
            for t in b[0].to_pylist():
                if keys := keys_of(t, least):
                    held.append(hashed(keys))
                    n += len(keys)
                    if n > HELD:
                        yield partial_filters(held, bits)
                        held, n = [], 0
        if n:
            yield partial_filters(held, bits)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice, written = None, None, None, []

        def put() -> None:
            if at is not None:
                common.write_file(f"{folder}/{at:02d}", np.packbits(twice).tobytes())
                written.append(at)

        for b in batches:
            for s, one, two in zip(b["segment"].to_pylist(), b["once"], b["twice"]):
                if s != at:
                    put()
                    at, once, twice = s, np.zeros(bits, bool), np.zeros(bits, bool)
                new = unpacked(memoryview(one.as_buffer()))
                twice[new[once[new]]] = True
                twice[unpacked(memoryview(two.as_buffer()))] = True
                once[new] = True
        put()
        yield pa.RecordBatch.from_pydict({"segment": pa.array(written, pa.int32())})

    # in the order of segments, so that a task holds one at a time
    partial = docs.select(text).mapInArrow(seen, "segment int, once binary, twice binary")
    written = partial.repartition("segment").sortWithinPartitions("segment").mapInArrow(merged, "segment int").collect()
    return bits, {r["segment"] for r in written}


# --- documents ------------------------------------------------------------------------------------------------------


def drop_repeated_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = 20, min_docs: int = 3, bits_per_line: int = 16, max_bits: int = 1 << 31) -> DataFrame:
    """``docs`` with its texts (null: empty) less the lines that go, and columns ``n_lines`` (before) and ``n_dropped``."""
    spark = docs.sparkSession
    common.ship(spark)
    if taken := {"n_lines", "n_dropped"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns are there already: {sorted(taken)}")
    row, asked, drop = (common.unused(docs, c) for c in ("__row", "__asked", "__drop"))
    folder = common.fresh_dir(spark, "lines-filter")
    bits, written = build_filter(docs, folder, text=text, least=least, bits_per_line=bits_per_line, max_bits=max_bits)

    @F.arrow_udf("array<binary>")
    def suspected(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen = common.held(("lines", folder), lambda: Filter(folder, bits, written))
        for texts in batches:
            keys = [keys_of(t, least) for t in texts.to_pylist()]
            flat = [k for ks in keys for k in ks]
            holds = iter(seen.holds(hashed(flat)).tolist())
            yield pa.array([[digest(k) for k in ks if next(holds)] or None for ks in keys], pa.list_(pa.binary()))

    @F.arrow_udf("struct<text string, n_dropped long>")
    def without(texts: pa.Array, drops: pa.Array) -> pa.Array:
        out = []
        for t, d in zip(texts.to_pylist(), drops.to_pylist()):
            lines, gone = lines_of(t), set(d or ())
            left = [x for x in lines if (k := key_of(x, least)) is None or digest(k) not in gone] if gone else lines
            out.append((b"\n".join(left), len(lines) - len(left)))
        kept = pa.array([x for x, _ in out], pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays([kept, pa.array([n for _, n in out], pa.int64())], ["text", "n_dropped"])

    # written once, so that rows have numbers that stay
    marked = common.materialize(docs.withColumns({row: F.monotonically_increasing_id(), asked: suspected(F.col(text)), "n_lines": n_lines(text)}), "lines")
    lines = marked.where(F.col(asked).isNotNull()).select(F.col(row).alias("row"), F.col(key).alias("id"), F.explode(asked).alias("line"))
    many = common.materialize(lines.groupBy("line").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("last")).where(F.col("docs") >= min_docs), "many")
    # lines with over a share of all places are fewer than COMMON, so they are sent to all; the others have no hot one among them
    common_from = F.lit((many.agg(F.sum("docs")).head()[0] or 0) // COMMON)
    often = F.broadcast(many.where(F.col("docs") > common_from).select("line", F.struct("last").alias("often")))
    met = lines.join(often, "line", "left")
    rest = met.where("often is null").join(many.where(F.col("docs") <= common_from), "line").select("row", "id", "line", "last")
    held = met.where("often is not null").select("row", "id", "line", "often.last").unionByName(rest)
    drops = held.where(~F.col("id").eqNullSafe(F.col("last"))).groupBy(F.col("row").alias(row)).agg(F.collect_set("line").alias(drop))

    columns = [*docs.columns, "n_lines", "n_dropped"]
    clean = marked.where(F.col(asked).isNull()).withColumns({text: F.coalesce(F.col(text), F.lit("")), "n_dropped": F.lit(0).cast("long")})
    left = marked.where(F.col(asked).isNotNull()).drop(asked).join(drops, row, "left").withColumn(drop, without(F.col(text), F.col(drop)))
    left = left.withColumns({text: F.col(drop)["text"], "n_dropped": F.col(drop)["n_dropped"]})
    return clean.select(*columns).unionByName(left.select(*columns))
