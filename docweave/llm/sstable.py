"""Token output as sorted-string-table shards.

A shard holds documents in key order. Entries sit in blocks of some 64 KB, zstd-compressed one by one; within a block a
key gives only what it doesn't share with the key before it, and every 16th entry, a restart point, gives its key whole.
Behind the blocks come a Bloom filter over the keys, an index with the last key, place and size of each block, and a footer
of fixed length. A reader maps the file, asks the filter, searches the index, then one block's restart points.

    block   entries, then restart offsets (u32 each) and their number (u32)
    entry   varint shared, varint unshared, varint value length, unshared key bytes, value
    value   width of an id in bytes (2 or 4), then the ids, little-endian
    footer  <QIQIQQQ8s: filter place and size, index place and size, documents, tokens, filter's hash count, magic

Spark deals rows out by ranges of id and the text's hash, so that an id with many rows is no single task's. A task writes its range
into the shared folder as one shard after another, each closed at a number of bytes and put in its
place at once, so that a task which runs twice leaves the same files. The manifest is a table with a row a shard: path, first and last
id, entries, tokens and the tokens before it; a lookup asks it for the shards whose range holds an id. Keys: a flag byte (0: null id, so nulls come first),
then the id, big-endian with the sign bit turned, so that byte order is number order. Rows with equal ids all stay, in
order of their texts' hashes. Null texts are empty ones; an empty table gives no shard.
"""

from __future__ import annotations

import bisect
import io
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common
from .tokenizing import encoder

MAGIC = b"DWSST\x00\x00\x01"
FOOTER = struct.Struct("<QIQIQQQ8s")
BLOCK_BYTES = 64 * 1024
RESTART = 16
BITS_PER_KEY = 10
#: Bytes of text for a shard, which is what a task holds while it writes; tasks at most, beyond which each writes more shards.
SHARD_BYTES, TASKS = 24 * 2**20, 20_000


def key_of(doc_id: int | None) -> bytes:
    return b"\x00" if doc_id is None else b"\x01" + ((doc_id + 2**63) % 2**64).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return None if key == b"\x00" else int.from_bytes(key[1:], "big") - 2**63


def pack_ids(ids: bytes) -> bytes:
    """Ids as unsigned 32-bit bytes to a value: two bytes an id where all of them fit."""
    a = np.frombuffer(ids, "<u4")
    return b"\x02" + a.astype("<u2").tobytes() if not len(a) or a.max() < 65536 else b"\x04" + ids


def unpack_ids(value: bytes | memoryview) -> np.ndarray:
    return np.frombuffer(value, "<u2" if value[0] == 2 else "<u4", offset=1).astype("<u4")


class Writer:
    """Takes entries in key order; ``finish()`` gives the file."""

    def __init__(self) -> None:
        self.out = io.BytesIO()
        self.block = io.BytesIO()
        self.restarts: list[int] = []
        self.in_block = self.entries = self.tokens = 0
        self.last = b""
        self.index: list[tuple[bytes, int, int]] = []
        self.hashes: list[tuple[int, int]] = []
        self.zstd = zstandard.ZstdCompressor(3)

    def add(self, key: bytes, value: bytes, tokens: int) -> None:
        if key < self.last:
            raise ValueError("keys must come in order")
        shared = 0
        if self.in_block % RESTART:
            for a, b in zip(self.last, key):
                if a != b:
                    break
                shared += 1
        else:
            self.restarts.append(self.block.tell())
        for n in (shared, len(key) - shared, len(value)):
            common.varint(n, self.block)
        self.block.write(key[shared:])
        self.block.write(value)
        if key != self.last or not self.entries:
            self.hashes.append((xxhash.xxh64_intdigest(key, 1), xxhash.xxh64_intdigest(key, 2) | 1))
        self.last = key
        self.in_block += 1
        self.entries += 1
        self.tokens += tokens
        if self.block.tell() >= BLOCK_BYTES:
            self._end_block()

    def _end_block(self) -> None:
        raw = self.block.getvalue() + struct.pack(f"<{len(self.restarts) + 1}I", *self.restarts, len(self.restarts))
        done = self.zstd.compress(raw)
        self.index.append((self.last, self.out.tell(), len(done)))
        self.out.write(done)
        self.block, self.restarts, self.in_block = io.BytesIO(), [], 0

    def finish(self) -> bytes:
        if self.in_block:
            self._end_block()
        bits = max(64, -(-len(self.hashes) * BITS_PER_KEY // 8) * 8)
        filter_, probes = np.zeros(bits // 8, np.uint8), 7
        if self.hashes:
            a, b = np.array(self.hashes, np.uint64).T
            for i in range(probes):
                at = (a + np.uint64(i) * b) % np.uint64(bits)
                np.bitwise_or.at(filter_, at >> np.uint64(3), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))
        filter_at = self.out.tell()
        self.out.write(filter_.tobytes())
        index_at = self.out.tell()
        for key, at, n in self.index:
            for x in (len(key), at, n):
                common.varint(x, self.out)
            self.out.write(key)
        index_n = self.out.tell() - index_at
        self.out.write(FOOTER.pack(filter_at, len(filter_), index_at, index_n, self.entries, self.tokens, probes, MAGIC))
        return self.out.getvalue()


class Reader:
    """``get(key)`` gives the values under a key; iterating gives all entries in order, a block at a time."""

    def __init__(self, data: bytes | memoryview):
        self.data = memoryview(data)
        filter_at, filter_n, index_at, index_n, self.entries, self.tokens, self.probes, magic = FOOTER.unpack(self.data[-FOOTER.size :])
        if magic != MAGIC:
            raise ValueError("no shard of this format")
        self.filter = self.data[filter_at : filter_at + filter_n]
        self.last_keys: list[bytes] = []
        self.places: list[tuple[int, int]] = []
        at = index_at
        while at < index_at + index_n:
            n, at = common.read_varint(self.data, at)
            place, at = common.read_varint(self.data, at)
            length, at = common.read_varint(self.data, at)
            self.last_keys.append(bytes(self.data[at : at + n]))
            self.places.append((place, length))
            at += n
        self.zstd = zstandard.ZstdDecompressor()

    def may_hold(self, key: bytes) -> bool:
        a, b, bits = xxhash.xxh64_intdigest(key, 1), xxhash.xxh64_intdigest(key, 2) | 1, len(self.filter) * 8
        places = [((a + i * b) % 2**64) % bits for i in range(self.probes)]
        return all(self.filter[p >> 3] >> (p & 7) & 1 for p in places)

    def block(self, i: int) -> bytes:
        at, n = self.places[i]
        return self.zstd.decompress(self.data[at : at + n])

    @staticmethod
    def restarts(raw: bytes) -> list[int]:
        (n,) = struct.unpack_from("<I", raw, len(raw) - 4)
        return list(struct.unpack_from(f"<{n}I", raw, len(raw) - 4 - 4 * n))

    @staticmethod
    def entries_of(raw: bytes, at: int, end: int) -> Iterator[tuple[bytes, bytes]]:
        key = b""
        while at < end:
            shared, at = common.read_varint(raw, at)
            own, at = common.read_varint(raw, at)
            n, at = common.read_varint(raw, at)
            key = key[:shared] + raw[at : at + own]
            yield key, raw[at + own : at + own + n]
            at += own + n

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for i in range(len(self.places)):
            raw = self.block(i)
            yield from self.entries_of(raw, 0, len(raw) - 4 - 4 * len(self.restarts(raw)))

    def get(self, key: bytes) -> list[bytes]:
        if not self.may_hold(key):
            return []
        found: list[bytes] = []
        for i in range(bisect.bisect_left(self.last_keys, key), len(self.places)):
            raw = self.block(i)
            points = self.restarts(raw)
            at = points[max(0, bisect.bisect_left(points, key, key=lambda p: next(self.entries_of(raw, p, len(raw)))[0]) - 1)]
            for k, v in self.entries_of(raw, at, len(raw) - 4 - 4 * len(points)):
                if k > key:
                    return found
                if k == key:
                    found.append(v)
        return found


MANIFEST = "path string, task int, number int, first_id long, last_id long, entries long, tokens long"


def write_token_shards(
    docs: DataFrame, tokenizer: str, out: str, *, key: str = "doc_id", text: str = "text", end_id: int | None = 0, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Encode ``text`` by the tokenizer file and write shards under ``out``; returns the manifest, a table with a row a shard: ``MANIFEST`` and start.

    A document's text goes through one shuffle, to its range's task.
    """
    spark = docs.sparkSession
    common.ship(spark)
    docs = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    tasks = max(1, min(TASKS, -(-size // shard_bytes)))
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        writer, held, first, last = Writer(), 0, None, None
        done: list[tuple] = []

        def close() -> None:
            path = f"{out}/shard-{task:06d}-{len(done):06d}.sst"
            common.write_file(path, writer.finish())
            done.append((path, task, len(done), first, last, writer.entries, writer.tokens))

        encode = encoder(tokenizer).encode
        for b in common.slices(batches):
            sizes = pa.compute.binary_length(b["text"]).to_pylist()
            for k, n, ids in zip(b["key"].to_pylist(), sizes, encode(b["text"].to_pylist())):
                if held and held + n > 1.25 * shard_bytes:  # a range is about a shard; a little more makes no second one
                    close()
                    writer, held = Writer(), 0
                first, last = k if not writer.entries else first, k
                ids += tail
                writer.add(key_of(k), pack_ids(ids), len(ids) // 4)
                held += n + 16
        if writer.entries:
            close()
        types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], [c.split()[0] for c in MANIFEST.split(", ")])

    digest = F.xxhash64("text")
    order = (F.col("key").asc_nulls_first(), F.col("digest"), F.col("text"))
    rows = docs.withColumn("digest", digest).repartitionByRange(tasks, *order[:2]).sortWithinPartitions(*order).select("key", "text").mapInArrow(write, MANIFEST)
    made = common.materialize(rows, "shards")
    # tokens before a task's first shard: a sum over tasks, of which there are at most TASKS
    of_task = made.groupBy("task").agg(F.sum("tokens").alias("n")).withColumn("before", F.sum("n").over(W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)))
    within = F.sum("tokens").over(W.partitionBy("task").orderBy("number").rowsBetween(W.unboundedPreceding, -1))
    manifest = made.join(F.broadcast(of_task.select("task", "before")), "task").withColumn("start", F.coalesce("before", F.lit(0)) + F.coalesce(within, F.lit(0))).drop("before")
    return common.materialize(manifest.select(*[c.split()[0] for c in MANIFEST.split(", ")], "start"), "manifest")


def _files(manifest: DataFrame) -> DataFrame:
    return manifest.select("path", "start").repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 4))


def read_token_shards(manifest: DataFrame) -> DataFrame:
    """All documents of the shards: doc_id, start (tokens of all documents before it), n_tokens, ids_crc32 and ids."""
    common.ship(manifest.sparkSession)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>"

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b["path"].to_pylist(), b["start"].to_pylist()):
                rows: list[tuple] = []
                reader = Reader(common.read_file(path))
                for k, v in reader:
                    ids = unpack_ids(v)
                    rows.append((id_of(k), start, len(ids), zlib.crc32(ids.tobytes()), ids))
                    start += len(ids)
                    if len(rows) == 256:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        a, s, n, c, ids = zip(*rows)
        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(c, pa.int64()), lists], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return _files(manifest).mapInArrow(read, schema)


def digest_token_shards(manifest: DataFrame) -> DataFrame:
    """The same without the ids themselves."""
    common.ship(manifest.sparkSession)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b["path"].to_pylist(), b["start"].to_pylist()):
                keys, starts, lengths, sums = [], [], [], []
                for k, v in Reader(common.read_file(path)):
                    ids = unpack_ids(v)
                    keys.append(id_of(k))
                    starts.append(start)
                    lengths.append(len(ids))
                    sums.append(zlib.crc32(ids.tobytes()))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, starts, lengths, sums)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _files(manifest).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, doc_id: int | None) -> list[np.ndarray]:
    """The ids stored under one document id: the manifest's shards whose range holds it, by filter and binary search in each; no scan."""
    null = F.col("first_id").isNull()
    inside = null if doc_id is None else (null | (F.col("first_id") <= doc_id)) & (F.col("last_id") >= doc_id)
    key = key_of(doc_id)
    return [unpack_ids(v) for r in manifest.where(inside).orderBy("task", "number").collect() for v in Reader(common.read_file(r["path"])).get(key)]
