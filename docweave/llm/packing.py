"""Best-fit packing through the configuration linear program.

Pieces are grouped by length into a histogram of at most ``capacity`` numbers, all that the driver sees. A configuration is
a multiset of lengths that fits one sequence. The program: cover every length's count with as few configurations as
possible. It is solved by multiplicative weights: a knapsack dynamic program over the capacity finds the configuration
worth most at the present weights, it enters by as much as its scarcest length allows, and the weights of what it covers fall
against the others. The fractional solution, scaled to a packing, is rounded down to whole sequences; what is left is
solved again, for as long as that shortens the whole; the last rest is packed best-fit decreasing.
Sequences then are ranges of ranks within a length, so that each piece finds its place by
its rank alone. Pieces that fill a sequence need no rank and stay where they are.

Null texts are empty (the end id alone). Null and repeated ids and equal rows are packed each. Only key and text are read, so that other columns' names don't
matter. An empty table gives no sequences.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common
from .tokenizing import encoder

#: Ranks within a length are counted in buckets, so that a length with a third of all pieces isn't one task's: so many at least and at most, and pieces for each bucket over all lengths.
BUCKETS, MOST_BUCKETS, BUCKET_PIECES = 64, 4096, 4_000_000


# --- the program, on the driver over the histogram ----------------------------------------------------------------------


def knapsack(worth: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths worth most within ``capacity``; worth[l] is that of length l, 0 for none of that length."""
    lengths = np.flatnonzero(worth > 0)
    lengths = lengths[(lengths > 0) & (lengths <= capacity)]
    values = worth[lengths]
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    until = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room], n = best[room - 1], until[room]
        if n:
            options = best[room - lengths[:n]] + values[:n]
            i = int(options.argmax())
            if options[i] > best[room]:
                best[room], took[room] = options[i], lengths[i]
    config: dict[int, int] = {}
    room = capacity
    while room > 0:
        if took[room]:
            config[int(took[room])] = config.get(int(took[room]), 0) + 1
            room -= int(took[room])
        else:
            room -= 1
    return config


def fractional(counts: np.ndarray, capacity: int, steps: int, rate: float = 0.5) -> tuple[list[dict[int, int]], np.ndarray]:
    """Configurations and how often each, fractionally, so that no length is over-covered."""
    demand = counts.astype(float)
    price = np.where(demand > 0, np.arange(len(counts)) / capacity, 0.0) * (1 + 1e-3 * np.cos(np.arange(len(counts))))
    covered = np.zeros(len(counts))
    configs: dict[tuple, int] = {}
    amounts: list[float] = []
    for _ in range(steps):
        config = knapsack(np.where(demand > 0, price, 0.0), capacity)
        if not config:
            break
        lengths, times = np.array(list(config)), np.array(list(config.values()))
        step = float((demand[lengths] / times).min())
        k = tuple(sorted(config.items()))
        if k not in configs:
            configs[k] = len(amounts)
            amounts.append(0.0)
        amounts[configs[k]] += step
        covered[lengths] += step * times
        # what is covered gets cheaper against what isn't: prices are those of the uncovered share
        price[lengths] *= np.exp(-rate * step * times / demand[lengths])
    x = np.array(amounts)
    over = float((covered[demand > 0] / demand[demand > 0]).max(initial=0))
    return [dict(k) for k in configs], x / max(over, 1.0)


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over a histogram: longest first, each into the fullest sequence that still takes it.

    Equal sequences are handled as one with a count, so that the work follows the number of lengths, not of pieces.
    """
    by_room: dict[int, list[tuple[dict[int, int], int]]] = {}
    rooms: list[int] = []  # with sequences in them, ascending

    def put(config: dict[int, int], n: int, room: int) -> None:
        if room not in by_room:
            by_room[room] = []
            bisect.insort(rooms, room)
        by_room[room].append((config, n))

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                config, n, room = {}, -(-left // (capacity // length)), capacity
            else:
                room = rooms[at]
                config, n = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            # a sequence that takes one stays the fullest that takes another, as long as it has room
            each = room // length
            full = min(n, left // each)
            if full:
                put({**config, length: each}, full, room - each * length)
                left -= full * each
            if full < n and 0 < left < each:
                put({**config, length: left}, 1, room - left * length)
                full, left = full + 1, 0
            if full < n and config:
                put(config, n - full, room)
    made: dict[tuple, int] = {}
    for group in by_room.values():
        for config, n in group:
            k = tuple(sorted(config.items()))
            made[k] = made.get(k, 0) + n
    return [(dict(k), n) for k, n in made.items()]


def plan_sequences(counts: np.ndarray, capacity: int, *, steps: int = 120, rounds: int = 12, patience: int = 3) -> list[tuple[dict[int, int], int]]:
    """Configurations with whole numbers of sequences; together they take exactly ``counts`` pieces of each length.

    Rounds of the program take sequences off the histogram. After each the rest is packed best-fit decreasing; the round whose
    whole comes out shortest ends the plan, and ``patience`` rounds without a shorter one end the search.
    """
    left = counts.astype(np.int64).copy()
    left[0] = 0
    taken: list[tuple[dict[int, int], int]] = []
    if left[capacity]:
        taken.append(({capacity: 1}, int(left[capacity])))
        left[capacity] = 0
    best, shortest, since, used = [], -1, 0, sum(n for _, n in taken)
    for _ in range(rounds):
        if not left.any():
            break
        configs, x = fractional(left, capacity, steps)
        before = used
        for i in np.argsort(-x, kind="stable"):
            config = configs[i]
            n = min([int(x[i] + 1e-9), *(int(left[length]) // m for length, m in config.items())])
            if n > 0:
                taken.append((config, n))
                used += n
                for length, m in config.items():
                    left[length] -= n * m
        rest = best_fit(left, capacity)
        whole = used + sum(n for _, n in rest)
        since += 1
        if shortest < 0 or whole < shortest:
            best, shortest, since = taken + rest, whole, 0
        if used == before or since == patience:
            break  # what is left is spread too thin for whole configurations, or no more comes of it
    return best if shortest >= 0 else taken


def slots(plan: list[tuple[dict[int, int], int]], capacity: int) -> dict[str, np.ndarray]:
    """The plan by length: from which rank on, in which sequence, how many a sequence, at which offset. Sorted by length and rank."""
    rows, seen, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for config, n in plan:
        offset = 0
        for length, m in config.items():
            rows.append((length, int(seen[length]), sequence, m, offset))
            seen[length] += n * m
            offset += length * m
        sequence += n
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 5)
    return {"length": a[:, 0], "rank": a[:, 1], "sequence": a[:, 2], "times": a[:, 3], "offset": a[:, 4]}


# --- pieces and places, on the executors --------------------------------------------------------------------------------


def tokenized_pieces(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Each text's ids and the end id, cut into pieces of ``capacity`` where they are more: key, piece, start, length, ids_crc32 and, if asked for, ids."""
    common.ship(docs.sparkSession)
    tail = int(end_id).to_bytes(4, "little")
    # one row in each piece: its salt deals pieces of a length out, whatever their documents
    schema = f"{key} long, piece int, start long, length long, ids_crc32 long, salt int" + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, True).encode
        for b in common.slices(batches):
            rows = []
            for k, ids in zip(b[key].to_pylist(), encode(b[text].to_pylist())):
                ids += tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    crc = zlib.crc32(part)
                    rows.append((k, piece, at // 4, len(part) // 4, crc, zlib.crc32(b"%d/%d" % (-1 if k is None else k, piece)) % MOST_BUCKETS, part))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))]
            names = [key, "piece", "start", "length", "ids_crc32", "salt", "ids"]
            if rows:
                yield pa.RecordBatch.from_arrays(columns[: 7 if with_ids else 6], names[: 7 if with_ids else 6])

    return docs.select(F.col(key).cast("long").alias(key), F.col(text)).mapInArrow(cut, schema)


def assign(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (length, salt, ...; a written table) with sequence_id and offset. Pieces that fill a sequence get negative numbers where they stand; only the others move."""
    columns = [f.name for f in pieces.schema if f.name != "salt"]
    full = pieces.where(F.col("length") == capacity).select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pieces = pieces.where(F.col("length") < capacity)
    buckets = BUCKETS
    n = pieces.count()
    while buckets < MOST_BUCKETS and n > buckets * BUCKET_PIECES:
        buckets *= 2
    pieces = pieces.withColumn("salt", F.col("salt") % buckets)
    cells = pieces.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values(["length", "salt"])  # at most capacity * MOST_BUCKETS numbers
    counts = np.zeros(capacity + 1, np.int64)
    before = np.zeros(capacity * buckets, np.int64)
    length, n = cells["length"].to_numpy(np.int64), cells["n"].to_numpy(np.int64)
    np.add.at(counts, length, n)
    ranks = np.cumsum(n) - n
    begins = np.searchsorted(length, length)
    before[length * buckets + cells["salt"].to_numpy(np.int64)] = ranks - ranks[begins] if len(n) else ranks
    table = slots(plan_sequences(counts, capacity), capacity)
    wide = np.int64(1) << 40
    search = table["length"] * wide + table["rank"]
    shared = pieces.sparkSession.sparkContext.broadcast((before, search, table))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name != "salt") + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, search, table = shared.value
        for b in batches:
            length, salt, rank = (b[c].to_numpy().astype(np.int64) for c in ("length", "salt", "rank"))
            rank = before[length * buckets + salt] + rank - 1
            at = np.searchsorted(search, length * wide + rank, "right") - 1
            within, times = rank - table["rank"][at], table["times"][at]
            sequence = table["sequence"][at] + within // times
            offset = table["offset"][at] + within % times * length
            yield pa.RecordBatch.from_arrays([*(b[c] for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    order = [c for c in columns if c not in ("length", "ids")]
    ranked = pieces.withColumn("rank", F.row_number().over(W.partitionBy("length", "salt").orderBy(*order)))
    return ranked.mapInArrow(place, schema).unionByName(full)


def pack(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """A row per piece: key, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    pieces = common.materialize(tokenized_pieces(docs, tokenizer, key=key, text=text, capacity=capacity, end_id=end_id, with_ids=with_ids), "pieces")
    return assign(pieces, capacity)


def sequences(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Whole sequences from ``pack(..., with_ids=True)``: sequence_id, ids (little-endian unsigned 32-bit), and its pieces' keys, offsets and lengths."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", F.col(key).alias("key"), "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"),
        F.col("p.key").alias("keys"),
        F.col("p.offset").alias("offsets"),
        F.col("p.length").alias("lengths"),
    )
