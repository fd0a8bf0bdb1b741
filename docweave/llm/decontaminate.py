"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names (capitalised words within a sentence) and units after numbers turn into typed
placeholders, other words into lower case without outer punctuation. Windows of five template tokens are hashed; a text's
windows join those of benchmark items by hash. Matches of a text with an item that lie along one alignment cover a share
of the item's windows; at ``similarity`` or more of them the text holds the item's template. Then the slots are compared: each value that
the item repeats must stand for one value of the text wherever it recurs. So a copy with other numbers or names is caught, a text
that happens to share a pattern of placeholders isn't.

A capitalised word at the start of a text or sentence may be a name or not. So texts and items are read twice, with such
words as words and as names, and each reading is matched with its like; a row comes from the first of them that holds the
template. Where such words are names, windows always need two words that aren't.

Windows of items need two words that aren't placeholders (unless an item has no such window); items of fewer than five tokens match
only texts of just these. Texts are read whole; before the join, windows whose hashes no item has are left out, by a
sorted array where the items' hashes are at most ``max_filter``, else by the join itself.

Null texts and texts without words match nothing. Each row is a document, also where ids repeat or are null. Rows of items that share an id are
versions of one item: a document has a row for the first of them that it holds. Empty tables give an empty result; columns besides key and text aren't read, so
that their names don't matter.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

WINDOW = 5
#: Alignments that differ by so many tokens count as one: a few words may be added or lost on the way.
SLACK = 5
#: Distinct pieces of text held by a worker.
MEMO = 500_000
#: Units that turn into a placeholder after a number (fixed values).
UNITS = frozenset(b"% $ km m cm mm mi miles mile kg g mg lb lbs pounds l ml s sec seconds second min minutes minute h hours hour days day weeks week months month years year dollars dollar euros euro cents cent percent degrees kph mph".split())

#: What is no letter, digit or byte of a longer character.
_EDGE = bytes(b for b in range(128) if not chr(b).isalnum())
_NUMBER = re.compile(rb"[$\x80-\xff]{0,3}\d[\d.,:/]*(?:[A-Za-z%]{1,3})?")
LITERAL, NUMBER, NAME, UNIT = range(4)
_U = np.uint64
_MARKS = np.array([0, *(xxhash.xxh64_intdigest(m) for m in (b"<number>", b"<name>", b"<unit>"))], _U)
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 2**64) for i in range(WINDOW)], _U)


class Canonicaliser:
    """Pieces of text to template tokens, each distinct piece worked out once: hash, flags."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.hashes = np.zeros(0, _U)
        self.flags = np.zeros(0, np.uint8)

    @staticmethod
    def of_piece(piece: bytes) -> tuple[int, int]:
        """Flags: 1 number, 2 capitalised, 4 unit, 8 ends a sentence, 16 nothing but punctuation."""
        if piece.isalpha():
            lower = piece.lower()
            return xxhash.xxh64_intdigest(lower), (2 if piece[0] < 97 else 0) | (4 if lower in UNITS else 0)
        word = piece.strip(_EDGE)
        end = 8 if piece.rstrip(b"\"')]")[-1:] in (b".", b"!", b"?", b":") else 0
        if not word:
            return 0, 16 | end
        if _NUMBER.fullmatch(word):
            return 0, 1 | end
        text = word.decode("utf-8", "replace")
        lower = text.lower().encode("utf-8", "replace")
        return xxhash.xxh64_intdigest(lower), end | (2 if text[0].isupper() else 0) | (4 if lower in UNITS else 0)

    @common.without_gc
    def pieces(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """Pieces of all texts: hash, flags, text's number, place; and by text."""
        lists = [common.words_of(t) for t in texts]
        if len(self.numbers) > MEMO:
            self.__init__()
        sizes = np.array([len(w) for w in lists], np.int64)
        # one look at the memo per piece: it is too large for the CPU's caches
        rows = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        new = list(islice(reversed(self.numbers), len(self.numbers) - len(self.hashes)))[::-1]
        made = [self.of_piece(w) for w in new]
        self.hashes = np.concatenate([self.hashes, np.array([m[0] for m in made], _U)])
        self.flags = np.concatenate([self.flags, np.array([m[1] for m in made], np.uint8)])
        owner, place = np.repeat(np.arange(len(lists)), sizes), np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.hashes[rows], self.flags[rows], owner, place, lists

    @staticmethod
    def of(hashes: np.ndarray, flags: np.ndarray, owner: np.ndarray, place: np.ndarray, names: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Template tokens of pieces: hash, kind, text's number, place of its (first) piece. ``names``: also where a sentence starts."""
        starts = (place == 0) | np.concatenate([[True], (flags[:-1] & 8) > 0])[: len(flags)]
        kind = np.zeros(len(flags), np.uint8)
        kind[(flags & 2 > 0) & (names | ~starts)] = NAME
        kind[flags & 1 > 0] = NUMBER
        keep = flags & 16 == 0
        hashes, kind, owner, place, flags, starts = hashes[keep], kind[keep], owner[keep], place[keep], flags[keep], starts[keep]
        follows = np.concatenate([[False], owner[1:] == owner[:-1]])[: len(kind)]
        before = np.concatenate([[0], kind[:-1]])[: len(kind)]
        kind[(flags & 4 > 0) & follows & (before == NUMBER)] = UNIT
        # a name of several words is one slot
        keep = ~((kind == NAME) & follows & (before == NAME) & ~starts)
        hashes, kind, owner, place = hashes[keep], kind[keep], owner[keep], place[keep]
        return np.where(kind == LITERAL, hashes, _MARKS[kind]), kind, owner, place


def windows(texts: list[str | None], names: bool = False, pieces: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[list[str]]]:
    """All windows: hash, text's number, place among its template tokens, whether it has two words that aren't placeholders; and a slot reader. Hashes with ``names`` are others than without."""
    *of, lists = pieces or common.held(("templates",), Canonicaliser).pieces(texts)
    tokens, kind, owner, place = Canonicaliser.of(*of, names)
    sizes = np.bincount(owner, minlength=len(texts))
    begins = np.cumsum(sizes) - sizes
    n = len(tokens)
    index = np.arange(n) - begins[owner] if n else np.zeros(0, np.int64)
    length = np.minimum(sizes, WINDOW)[owner] if n else index
    starts = np.flatnonzero(index + length <= sizes[owner]) if n else index
    starts = starts[(length[starts] == WINDOW) | (index[starts] == 0)]
    # from each token on, by shifted arrays; only those that begin a window are taken
    hashes = length.astype(_U) * _U(0xD6E8FEB86659FD93) ^ _U(names)
    words, literal = np.zeros(n, np.int8), kind == LITERAL
    for i in range(WINDOW):
        m = max(n - i, 0)
        x = (tokens[i:] + _U(i)) * _FACTORS[i]
        x ^= x >> _U(29)
        outside = length[:m] <= i
        x[outside] = 0
        hashes[:m] ^= x
        words[:m] += literal[i:] & ~outside
    hashes, words = hashes[starts], words[starts]
    hashes = hashes * _U(0xFF51AFD7ED558CCD)
    hashes ^= hashes >> _U(32)

    def slots(w: int) -> list[str]:
        """The window's slot values, an empty string for a word."""
        out = []
        for j in range(int(starts[w]), int(starts[w] + length[starts[w]])):
            if kind[j] == LITERAL:
                out.append("")
                continue
            pieces, p = lists[owner[j]], int(place[j])
            last = p + 1
            if kind[j] == NAME:  # the words up to the next token
                last = int(place[j + 1]) if j + 1 < n and owner[j + 1] == owner[j] else p + 1
            out.append(b" ".join(x.strip(_EDGE) for x in pieces[p:last]).decode("utf-8", "replace").lower())
        return out

    return hashes, owner[starts], index[starts], (words >= 2) | (length[starts] < WINDOW) & (not names), slots


def sieve(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes, and which upper 20 bits occur among them."""
    upper = np.zeros(1 << 20, bool)
    upper[(hashes >> _U(44)).astype(np.int64)] = True
    return np.sort(hashes), upper


def known_of(array: np.ndarray, upper: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of ``hashes`` the sorted ``array`` holds; most fall through the sieve at once."""
    keep = upper[(hashes >> _U(44)).astype(np.int64)]
    at = np.flatnonzero(keep)
    if len(at):
        keep[at] = array[np.minimum(np.searchsorted(array, hashes[at]), len(array) - 1)] == hashes[at]
    return keep


def _window_rows(rows: DataFrame, key: str, text: str, known=None, items: bool = False) -> DataFrame:
    """key, row, names (the reading), h, pos, slots, n (usable windows of the text) of ``rows``' windows: of items those that are usable, of texts all, or those with known hashes where given."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 512):
            texts, keys, numbers = b[text].to_pylist(), b[key].to_pylist(), b["__row"].to_numpy()
            pieces = common.held(("templates",), Canonicaliser).pieces(texts)
            for names in (False, True):
                hashes, owner, pos, wordy, slots = windows(texts, names, pieces)
                if items:
                    # an item without wordy windows keeps those it has
                    any_wordy = np.bincount(owner, wordy, minlength=b.num_rows)
                    keep = wordy | (any_wordy[owner] == 0) & (not names)
                elif known is None:
                    keep = np.ones(len(hashes), bool)
                else:
                    keep = known_of(*known.value, hashes)
                at = np.flatnonzero(keep)
                n = np.bincount(owner[at], minlength=b.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[o] for o in owner[at]], pa.int64()), pa.array(numbers[owner[at]], pa.int64()), pa.array([names] * len(at), pa.bool_()), pa.array(hashes[at].view(np.int64)), pa.array(pos[at], pa.int32()), pa.array([slots(int(w)) for w in at], pa.list_(pa.string())), pa.array(n[owner[at]], pa.int32())],
                    ["key", "row", "names", "h", "pos", "slots", "n"],
                )

    return rows.select(F.col(key).cast("long").alias(key), F.col(text), F.monotonically_increasing_id().alias("__row")).mapInArrow(scan, "key long, row long, names boolean, h long, pos int, slots array<string>, n int")


def consistency(pairs: list[tuple[str, str]]) -> float:
    """The share of an item's slots whose value stands for the text's value that it most often stands for."""
    votes: dict[str, dict[str, int]] = {}
    for item, text in pairs:
        of = votes.setdefault(item, {})
        of[text] = of.get(text, 0) + 1
    return sum(max(v.values()) for v in votes.values()) / len(pairs) if pairs else 1.0


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """The rows of each group, from batches sorted by ``by``."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        codes = [b[c].to_numpy(zero_copy_only=False) for c in by]
        cuts = [0, *(np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in codes])) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            now = tuple(x[lo] for x in codes)
            if now != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def find_contaminated(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", similarity: float = 0.8, slot_share: float = 0.8, max_filter: int = 5_000_000) -> DataFrame:
    """A row per document (row of ``docs``) and item whose template it holds: key, item, n_windows, n_matched, similarity, n_slots, slot_share, same_slots, first_token, end_token (the span in template tokens)."""
    spark = docs.sparkSession
    common.ship(spark)
    items = common.materialize(_window_rows(benchmark, item, item_text, items=True), "item-windows")
    known = None
    if items.select("h").distinct().limit(max_filter + 1).count() <= max_filter:  # at most 8 bytes each
        found = items.select("h").distinct().toPandas()["h"].to_numpy().view(_U)
        known = spark.sparkContext.broadcast(sieve(found))
    left = common.materialize(_window_rows(docs, key, text, known).select("key", "row", "names", "h", "pos", "slots"), "windows")
    right = items.select(F.col("key").alias("item"), F.col("row").alias("item_row"), "names", "h", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"), F.col("n").alias("n_windows"))
    # a text that holds enough of an item's windows holds one of any that are more than it may lack: of each item the rarest are these,
    # so that a pattern which many items share pairs texts with none of them
    rarity = items.groupBy("names", "h").agg(F.count(F.lit(1)).alias("rarity"))
    rank = F.row_number().over(W.partitionBy("item_row", "names").orderBy("rarity", "item_pos"))
    seeds = right.join(rarity, ["names", "h"]).withColumn("rank", rank).where(F.col("rank") <= F.col("n_windows") - F.ceil(F.col("n_windows") * similarity - 1e-9) + 1)
    pairs = left.select("row", "names", "h").join(seeds.select("item_row", "names", "h"), ["names", "h"]).select("row", "item_row", "names").distinct()
    matches = left.join(pairs, ["row", "names"]).join(right, ["item_row", "names", "h"]).select("key", "row", "item", "item_row", "names", "pos", "item_pos", "slots", "item_slots", "n_windows")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        last = None  # the pair that has a row already

        def batch() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64(), pa.bool_(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], NAMES)

        for group in _groups(batches, ["row", "item_row", "names"]):
            row, of_item, n = (group[c][0].as_py() for c in ("row", "item", "n_windows"))
            if (row, of_item) == last:
                continue
            pos, item_pos = group["pos"].to_numpy().astype(np.int64), group["item_pos"].to_numpy().astype(np.int64)
            diagonal = pos - item_pos
            # the alignment with most matches within the slack
            values, counts = np.unique(diagonal, return_counts=True)
            up_to = np.concatenate([[0], np.cumsum(counts)])
            best = values[int((up_to[np.searchsorted(values, values + SLACK, "right")] - up_to[:-1]).argmax())]
            on = np.flatnonzero((diagonal >= best) & (diagonal <= best + SLACK))
            matched = len(np.unique(item_pos[on]))
            if matched / n < similarity:
                continue
            # a slot counts once, however many windows show it
            slots = {}
            part = group.take(on)
            for p, q, a, b in zip(item_pos[on].tolist(), pos[on].tolist(), part["item_slots"].to_pylist(), part["slots"].to_pylist()):
                for i, (x, y) in enumerate(zip(a, b)):
                    if x:
                        slots[p + i, q + i] = (x, y)
            agree = consistency(list(slots.values()))
            if agree >= slot_share:
                last = row, of_item
                done.append((group["key"][0].as_py(), of_item, n, matched, matched / n, len(slots), agree, all(x == y for x, y in slots.values()), int(pos[on].min()), int(pos[on].max()) + WINDOW))
                if len(done) == 4096:
                    yield batch()
                    done = []
        yield batch()

    sorted_ = matches.repartition("row", "item").sortWithinPartitions("row", "item", "names", "item_row", "pos", "item_pos")
    schema = f"`{key}` long, `{item}` long, n_windows int, n_matched int, similarity double, n_slots int, slot_share double, same_slots boolean, first_token int, end_token int"
    NAMES = [key, item, "n_windows", "n_matched", "similarity", "n_slots", "slot_share", "same_slots", "first_token", "end_token"]
    return sorted_.mapInArrow(verify, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that hold an item's template, whatever their ``key``; ``docs`` is written once, so that rows keep their numbers."""
    row = common.unused(docs, "__doc")
    numbered = common.materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = find_contaminated(numbered, benchmark, key=row, **options).select(row).distinct()
    return numbered.join(found, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
