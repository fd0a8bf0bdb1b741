"""A bigram or trigram language model in Elias-Fano trie levels, and scores of whole texts under it.

Texts are cut into words once: a task numbers its words in the order it meets them, writes each text as these numbers, and its
dictionaries (hashes and training counts of so many words) as files. The dictionaries' counts, by hash shard, become the first level: each shard's words'
64-bit hashes, ascending, in Elias-Fano form (a word's number is its place there, after those of the shards before), and
exact counts, a byte each with the large ones aside. A dictionary's words are looked up there once; from then on a text's words are an array's look away from the
model's numbers. The next pass counts pairs of words; each
shard of contexts becomes a file: pointers from a context to its range of successors, monotone and so Elias-Fano coded; the
successors' numbers, each range raised by the value that ended the one before, so that the level is one ascending sequence;
and probabilities and back-off weights in 256 quantised steps. A query finds its context's range and base by the pointers,
then the successor of base plus word; a word found within the range is a pair of the model. With ``order`` 3 a further pass
counts triples. Their level has the same form, with pairs in the place of contexts, and successors numbered relative to
their context: a word by its rank among the words that follow the pair's second word, so that ranges are short and dense. Its shards
are ranges of pairs' numbers.

Smoothing is interpolated absolute discounting over add-one unigrams: p(w|h) = max(c(hw) - d, 0) / c(h) + backoff(h) p(w), where the
back-off takes what discounts and left-out pairs leave; p(w|gh) rests on p(w|h) likewise. A text is its words and one end;
its first word is scored as a unigram, its second by the first. With ``min_count`` 1 nothing is left out.

Files lie in the shared folder and are mapped where that is a mounted one, so that tasks on one machine share their pages.
Counts leave a task as sorted, compressed arrays by shard. Nothing but the
manifest (a row a shard) reaches the driver. Words are told apart by 64-bit hashes; among ten million that two share one has a chance of 3 in a million.

Null texts are empty: one end token. Repeated rows and ids count each. Without training texts all counts are zero and every score too; an empty table gives an
empty result. Columns of the scores' names are replaced, others go along.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import chain, count, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .elias_fano import EliasFano, encode

_U = np.uint64
#: The end of a text; no word is empty.
END = xxhash.xxh64_intdigest(b"")
#: Distinct words held by a task or worker, and tokens whose pairs are sorted at once.
WORDS_HELD, PAIRS_HELD = 500_000, 4_000_000
#: Texts looked up at once: queries are dealt to shards, so more of them cost fewer calls.
TEXTS = 2048
DISCOUNT = 0.75
STEPS = 256


def pack(a: np.ndarray) -> bytes:
    """An array by byte planes, compressed: the upper planes of differences and counts are nearly empty."""
    a = np.ascontiguousarray(a).astype("<u8", copy=False)
    return zstandard.ZstdCompressor(1).compress(struct.pack("<Q", len(a)) + np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    (n,) = struct.unpack_from("<Q", raw)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, offset=8).reshape(8, n).T).view("<u8").ravel()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their counts' sums."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begins], np.add.reduceat(counts, begins)


def runs(a: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbours begin."""
    return np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)


def grouped(context: np.ndarray) -> np.ndarray:
    """An order that brings contexts together, ascending: one sort of numbers that carry their places, where both fit 64 bits."""
    bits = max(1, len(context).bit_length())
    if len(context) and int(context.max()) < 1 << 63 - bits:
        packed = context.astype(np.int64) << bits | np.arange(len(context))
        packed.sort()
        return packed & (1 << bits) - 1
    return np.argsort(context, kind="stable")


def blobs(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Shards with their ascending keys, as differences, and counts."""
    return pa.RecordBatch.from_arrays(
        [pa.array([s for s, _, _ in parts], pa.int32()), pa.array([pack(np.diff(k, prepend=_U(0))) for _, k, _ in parts], pa.binary()), pa.array([pack(c) for _, _, c in parts], pa.binary())],
        ["shard", "keys", "counts"],
    )


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Shards one after another from rows sorted by shard, their arrays summed; what is held is summed up as it doubles."""
    now, keys, counts, held, last = None, [], [], 0, 0
    for b in batches:
        for s, k, c in zip(b["shard"].to_pylist(), b["keys"], b["counts"]):
            if s != now:
                if now is not None:
                    yield (now, *summed(np.concatenate(keys), np.concatenate(counts)))
                now, keys, counts, held, last = s, [], [], 0, 0
            keys.append(np.cumsum(unpack(k.as_py())))
            counts.append(unpack(c.as_py()))
            held += len(keys[-1])
            if held > 2 * last + 2_000_000:
                a, n = summed(np.concatenate(keys), np.concatenate(counts))
                keys, counts, held, last = [a], [n], len(a), len(a)
    if now is not None:
        yield (now, *summed(np.concatenate(keys), np.concatenate(counts)))


BLOBS = "shard int, keys binary, counts binary"


# --- level one: words ---------------------------------------------------------------------------------------------------


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """By the upper half of the hash, so that shards are ranges of hashes."""
    return ((hashes >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)


def encode_words(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    large = np.flatnonzero(counts >= 255)
    head = encode(hashes, 2**64)
    out = io.BytesIO()
    out.write(struct.pack("<QQQ", len(hashes), len(head), len(large)))
    out.write(head)
    out.write(np.minimum(counts, 255).astype(np.uint8).tobytes() + b"\0" * (-len(hashes) % 8))
    out.write(large.astype("<u8").tobytes())
    out.write(counts[large].astype("<u8").tobytes())
    return out.getvalue()


class WordLevel:
    def __init__(self, data: memoryview):
        n, head, large = struct.unpack_from("<QQQ", data)
        self.n = n
        self.hashes = EliasFano(data, 24)
        at = 24 + head
        self.small = np.frombuffer(data, np.uint8, n, at)
        at += n + -n % 8
        self.large = np.frombuffer(data, "<u8", large, at)
        self.large_counts = np.frombuffer(data, "<u8", large, at + 8 * large)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places within the shard, -1 where a word isn't there."""
        at = self.hashes.successor(hashes)
        inside = np.flatnonzero(at < self.n)
        hit = np.zeros(len(hashes), bool)
        hit[inside] = self.hashes.access(at[inside]) == hashes[inside]
        return np.where(hit, at, -1)

    def counts(self, at: np.ndarray) -> np.ndarray:
        out = self.small[at].astype(np.int64)
        big = np.flatnonzero(out == 255)
        out[big] = self.large_counts[np.searchsorted(self.large, at[big].astype(_U))].astype(np.int64)
        return out


# --- level two: pairs ---------------------------------------------------------------------------------------------------


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and the codebook: the means of bins of equal width, so that no value is off by more than a bin."""
    if not len(x):
        return np.zeros(0, np.uint8), np.zeros(STEPS, np.float32)
    low, width = x.min(), max(float(x.max() - x.min()), 1e-9) / STEPS
    code = np.minimum((x - low) / width, STEPS - 1).astype(np.uint8)
    n = np.bincount(code, minlength=STEPS)
    book = np.bincount(code, x, minlength=STEPS) / np.maximum(n, 1)
    return code, book.astype(np.float32)


def encode_pairs(context: np.ndarray, word: np.ndarray, logp: np.ndarray, words: int, backoff: np.ndarray) -> bytes:
    """``context``: places within the shard of ``words`` words, ascending; ``backoff``: log10 by place."""
    pointers = np.searchsorted(context, np.arange(words + 1)).astype(_U)
    # each range stands above the value that ended the one before
    ends = pointers[1:][np.diff(pointers) > 0].astype(np.int64) - 1
    steps = word[ends].astype(np.int64) + 1
    base = np.repeat(np.concatenate([[0], np.cumsum(steps)[:-1]]), np.diff(np.concatenate([[-1], ends]))) if len(ends) else np.zeros(0, np.int64)
    values = (base + word.astype(np.int64) + 1).astype(_U)
    p_code, p_book = quantise(logp)
    b_code, b_book = quantise(backoff)
    parts = [encode(pointers, len(word) + 1), encode(values, int(values[-1]) + 1 if len(values) else 1), p_book.tobytes(), b_book.tobytes(), p_code.tobytes() + b"\0" * (-len(p_code) % 8), b_code.tobytes()]
    return struct.pack("<QQQQ", len(word), words, len(parts[0]), len(parts[1])) + b"".join(parts)


class PairLevel:
    def __init__(self, data: memoryview):
        self.n, self.words, a, b = struct.unpack_from("<QQQQ", data)
        self.pointers, self.values = EliasFano(data, 32), EliasFano(data, 32 + a)
        at = 32 + a + b
        self.p_book = np.frombuffer(data, np.float32, STEPS, at)
        self.b_book = np.frombuffer(data, np.float32, STEPS, at + 4 * STEPS)
        at += 8 * STEPS
        self.p_code = np.frombuffer(data, np.uint8, self.n, at)
        self.b_code = np.frombuffer(data, np.uint8, self.words, at + self.n + -self.n % 8)

    def query(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For contexts in ascending order: log10 p(word | context), NaN where the pair isn't there (-1: no word), the context's log10 back-off, the pair's place (-1: none) and its rank in the context's range."""
        begins = runs(context)
        of = context[begins]
        owner = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(context))))
        ends = self.pointers.access(np.stack([of, of + 1], axis=1).ravel()).astype(np.int64).reshape(-1, 2)
        base = np.zeros(len(of), _U)
        later = np.flatnonzero((ends[:, 0] > 0) & (ends[:, 0] < ends[:, 1]))
        base[later] = self.values.access(ends[later, 0] - 1)
        backoff = self.b_book[self.b_code[of]].astype(float)[owner]
        logp, place, rank = np.full(len(context), np.nan), np.full(len(context), -1, np.int64), np.full(len(context), -1, np.int64)
        going = np.flatnonzero((word >= 0) & (ends[:, 0] < ends[:, 1])[owner])
        mine = owner[going]
        at, hit = self.values.find(base[mine] + word[going].astype(_U) + _U(1))
        hit &= at < ends[mine, 1]
        going, mine, at = going[hit], mine[hit], at[hit]
        logp[going] = self.p_book[self.p_code[at]]
        place[going], rank[going] = at, at - ends[mine, 0]
        return logp, backoff, place, rank

    def successors(self) -> np.ndarray:
        """The successors of all pairs: what their values stand above their range's base."""
        pointers, values = self.pointers.all().astype(np.int64), self.values.all().astype(np.int64)
        sizes = np.diff(pointers)
        full = np.flatnonzero(sizes)
        base = np.where(pointers[full] > 0, values[np.maximum(pointers[full] - 1, 0)], 0)
        return values - np.repeat(base, sizes[full]) - 1


# --- the model ----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LanguageModel:
    """The manifest: where the levels lie, and what their words' numbers start from."""

    path: str
    shards: int
    starts: tuple[int, ...]  # a shard's first word's number; the last is the number of words
    tokens: int
    pairs: int = 0
    min_count: int = 2
    order: int = 2
    pair_starts: tuple[int, ...] = ()  # a shard's first pair's number
    triples: int = 0

    @property
    def distinct(self) -> int:
        return self.starts[-1]

    @property
    def step(self) -> int:
        """How many pairs a shard of triples begins with."""
        return max(1, -(-self.pairs // self.shards))


class Trie:
    """A worker's view of a model: levels mapped as they are asked for."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.levels: dict[tuple[str, int], WordLevel | PairLevel] = {}
        self.memo: dict[bytes, int] = {}
        self.numbers = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def level(self, kind: str, s: int) -> WordLevel | PairLevel:
        if (kind, s) not in self.levels:
            self.levels[kind, s] = (WordLevel if kind == "words" else PairLevel)(common.read_file(f"{self.model.path}/{kind}-{s:06d}"))
        return self.levels[kind, s]

    def by_shard(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = grouped(shard)
        s = shard[order]
        begins = runs(s)
        for a, b in zip(begins, [*begins[1:], len(s)]):
            yield int(s[a]), order[a:b]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: unknown) and counts of words by hash."""
        number, count, starts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64), self.model.starts
        for s, i in self.by_shard(shard_of(hashes, self.model.shards)):
            if starts[s + 1] == starts[s]:
                continue
            level = self.level("words", s)
            at = level.find(hashes[i])
            hit = at >= 0
            number[i[hit]] = at[hit] + starts[s]
            count[i[hit]] = level.counts(at[hit])
        return number, count

    def counts_of(self, numbers: np.ndarray) -> np.ndarray:
        out, starts = np.zeros(len(numbers), np.int64), np.array(self.model.starts, np.int64)
        for s, i in self.by_shard(np.searchsorted(starts, numbers, "right") - 1):
            out[i] = self.level("words", s).counts(numbers[i] - starts[s])
        return out

    def pairs_of(self, number: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where a token follows a known word, grouped by that; and for these log10 p (NaN where the pair isn't there), the word's back-off, the pair's number and its rank among the word's successors (-1: none)."""
        at = np.flatnonzero(~first & (np.concatenate([[-1], number[:-1]]) >= 0))
        at = at[grouped(number[at - 1])]
        context, word, starts = number[at - 1], number[at], self.model.starts
        logp, backoff, pair, rank = np.empty(len(at)), np.empty(len(at)), np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        cuts = np.searchsorted(context, np.array(starts))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            i = slice(cuts[s], cuts[s + 1])
            logp[i], backoff[i], place, rank[i] = self.level("pairs", s).query(context[i] - starts[s], word[i])
            if self.model.order > 2:
                pair[i] = np.where(place >= 0, place + self.model.pair_starts[s], -1)
        return at, logp, backoff, pair, rank

    def after_pairs(self, at: np.ndarray, pair: np.ndarray, rank: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where a token follows a pair of the model, grouped by that; the pair's number, and the token's rank among its second word's successors (-1: none)."""
        pairs, ranks = np.full(len(first), -1, np.int64), np.full(len(first), -1, np.int64)
        pairs[at], ranks[at] = pair, rank
        at = np.flatnonzero(~first & (np.concatenate([[-1], pairs[:-1]]) >= 0))
        at = at[grouped(pairs[at - 1])]
        return at, pairs[at - 1], ranks[at]

    def trigrams(self, pair: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For pairs in ascending order: log10 p of the word of that rank, NaN where the triple isn't there, and the pair's back-off."""
        logp, backoff, step = np.empty(len(pair)), np.empty(len(pair)), self.model.step
        cuts = np.searchsorted(pair, np.arange(self.model.shards + 1) * step)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            i = slice(cuts[s], cuts[s + 1])
            logp[i], backoff[i], _, _ = self.level("triples", s).query(pair[i] - s * step, rank[i])
        return logp, backoff

    def contexts_of(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The second words of the pairs numbered from ``lo`` to ``hi``."""
        starts = self.model.pair_starts
        shards = [s for s in range(self.model.shards) if starts[s] < hi and starts[s + 1] > lo]
        found = [self.level("pairs", s).successors()[max(lo - starts[s], 0) : hi - starts[s]] for s in shards]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def log_of(self, word: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """log10 p of the pair of a word and its successor of that rank."""
        out, starts = np.empty(len(word)), self.model.starts
        order = grouped(word)
        word, rank = word[order], rank[order]
        cuts = np.searchsorted(word, np.array(starts))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            i = slice(cuts[s], cuts[s + 1])
            level, own = self.level("pairs", s), word[i] - starts[s]
            begins = runs(own)
            begin = np.repeat(level.pointers.access(own[begins]).astype(np.int64), np.diff(np.append(begins, len(own))))
            out[order[i]] = level.p_book[level.p_code[begin + rank[i]]]
        return out

    @common.without_gc
    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and counts of all tokens, and how many each text has; a text's last token is the end."""
        lists = [common.lower_words_of(t) for t in texts]
        for words in lists:
            words.append(b"")
        if len(self.memo) > WORDS_HELD:
            self.memo, self.numbers, self.counts = {}, np.zeros(0, np.int64), np.zeros(0, np.int64)
        memo, flat = self.memo, list(chain.from_iterable(lists))
        # one look at the memo per token: it is too large for the CPU's caches
        rows = np.fromiter(map(memo.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(rows < 0).tolist()
        new = list({flat[i] for i in missing})
        number, count = self.find(np.array([xxhash.xxh64_intdigest(w) for w in new], _U))
        memo.update(zip(new, range(len(memo), len(memo) + len(new))))
        self.numbers, self.counts = np.concatenate([self.numbers, number]), np.concatenate([self.counts, count])
        rows[missing] = [memo[flat[i]] for i in missing]
        return self.numbers[rows], self.counts[rows], np.array([len(w) for w in lists], np.int64)

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """For each text: tokens, known tokens, base score, the model's score."""
        return self.score_tokens(*self.tokens(texts))

    def score_tokens(self, number: np.ndarray, count: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """The same of texts given as numbers (-1: unknown), counts and how many tokens each has."""
        model = self.model
        begins = np.cumsum(sizes) - sizes
        base = np.log10((count + 1) / (model.tokens + model.distinct + 1))
        score = base.copy()
        first = np.zeros(len(number), bool)
        first[begins] = True
        at, logp, backoff, pair, rank = self.pairs_of(number, first)
        score[at] = np.where(np.isnan(logp), backoff + base[at], logp)
        if model.order > 2:
            at, pair, rank = self.after_pairs(at, pair, rank, first)
            logp, backoff = self.trigrams(pair, rank)
            score[at] = np.where(np.isnan(logp), backoff + score[at], logp)
        total = np.add.reduceat
        return sizes, total((count > 0).astype(np.int64), begins), total(base, begins), total(score, begins)


def trie(model: LanguageModel) -> Trie:
    """A worker's trie of a model's files; while the model is trained, its manifest grows."""
    held = common.held(("trie", model.path), lambda: Trie(model))
    held.model = model
    return held


# --- texts as numbers ---------------------------------------------------------------------------------------------------


class Dictionary:
    """Words in the order they come, with what they occur in training texts."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}"
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.counts = np.zeros(0, np.int64)

    @common.without_gc
    def tokens(self, texts: list[str | None], train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All tokens' numbers, and how many each text has; a text's last token is the end."""
        lists = [common.lower_words_of(t) for t in texts]
        for words in lists:
            words.append(b"")
        sizes = np.array([len(w) for w in lists], np.int64)
        flat = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(lists)), np.uint32, int(sizes.sum()))
        counts = np.bincount(flat[np.repeat(train, sizes)], minlength=len(self.numbers))
        counts[: len(self.counts)] += self.counts
        self.counts = counts
        return flat, sizes

    def write(self) -> None:
        write_columns(self.uri, np.array([xxhash.xxh64_intdigest(w) for w in self.numbers], _U), self.counts)


def write_columns(uri: str, one: np.ndarray, two: np.ndarray) -> None:
    """Of a dictionary's words: hashes and training counts, or under its name with ``.numbers`` the model's numbers and counts."""
    parts = pack(one), pack(two)
    common.write_file(uri, struct.pack("<Q", len(parts[0])) + b"".join(parts))


def read_columns(uri: str) -> tuple[np.ndarray, np.ndarray]:
    data = bytes(common.read_file(uri))
    (n,) = struct.unpack_from("<Q", data)
    return unpack(data[8 : 8 + n]), unpack(data[8 + n :])


def tokenize(docs: DataFrame, *, text: str = "text", train: Column | None = None) -> tuple[DataFrame, str]:
    """``docs`` without ``text``, and with ``__tokens`` (numbers, 32 bits each, in the dictionary ``__dictionary``) and ``__train``, whether a row teaches (all do unless ``train`` says); written once."""
    spark = docs.sparkSession
    common.ship(spark)
    path = common.fresh_dir(spark, "lm")
    folder = f"{path}/dictionaries"
    rest = [c for c in docs.columns if c != text]
    rows = docs.select(*rest, F.col(text).cast("string").alias("__text"), (F.lit(True) if train is None else F.coalesce(train, F.lit(False))).alias("__train"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Dictionary(folder)
        for b in common.slices(batches, TEXTS):
            if len(held.numbers) > WORDS_HELD:
                held.write()
                held = Dictionary(folder)
            flat, sizes = held.tokens(b["__text"].to_pylist(), b["__train"].to_numpy(zero_copy_only=False))
            ends = np.concatenate([[0], np.cumsum(sizes)]) * 4
            tokens = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([*(b[c] for c in rest), b["__train"], tokens, pa.array([held.uri] * len(sizes))], [*rest, "__train", "__tokens", "__dictionary"])
        if len(held.numbers):
            held.write()

    made = rows.mapInArrow(number, f"{schema}{', ' if schema else ''}__train boolean, __tokens binary, __dictionary string")
    made.write.option("compression", "zstd").parquet(f"{path}/tokens")
    return spark.read.schema(made.schema).parquet(f"{path}/tokens"), path


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of ``tokenize``'s rows, a dictionary each, with their tokens' numbers in the model, counts, and how many each text has."""
    uri, numbers, counts = None, None, None
    for b in common.slices(batches, TEXTS):
        for a, e in _stretches(b["__dictionary"].to_pylist()):
            part = b.slice(a, e - a)
            if (now := part["__dictionary"][0].as_py()) != uri:
                uri = now
                numbers, counts = (x.view(np.int64) for x in read_columns(f"{uri}.numbers"))
            tokens = part["__tokens"]
            offsets = np.frombuffer(tokens.buffers()[1], np.int32, len(tokens) + 1, tokens.offset * 4)
            flat = np.frombuffer(tokens.buffers()[2], np.uint32)[offsets[0] // 4 : offsets[-1] // 4]
            yield part, numbers[flat], counts[flat], np.diff(offsets).astype(np.int64) // 4


def _stretches(values: list) -> Iterator[tuple[int, int]]:
    begin = 0
    for i in range(1, len(values) + 1):
        if i == len(values) or values[i] != values[begin]:
            yield begin, i
            begin = i


# --- training -----------------------------------------------------------------------------------------------------------


def by_shard(rows: DataFrame, shards: int) -> DataFrame:
    return rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard")  # a shard is a task: by hash, some tasks would get several


def sizes_of(rows: list, shards: int) -> np.ndarray:
    sizes = np.zeros(shards, np.int64)
    for r in rows:
        sizes[r["shard"]] = r["n"]
    return sizes


def done_batch(done: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.int64()) for i in range(3)], ["shard", "n", "tokens"])


DONE = "shard long, n long, tokens long"


def learn(tokens: DataFrame, path: str, *, min_count: int = 1, order: int = 3, shards: int | None = None) -> LanguageModel:
    """Write the levels for ``tokenize``'s rows that teach: words and pairs, with ``order`` 3 triples too; ``min_count`` 1 keeps all. As many shards as the rows have partitions unless said otherwise."""
    common.ship(tokens.sparkSession)
    shards = shards or max(1, tokens.rdd.getNumPartitions())
    # one per task and so many words of it
    files = common.materialize(tokens.select(F.col("__dictionary").alias("uri")).distinct(), "dictionaries").repartition(shards)
    taught = tokens.where("__train").select("__tokens", "__dictionary")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b["uri"].to_pylist():
                hashes, counts = read_columns(uri)
                keys, counts = summed(hashes[counts > 0], counts[counts > 0])
                shard = shard_of(keys, shards)
                begins = runs(shard)
                yield blobs([(int(shard[a]), keys[a:b], counts[a:b]) for a, b in zip(begins, [*begins[1:], len(keys)])])

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for s, keys, counts in merged(batches):
            common.write_file(f"{path}/words-{s:06d}", encode_words(keys, counts))
            done.append((s, len(keys), int(counts.sum())))
        yield done_batch(done)

    got = by_shard(files.mapInArrow(count_words, BLOBS), shards).mapInArrow(write_words, DONE).collect()
    starts = (0, *np.cumsum(sizes_of(got, shards)).tolist())
    model = LanguageModel(path, shards, starts, sum(r["tokens"] for r in got), min_count=min_count, order=2)
    # a key is a context's place within its shard, and a word
    wide = max(model.distinct, 1)
    if max(b - a for a, b in zip(starts, starts[1:])) * wide >= 2**64:
        raise ValueError("more words in a shard than a pair's key can hold: ask for more shards")

    def number_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for b in batches:
            for uri in b["uri"].to_pylist():
                numbers, counts = trie(model).find(read_columns(uri)[0])
                write_columns(f"{uri}.numbers", numbers, counts)
                done.append((0, len(numbers), 0))
        yield done_batch(done)

    files.mapInArrow(number_words, DONE).collect()

    def counter(keys_of: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]):
        """Shards and keys of texts' tokens (numbers, counts, whether a text's first), sorted and summed by a task before they move."""

        def sum_up(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            shard, keys = (np.concatenate(x) for x in zip(*held))
            order = grouped(shard)
            shard, keys = shard[order], keys[order]
            parts, begins = [], runs(shard)
            for a, b in zip(begins, [*begins[1:], len(keys)]):
                mine = np.sort(keys[a:b])
                at = runs(mine)
                parts.append((int(shard[a]), mine[at], np.diff(np.append(at, len(mine))).astype(_U)))
            return blobs(parts)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for _, number, counts, sizes in numbered(batches):
                first = np.zeros(len(number), bool)
                first[np.cumsum(sizes) - sizes] = True
                held.append(keys_of(number, counts, first))
                n += len(held[-1][1])
                if n > PAIRS_HELD:
                    yield sum_up(held)
                    held, n = [], 0
            if n:
                yield sum_up(held)

        return count

    def pair_keys(number: np.ndarray, count: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # a pair can't occur oftener than either of its words
        often = count >= min_count
        at = np.flatnonzero(~first & often & np.concatenate([[False], often[:-1]]))
        bounds, context = np.array(starts), number[at - 1]
        shard = np.searchsorted(bounds, context, "right") - 1
        return shard.astype(np.int32), (context - bounds[shard]).astype(_U) * _U(wide) + number[at].astype(_U)

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for s, keys, counts in merged(batches):
            kept = counts >= min_count
            keys, n = keys[kept], counts[kept].astype(float)
            place, word, words = (keys // _U(wide)).astype(np.int64), (keys % _U(wide)).astype(np.int64), starts[s + 1] - starts[s]
            t = trie(model)
            of_context = t.level("words", s).counts(np.arange(words)).astype(float)
            left = 1 - np.bincount(place, n - DISCOUNT, minlength=words) / of_context
            low = (t.counts_of(word) + 1) / (model.tokens + model.distinct + 1)
            logp = np.log10((n - DISCOUNT) / of_context[place] + left[place] * low)
            common.write_file(f"{path}/pairs-{s:06d}", encode_pairs(place, word, logp, words, np.log10(np.maximum(left, 1e-9))))
            most = int(np.diff(np.append(runs(place), len(place))).max(initial=0))
            done.append((s, len(keys), most))
        yield done_batch(done)

    got = by_shard(taught.mapInArrow(counter(pair_keys), BLOBS), shards).mapInArrow(write_pairs, DONE).collect()
    for s in {*range(shards)} - {r["shard"] for r in got}:  # shards whose words are no frequent context
        words = starts[s + 1] - starts[s]
        common.write_file(f"{path}/pairs-{s:06d}", encode_pairs(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), words, np.zeros(words)))
    sizes = sizes_of(got, shards)
    model = replace(model, pairs=int(sizes.sum()), order=order, pair_starts=(0, *np.cumsum(sizes).tolist()))
    if order < 3:
        return model
    step = model.step
    # ranks stay below the most successors that a word has; the one after them stands for words left out
    ranks = max((r["tokens"] for r in got), default=0) + 1
    if step * ranks >= 2**64:
        raise ValueError("more pairs in a shard than a triple's key can hold: ask for more shards")

    def triple_keys(number: np.ndarray, count: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t = trie(model)
        at, _, _, pair, rank = t.pairs_of(number, first)
        _, pair, rank = t.after_pairs(at, pair, rank, first)
        shard = pair // step
        return shard.astype(np.int32), (pair - shard * step).astype(_U) * _U(ranks) + np.where(rank < 0, ranks - 1, rank).astype(_U)

    def write_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for s, keys, counts in merged(batches):
            t, contexts = trie(model), min(step, model.pairs - s * step)
            place, rank, n = (keys // _U(ranks)).astype(np.int64), (keys % _U(ranks)).astype(np.int64), counts.astype(float)
            # a pair is followed by one token wherever it stands, but for those that end a text
            of_context = np.maximum(np.bincount(place, n, minlength=contexts), 1)
            kept = (counts >= min_count) & (rank < ranks - 1)
            place, rank, n = place[kept], rank[kept], n[kept]
            left = 1 - np.bincount(place, n - DISCOUNT, minlength=contexts) / of_context
            low = t.log_of(t.contexts_of(s * step, s * step + contexts)[place], rank)
            logp = np.log10((n - DISCOUNT) / of_context[place] + left[place] * 10**low)
            common.write_file(f"{path}/triples-{s:06d}", encode_pairs(place, rank, logp, contexts, np.log10(np.maximum(left, 1e-9))))
            done.append((s, len(place), 0))
        yield done_batch(done)

    got = by_shard(taught.mapInArrow(counter(triple_keys), BLOBS), shards).mapInArrow(write_triples, DONE).collect()
    for s in {*range(shards)} - {r["shard"] for r in got}:  # shards whose pairs only end texts
        contexts = max(0, min(step, model.pairs - s * step))
        common.write_file(f"{path}/triples-{s:06d}", encode_pairs(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), contexts, np.zeros(contexts)))
    return replace(model, triples=sum(r["n"] for r in got))


def train(docs: DataFrame, *, text: str = "text", min_count: int = 2, order: int = 2, shards: int | None = None) -> LanguageModel:
    """The model of all of ``docs``; see ``learn``."""
    tokens, path = tokenize(docs.select(text), text=text)
    return learn(tokens, path, min_count=min_count, order=order, shards=shards)


# --- scores -------------------------------------------------------------------------------------------------------------

SCORES = {"n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double"}


def with_lm_score(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score and score; columns of these names are replaced. One pass, no shuffle."""
    common.ship(docs.sparkSession)

    @F.pandas_udf(", ".join(f"{k} {v}" for k, v in SCORES.items()))
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            values = s.tolist()
            parts = [pd.DataFrame(dict(zip(SCORES, trie(model).score(values[i : i + TEXTS])))) for i in range(0, len(values), TEXTS)]
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({n: [] for n in SCORES})

    return docs.withColumn("__lm", scores(F.col(text))).withColumns({n: F.col("__lm")[n] for n in SCORES}).drop("__lm")


def scored_tokens(tokens: DataFrame, model: LanguageModel) -> DataFrame:
    """The same of ``tokenize``'s rows, after ``learn``: their columns besides the tokens, and the scores."""
    common.ship(tokens.sparkSession)
    rest = [f for f in tokens.schema if f.name not in ("__tokens", "__dictionary", *SCORES)]

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, number, counts, sizes in numbered(batches):
            made = trie(model).score_tokens(number, counts, sizes)
            yield pa.RecordBatch.from_arrays([*(part[f.name] for f in rest), *(pa.array(x) for x in made)], [*(f.name for f in rest), *SCORES])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + [f"{k} {v}" for k, v in SCORES.items()])
    return tokens.mapInArrow(scores, schema)


def training_rows(key: str = "doc_id", held: int = 2, folds: int = 7) -> Column:
    """Rows outside the held-out fold by crc32 of the id as text; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary")) % folds != held
