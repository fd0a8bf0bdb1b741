"""Periodic runs of words: stretches that repeat with a period, found in whole texts and collapsed to one period.

A run is a stretch of consecutive words whose smallest period is q, at least ``max(6, 4 q)`` long, that no word beside it extends.
Words q apart match; a run of period q is an island of ``max(5, 3 q)`` or more matches in a row at lag q. How many matches a lag has in
all is counted first, exactly, from all words at once: words that occur often add their indicator's power spectrum, and one
inverse transform gives all lags (whole numbers below 2^40, so rounding is exact); rare words add the differences of their places. Which words are
often is decided by cost for each text. Only lags with enough matches for an island are scanned, shortest first; those that lie in runs
of a period that divides the lag are taken off before, so that a long run isn't scanned at each multiple of its period: two stretches that
share q + 1 words, one with period q and one with a divisor of q, are one run of the divisor.

Null and empty texts have no words and no runs. Each row is judged by itself, in one pass without a shuffle, so that repeated rows, ties and null keys
need no more. A text is one task's work: some n^1.5 steps for n words. Only key and text are read, so that other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: A run's least length in words and in periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Nanoseconds, about, that a pair of places and a point of a transform (times its logarithm) take.
PAIR_NS, POINT_NS = 6.0, 1.5


def numbers_of(words: list[bytes]) -> np.ndarray:
    """Equal words, equal numbers from 0."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def matches_by_lag(codes: np.ndarray, most: int) -> np.ndarray:
    """For each lag up to ``most`` the number of i with ``codes[i] == codes[i + lag]``; lag 0 isn't counted."""
    n = len(codes)
    times = np.bincount(codes)
    by_times = np.argsort(-times, kind="stable")
    falling = times[by_times]
    size = 1 << (n + most).bit_length()
    transform = POINT_NS * size * size.bit_length()
    # heavy words are the first h of the falling order: h transforms against the pairs of the rest
    pairs = np.concatenate([np.cumsum((falling.astype(float) ** 2)[::-1])[::-1], [0.0]]) * PAIR_NS / 2
    heavy = int(np.argmin(pairs + transform * np.arange(len(pairs))))
    out = np.zeros(most + 1, np.int64)
    rank = np.empty_like(by_times)
    rank[by_times] = np.arange(len(by_times))
    ranks = rank[codes]
    if heavy:
        power = np.zeros(size // 2 + 1)
        for h in range(heavy):
            spectrum = np.fft.rfft((ranks == h).astype(float), size)
            power += spectrum.real**2 + spectrum.imag**2
        out += np.rint(np.fft.irfft(power, size)[: most + 1]).astype(np.int64)
    # places of the others, commonest word first: words with more than j places are a prefix
    order = np.argsort(ranks, kind="stable")[int(falling[:heavy].sum()) :]
    of, light = ranks[order], falling[heavy:]
    until = np.cumsum(light)
    for j in range(1, int(light[0]) if len(light) else 0):
        end = int(until[np.searchsorted(-light, -j, side="left") - 1])  # words with over j places
        apart = order[j:end] - order[: end - j]
        apart = apart[(of[j:end] == of[: end - j]) & (apart <= most)]
        out += np.bincount(apart, minlength=most + 1)
    out[0] = 0
    return out


def primitive(block: np.ndarray) -> bool:
    """Whether a block is no shorter block's repetition."""
    q = rest = len(block)
    r = 2
    while rest > 1:
        if r * r > rest:
            r = rest
        if rest % r == 0:
            d = q // r
            if (block[d:] == block[:-d]).all():
                return False
            while rest % r == 0:
                rest //= r
        r += 1
    return True


def islands(equal: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Start and length of stretches of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    start, length = edges[::2], edges[1::2] - edges[::2]
    long = length >= least
    return list(zip(start[long].tolist(), length[long].tolist()))


def runs_of(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """start, length and period of every run, by start, then period."""
    n = len(codes)
    most = n // LEAST_PERIODS
    if n < LEAST_WORDS:
        return []
    lags = np.arange(most + 1)
    need = np.maximum(LEAST_WORDS - lags, (LEAST_PERIODS - 1) * lags)
    left = matches_by_lag(codes, most)
    out = []
    for q in np.flatnonzero(left[1:] >= need[1:]) + 1:
        if left[q] < need[q]:
            continue
        q = int(q)
        for start, matched in islands(codes[q:] == codes[:-q], int(need[q])):
            if primitive(codes[start : start + q]):
                length = matched + q
                out.append((start, length, q))
                multiples = lags[2 * q : min(length, most + 1) : q]
                left[multiples] -= length - multiples
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def find_runs(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, n_words, runs (an array of start, length, period) and the collapsed text, its words parted by single spaces."""
    common.ship(docs.sparkSession)

    @F.arrow_udf("struct<n_words long, runs array<struct<start long, length long, period long>>, collapsed string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for t in texts.to_pylist():
                words = common.words_of(t)
                runs = runs_of(numbers_of(words))
                rows.append((len(words), runs, b" ".join(collapsed(words, runs))))
            flat = [r for _, runs, _ in rows for r in runs]
            inner = pa.StructArray.from_arrays([pa.array([r[i] for r in flat], pa.int64()) for i in range(3)], ["start", "length", "period"])
            ends = np.cumsum([0, *(len(runs) for _, runs, _ in rows)]).astype(np.int32)
            texts_left = pa.array([c for _, _, c in rows], pa.binary()).cast(pa.string())
            yield pa.StructArray.from_arrays([pa.array([n for n, _, _ in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), inner), texts_left], ["n_words", "runs", "collapsed"])

    name = common.unused(docs.select(key), "found")
    return docs.select(F.col(key), found(F.col(text)).alias(name)).select(key, *[F.col(name)[c].alias(c) for c in ("n_words", "runs", "collapsed")])


def strongest(runs: str = "runs"):
    """The run of greatest length/period, exactly; ties: smallest start, then period. Null without runs. Products stay below 2^63 for texts under 2^31 words."""
    better = "(x.length * y.period > y.length * x.period)"
    return F.expr(f"aggregate({runs}, cast(null as struct<start:bigint,length:bigint,period:bigint>), (y, x) -> CASE WHEN y IS NULL OR {better} THEN x ELSE y END)")


def digests(found: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """The key, n_runs, the strongest run with its exponent in thousandths, and digests of the runs and of the collapsed text."""
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    rows = found.select(F.col(key), F.size("runs").cast("long").alias("n_runs"), strongest().alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select(key, "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
