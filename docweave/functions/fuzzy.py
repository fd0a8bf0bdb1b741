"""Partial ratios, exactly: how well a shorter text fits its best place in a longer one.

The ratio of two texts is ``100 * 2 L / (a + b)``, a and b being their lengths and L the length of their longest common subsequence. The
partial ratio is the best ratio of the shorter text with any window of its length in the longer one, and with the shorter
windows at both ends; for texts of one length either may be the one with windows. An empty text fits nowhere (0).

All windows of all texts that are compared with one needle are worked out at once: the texts lie in one array, parted by as many blanks as the needle is long
less one, so that a window that hangs over an end is one of the shorter ones. The needle's characters are bits of machine words; the recurrence
``v = (v + (v & m)) | (v - (v & m))`` takes every window one character on, and zeros of v count the subsequence at the end. Needles over 64 characters
take more words, with the carry handed on. Memory is bounded: texts are taken in parts of ``CHARS`` characters, those longer in stretches that overlap.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import runs_on_executors

runs_on_executors(__name__)

#: Characters, and with them windows, that are worked out at once: the CPU's caches hold these arrays.
CHARS = 16_384
#: Characters of a part of the texts that a best needle is looked for together.
PART = 65_536


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def subsequences(needle: np.ndarray, line: np.ndarray, windows: int) -> np.ndarray:
    """For each of the first ``windows`` places of ``line`` the longest common subsequence of the needle with as many characters from there on."""
    m = len(needle)
    words = -(-m // 64)
    letters, of = np.unique(needle, return_inverse=True)
    bits = np.zeros((words, len(letters) + 1), np.uint64)
    for i, c in enumerate(of):
        bits[i // 64, c] |= np.uint64(1 << i % 64)
    at = np.searchsorted(letters, line).clip(max=len(letters) - 1)
    at[letters[at] != line] = len(letters)
    masks = bits[:, at]
    v = np.full((words, windows), ~np.uint64(0))
    for j in range(m):
        carry = None
        for w in range(words):
            x = v[w]
            u = x & masks[w, j : j + windows]
            total = x + u
            if words > 1:
                over = total < x
                if carry is not None:
                    total += carry
                    over |= total < carry
                carry = over.astype(np.uint64)
            np.subtract(x, u, out=x)  # x & ~mask
            np.bitwise_or(x, total, out=x)
    zeros = np.bitwise_count(~v).astype(np.int64)
    if m % 64:
        zeros[-1] = np.bitwise_count(~v[-1] & np.uint64((1 << m % 64) - 1))
    return zeros.sum(0)


def _in_windows(needle: np.ndarray, texts: Sequence[np.ndarray], begun: Sequence[bool] = (), ended: Sequence[bool] = ()) -> np.ndarray:
    """The best ratio of the needle with each text's windows; no text is shorter. Stretches that do not begin or end their text have no shorter windows there."""
    m = len(needle)
    blank = np.uint32(0xFFFFFFFF)  # no character
    gap = np.full(m - 1, blank)
    line = np.concatenate([gap, *[part for t in texts for part in (t, gap)]])
    lengths = np.array([len(t) for t in texts])
    begins = m - 1 + np.concatenate([[0], np.cumsum(lengths + m - 1)[:-1]])  # of texts in the line
    shown = np.concatenate([[0], np.cumsum(line != blank)])
    windows = len(line) - m + 1
    found = subsequences(needle, line, windows)
    ratio = 2.0 * found / (m + shown[m : m + windows] - shown[:windows])
    for at, n, first, last in zip(begins, lengths, begun, ended):
        if not first:
            ratio[at - m + 1 : at] = 0
        if not last:
            ratio[at + n - m + 1 : at + n] = 0
    # a text's windows begin m - 1 places before it; the last one holds its last character alone
    return np.maximum.reduceat(ratio, begins - m + 1)


def partial_ratios(needle: str, texts: Sequence[str]) -> np.ndarray:
    """The partial ratio of the needle with each text, 0 to 100, whichever is the shorter."""
    out = np.zeros(len(texts))
    if not needle:
        return out
    one = codes(needle)
    m = len(one)
    parts: list[tuple[int, np.ndarray, bool, bool]] = []
    for i, t in enumerate(texts):
        t = codes(t)
        if 0 < len(t) <= m:
            out[i] = _in_windows(t, [one])[0]
        if len(t) >= m:
            # a stretch holds the windows that begin in it
            parts += [(i, t[lo : lo + CHARS + m - 1], lo == 0, lo + CHARS + m - 1 >= len(t)) for lo in range(0, len(t) - m + 1, CHARS)]
    lo = 0
    while lo < len(parts):
        hi, held = lo, 0
        while hi < len(parts) and (hi == lo or held < CHARS):
            held += len(parts[hi][1]) + m
            hi += 1
        rows, stretches, begun, ended = zip(*parts[lo:hi])
        np.maximum.at(out, list(rows), _in_windows(one, stretches, begun, ended))
        lo = hi
    return 100 * out


def partial(one: str, two: str) -> float:
    return float(partial_ratios(one, [two])[0])


@F.pandas_udf(T.DoubleType())
def partial_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Of two columns; rows with the same text in the second are worked out together. A null with anything: null."""
    for a, b in batches:
        out = np.full(len(a), np.nan)
        by_needle: defaultdict[str, list[int]] = defaultdict(list)
        one, two = a.tolist(), b.tolist()
        for i, (x, y) in enumerate(zip(one, two)):
            if x is not None and y is not None:
                by_needle[y].append(i)
        for needle, rows in by_needle.items():
            out[rows] = partial_ratios(needle, [one[i] for i in rows])
        yield pd.Series(out).astype(object).where(~np.isnan(out), None)


def _texts_in_one(needle: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The best ratio of each of ``texts``, a row of codes each, none longer than the needle, with the needle's windows of their length."""
    many, n = texts.shape
    words = -(-n // 64)
    letters, of = np.unique(needle, return_inverse=True)
    at = np.searchsorted(letters, texts).clip(max=len(letters) - 1)
    at[letters[at] != texts] = len(letters)
    bits = np.zeros((words, many, len(letters) + 1), np.uint64)
    rows = np.arange(many)
    for i in range(n):
        bits[i // 64, rows, at[:, i]] |= np.uint64(1 << i % 64)
    bits[:, :, -1] = 0  # no letter of the needle, and the blanks around it
    line = np.full(len(needle) + 2 * (n - 1), len(letters))
    line[n - 1 : n - 1 + len(needle)] = of
    windows = len(needle) + n - 1
    shown = np.minimum(np.minimum(np.arange(1, windows + 1), n), np.arange(windows, 0, -1))
    return (2.0 * _longest(bits[:, :, line], n, windows) / (n + shown)).max(1)


def _longest(masks: np.ndarray, m: int, windows: int, stride: int = 1) -> np.ndarray:
    """Longest common subsequences of m characters, whose places are bits of ``masks``' words, with every ``stride``-th window of the masks' last axis."""
    words = len(masks)
    stop = windows - 1
    v = np.full((words, *masks.shape[1:-1], stop // stride + 1), np.iinfo(masks.dtype).max, masks.dtype)
    for j in range(m):
        carry = None
        for w in range(words):
            x = v[w]
            u = x & masks[w, ..., j : j + stop + 1 : stride]
            total = x + u
            if words > 1:
                over = total < x
                if carry is not None:
                    total += carry
                    over |= total < carry
                carry = over.astype(masks.dtype)
            np.subtract(x, u, out=x)  # x & ~mask
            np.bitwise_or(x, total, out=x)
    zeros = np.bitwise_count(~v & _whole(m, words, masks.dtype).reshape(-1, *[1] * (v.ndim - 1)))
    return zeros[0] if words == 1 else zeros.sum(0, dtype=np.uint16 if m < 30_000 else np.int64)


def _whole(m: int, words: int, kind: np.dtype) -> np.ndarray:
    """The words' bits that stand for m characters."""
    size = 8 * kind.itemsize
    return np.array([(1 << min(m - size * w, size)) - 1 for w in range(words)], kind)


def _at(masks: np.ndarray, m: int, places: np.ndarray) -> np.ndarray:
    """The same at some places."""
    taken = masks[:, places + np.arange(m)[:, None]]
    v = np.full((len(masks), len(places)), np.iinfo(masks.dtype).max, masks.dtype)
    for j in range(m):
        carry = None
        for w in range(len(masks)):
            x = v[w]
            u = x & taken[w, j]
            total = x + u
            if len(masks) > 1:
                over = total < x
                if carry is not None:
                    total += carry
                    over |= total < carry
                carry = over.astype(masks.dtype)
            np.subtract(x, u, out=x)
            np.bitwise_or(x, total, out=x)
    return np.bitwise_count(~v & _whole(m, len(masks), masks.dtype)[:, None]).sum(0, dtype=np.int64)


class _Lines:
    """Texts of at most ``CHARS`` characters in all, their characters numbered once for all needles."""

    def __init__(self, texts: list[np.ndarray]):
        self.lengths = np.array([len(t) for t in texts])
        self.letters, self.of = np.unique(np.concatenate(texts), return_inverse=True)
        self.owner = np.repeat(np.arange(len(texts)), self.lengths)
        self.gap, self.held = -1, ()

    def best(self, needle: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The needle's best ratio with each text's windows, or, where that is less than ``known``, any number less than that. No text is shorter than the needle.

        A window one place on has a subsequence longer by one at most, so every ``stride``-th window bounds those between; only those that may reach ``known`` are worked out.
        """
        m = len(needle)
        words, kind = -(-m // 64), np.uint8 if m <= 8 else np.uint16 if m <= 16 else np.uint32 if m <= 32 else np.uint64
        bits = np.zeros((words, len(self.letters) + 1), kind)
        size = 8 * np.dtype(kind).itemsize
        places = np.searchsorted(self.letters, needle).clip(max=len(self.letters) - 1)
        for i, c in enumerate(places):
            if self.letters[c] == needle[i]:
                bits[i // size, c] |= kind(1 << i % size)
        line, owner, counted, begins = self.laid_out(next((c for c in GAPS if c >= m), m) - 1)
        masks = np.take(bits, line, 1)
        windows = len(line) - m + 1
        whole = m + counted[m : m + windows] - counted[:windows]
        firsts = begins - (m - 1)
        stride = m // STRIDE if m > 32 else 1  # in up to 32 bits all windows cost less than bounds
        if stride == 1:
            return np.maximum.reduceat(2.0 * _longest(masks, m, windows) / whole, firsts)
        # the last window has one character of the last text at most: what lies beyond counts as nothing
        some = _longest(masks, m, windows, stride)
        after, r = np.append(some[1:], np.array([0], some.dtype)), np.arange(stride, dtype=some.dtype)
        most = np.minimum(some[:, None] + r, after[:, None] + (stride - r)).reshape(-1)[:windows]
        open_ = np.minimum(most, whole - m) * 2.0 >= (known[owner[:windows]] - 1e-9) * whole
        open_[::stride] = False
        again = np.flatnonzero(open_)
        if len(again) * 3 > windows:
            return np.maximum.reduceat(2.0 * _longest(masks, m, windows) / whole, firsts)
        ratio = np.zeros(windows)
        ratio[::stride] = 2.0 * some / whole[::stride]
        ratio[again] = 2.0 * _at(masks, m, again) / whole[again]
        return np.maximum.reduceat(ratio, firsts)

    def laid_out(self, gap: int) -> tuple[np.ndarray, ...]:
        """All texts in a line with ``gap`` blanks around each: letters, each window's text, letters counted, and where texts begin."""
        if self.gap != gap:
            begins = gap + np.concatenate([[0], np.cumsum(self.lengths + gap)[:-1]])
            line = np.full(begins[-1] + self.lengths[-1] + gap, len(self.letters))
            line[np.arange(len(self.of)) + gap * (self.owner + 1)] = self.of
            # a window that begins in the gap before a text may reach into that text alone
            owner = np.concatenate([np.repeat(np.arange(len(self.lengths)), self.lengths + gap), np.full(gap, len(self.lengths) - 1)])
            counted = np.concatenate([[0], np.cumsum(line != len(self.letters), dtype=np.int32)]).astype(np.int32)
            self.gap, self.held = gap, (line, owner, counted, begins)
        return self.held


#: A needle's length by its stride.
STRIDE = 6
#: Lengths of needles that share one line of texts.
GAPS = (8, 10, 12, 15, 18, 24, 32, 48, 64, 80)


def best_of(needles: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of the needle with the best partial ratio, the first of equal ones, and that ratio.

    Short needles go first, as their ratios are cheap and mostly the higher ones; of the longer ones only windows that may reach a text's best so far are worked out.
    """
    distinct = list(dict.fromkeys(texts))
    best, number = np.full(len(distinct), -1.0), np.zeros(len(distinct), np.int64)
    coded = [codes(t) for t in distinct]
    lengths = np.array([len(c) for c in coded], np.int64)
    if not needles:
        best[:] = 0

    def met(i: int, rows: np.ndarray, ratio: np.ndarray) -> None:
        better = (ratio > best[rows]) | (ratio == best[rows]) & (i < number[rows])
        best[rows[better]], number[rows[better]] = ratio[better], i

    parts, lo = [], 0
    by_length = np.argsort(lengths, kind="stable")
    ends = np.cumsum(lengths[by_length])
    while lo < len(distinct):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PART, side="right")))
        parts.append(by_length[lo:hi])
        lo = hi
    lines: dict[tuple[int, int], _Lines] = {}
    for i in sorted(range(len(needles)), key=lambda i: (len(needles[i]), i)):
        needle = codes(needles[i])
        m = len(needle)
        if not m:
            met(i, np.arange(len(distinct)), np.zeros(len(distinct)))
            continue
        for k, rows in enumerate(parts):
            n = lengths[rows]
            met(i, rows[n == 0], np.zeros((n == 0).sum()))
            short, long = rows[(n > 0) & (n <= m)], rows[n >= m]
            for length in np.unique(lengths[short]):
                alike = short[lengths[short] == length]
                step = max(CHARS // (m + 2 * int(length)), 1)
                for at in range(0, len(alike), step):
                    some = alike[at : at + step]
                    met(i, some, _texts_in_one(needle, np.stack([coded[x] for x in some])))
            if not len(long):
                continue
            if lengths[long[-1]] > PART:  # a part of its own, in stretches
                met(i, long, partial_ratios(needles[i], [distinct[x] for x in long]) / 100)
                continue
            if (k, len(long)) not in lines:
                lines = {key: held for key, held in lines.items() if key[0] != k} | {(k, len(long)): _Lines([coded[x] for x in long])}
            met(i, long, lines[k, len(long)].best(needle, best[long]))
    place = {t: i for i, t in enumerate(distinct)}
    of = np.array([place[t] for t in texts], np.int64)
    return number[of], 100 * best[of]
