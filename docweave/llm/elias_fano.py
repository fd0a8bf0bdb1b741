"""Elias-Fano coding of growing sequences as numpy arrays over mapped bytes, with access and successor for whole arrays of queries.

Each value's lower bits stand packed one after another; its upper bits are counted in unary in a bit vector: a one per value,
a zero per step of the upper part. A directory of the ones before each 64-bit word serves select on ones and, since a place
less its ones is its zeros, on zeros.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQQQ")
_U = np.uint64
#: Ones in each byte's lower bits, for select within a word: _PLACE[byte, r] is the place of its r-th one.
_PLACE = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    for _r, _i in enumerate([i for i in range(8) if _b >> i & 1]):
        _PLACE[_b, _r] = _i


def encode(values: np.ndarray, universe: int) -> bytes:
    """``values``: unsigned, in ascending order, all below ``universe``."""
    n = len(values)
    values = values.astype(_U)
    low = min(56, max(0, (universe // n).bit_length() - 1)) if n else 0
    steps = (universe >> low) + 1
    high = (values >> _U(low)).astype(np.int64) + np.arange(n)
    words = (n + steps + 63) // 64
    bits = np.zeros(words * 64, np.uint8)
    bits[high] = 1
    vector = np.packbits(bits, bitorder="little")
    ones = np.zeros(words + 1, np.uint64)
    np.cumsum(np.bitwise_count(vector.view(_U)), out=ones[1:])
    packed = np.zeros((n * low + 7) // 8 + 16, np.uint8)
    if low:
        lows = values & _U((1 << low) - 1)
        part = 2**17
        for lo in range(0, n, part):  # a bounded number of bits at a time
            x = lows[lo : lo + part]
            one = ((x[:, None] >> np.arange(low, dtype=_U)) & _U(1)).astype(np.uint8).ravel()
            at = lo * low
            done = np.packbits(np.concatenate([np.zeros(at % 8, np.uint8), one]), bitorder="little")
            packed[at // 8 : at // 8 + len(done)] |= done
    body = b"".join((vector.tobytes(), ones.tobytes(), packed.tobytes()))
    return _HEAD.pack(n, low, words, len(packed)) + body + b"\0" * (-len(body) % 8)


_ONES, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)


def select(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The place of the r-th one of each 64-bit word, by sums of its bytes' ones within one multiplication."""
    x = word - ((word >> _U(1)) & _U(0x5555555555555555))
    x = (x & _U(0x3333333333333333)) + ((x >> _U(2)) & _U(0x3333333333333333))
    sums = (((x + (x >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _ONES)  # a byte: the ones up to its end
    r = r.astype(_U)
    # the top bit stays in bytes whose sum is at most r
    shift = np.bitwise_count(((r * _ONES | _TOPS) - sums) & _TOPS).astype(_U) << _U(3)
    before = (sums << _U(8)) >> shift & _U(255)
    return shift.astype(np.int64) + _PLACE[(word >> shift & _U(255)).astype(np.int64), (r - before).astype(np.int64)]


class EliasFano:
    def __init__(self, data: memoryview, at: int = 0):
        self.n, self.low, words, packed = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        self.bits = np.frombuffer(data, np.uint8, words * 8, at)
        self.words = np.frombuffer(data, _U, words, at)
        at += words * 8
        self.ones = np.frombuffer(data, _U, words + 1, at)
        at += (words + 1) * 8
        # eight bytes from every byte on
        self.packed = np.ndarray((packed - 8,), "<u8", data, at, (1,))
        self.zeros = None
        self.last = int(self.access(np.array([self.n - 1]))[0]) >> self.low if self.n else -1
        self.end = at + packed + -(words * 8 + (words + 1) * 8 + packed) % 8

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i.astype(_U), "right") - 1
        place = word * 64 + select(self.words[word], i - self.ones[word].astype(np.int64))
        return (place - i).astype(_U) << _U(self.low) | self._lows(i)

    def all(self) -> np.ndarray:
        """All values, from one walk over the bits."""
        i = np.arange(self.n)
        return (np.flatnonzero(np.unpackbits(self.bits, bitorder="little")) - i).astype(_U) << _U(self.low) | self._lows(i)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), _U)
        bit = i * self.low
        return (self.packed[bit >> 3] >> (bit & 7).astype(_U)) & _U((1 << self.low) - 1)

    def _step(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many values have an upper part below ``h``, and up to ``h``: the ones before the h-th zero, and those right behind it."""
        if self.zeros is None:
            self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones.astype(np.int64)
        k = np.maximum(h - 1, 0)
        word = np.minimum(np.searchsorted(self.zeros, k, "right") - 1, len(self.words) - 1)
        place = np.where(h > 0, word * 64 + select(~self.words[word], k - self.zeros[word]) + 1, 0)
        end = place.copy()
        going = None  # all
        while True:
            at = end if going is None else end[going]
            word, bit = at >> 6, (at & 63).astype(_U)
            gap = ~(self.words[word] >> bit)
            run = np.bitwise_count((gap & (~gap + _U(1))) - _U(1)).astype(np.int64)
            run = np.minimum(run, 64 - bit.astype(np.int64))
            if going is None:
                end += run
                going = np.flatnonzero(bit.astype(np.int64) + run == 64)
            else:
                end[going] += run
                going = going[bit.astype(np.int64) + run == 64]
            if not len(going):
                return place - h, end - h

    def find(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first index whose value is at least ``v``, else n, and whether it is ``v``."""
        v = np.asarray(v, _U)
        if not self.n:
            return np.zeros(len(v), np.int64), np.zeros(len(v), bool)
        h = (v >> _U(self.low)).astype(np.int64)
        beyond = h > self.last
        lo, end = self._step(np.minimum(h, self.last))
        hi = end.copy()
        want = v & _U((1 << self.low) - 1)
        going = np.flatnonzero(lo < hi)
        while len(going):
            a, b = lo[going], hi[going]
            mid = (a + b) >> 1
            less = self._lows(mid) < want[going]
            a, b = np.where(less, mid + 1, a), np.where(less, b, mid)
            lo[going], hi[going] = a, b
            going = going[a < b]
        hit = (lo < end) & ~beyond
        there = np.flatnonzero(hit)
        hit[there] = self._lows(lo[there]) == want[there]
        return np.where(beyond, self.n, lo), hit

    def successor(self, v: np.ndarray) -> np.ndarray:
        """The first index whose value is at least ``v``, else n."""
        return self.find(v)[0]
