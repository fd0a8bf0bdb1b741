"""Token counts by rank-synchronous array merging.

A batch's distinct pre-tokens are held as one ragged numpy array of symbols. Each round finds every sequence's lowest-rank
pair and joins all its occurrences there at once; a sequence without a mergeable pair is done, and its symbols are counted.
That gives byte-pair encoding's result: a pair made by a merge always ranks after it, so rounds never miss a lower one.

Null texts count as empty: no bytes, no tokens. The special string counts as one token wherever it stands, as the
library does by default; no text is cut. Repeated rows and null ids are counted each; an empty table gives an empty result; columns of the results' names are replaced.
A vocabulary file with another normaliser or pre-tokeniser raises ValueError.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokenizing import cuts_anywhere

#: The vocabulary's pre-token pattern (a fixed value of this kind of tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pieces of text held by a worker.
MEMO = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such a vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {chr(b): b for b in plain}, 256
    for b in range(256):
        if chr(b) not in letters or letters[chr(b)] != b:
            letters[chr(extra)] = b
            extra += 1
    return letters


class MergeCounter:
    """Counts tokens of pre-tokens for a byte-level vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        # another normaliser or pre-tokeniser would give other counts
        steps = model["pre_tokenizer"] or {}
        if model["normalizer"] or (steps.get("type"), steps.get("add_prefix_space"), steps.get("use_regex", True)) != ("ByteLevel", False, True) or model["model"].get("ignore_merges"):
            raise ValueError("no plain byte-level vocabulary")
        self.special = [t["content"] for t in model["added_tokens"]]
        vocabulary, letters = model["model"]["vocab"], byte_letters()
        self.symbol_of_byte = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.symbol_of_byte[b] = vocabulary[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.none = len(merges)
        self.pattern = regex.compile(PATTERN)
        self.memo: dict[str, int] = {}
        self.memo_spaced: dict[str, int] = {}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def merge(self, tokens: list[bytes]) -> np.ndarray:
        """How many symbols survive in each pre-token."""
        lengths = np.array([len(t) for t in tokens], np.int64)
        counts = lengths.copy()
        symbols = self.symbol_of_byte[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), lengths)
        pair_rank = np.full(len(symbols), self.none, np.int64)
        if len(symbols) > 1:
            pair_rank[:-1] = np.where(owner[1:] == owner[:-1], self.rank(symbols[:-1], symbols[1:]), self.none)
        while len(symbols):
            begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(pair_rank, begins)
            sizes = np.diff(np.append(begins, len(symbols)))
            counts[owner[begins]] = sizes
            alive = lowest < self.none
            if not alive.all():
                keep = np.repeat(alive, sizes)
                symbols, owner, pair_rank = symbols[keep], owner[keep], pair_rank[keep]
                lowest, sizes = lowest[alive], sizes[alive]
                if not len(symbols):
                    break
            hit = pair_rank == np.repeat(lowest, sizes)
            at = np.flatnonzero(hit)
            # in a run like aaa the pairs overlap: of hits that follow one another, every second one is taken
            follows = np.concatenate([[False], (at[1:] == at[:-1] + 1)])
            if follows.any():
                run = np.maximum.accumulate(np.where(follows, -1, np.arange(len(at))))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.merged[pair_rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            touched = np.zeros(len(symbols), bool)
            touched[at] = True
            touched[np.maximum(at - 1, 0)] = True
            symbols, owner, pair_rank, touched = symbols[keep], owner[keep], pair_rank[keep], touched[keep]
            # the symbol before a merged pair may itself have been joined away: then its left half is touched
            before = np.flatnonzero(touched)
            before = np.unique(np.concatenate([before, np.maximum(before - 1, 0)]))
            nxt = np.minimum(before + 1, len(symbols) - 1)
            pair_rank[before] = np.where((nxt > before) & (owner[nxt] == owner[before]), self.rank(symbols[before], symbols[nxt]), self.none)
        return counts

    def pieces_count(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece: special strings, and the pre-tokens of what stands between them."""
        parts: list[list[str]] = []
        extra: list[int] = []
        findall = self.pattern.findall
        for p in pieces:
            n, words = 0, []
            for i, x in enumerate(self.split.split(p) if self.split and any(s in p for s in self.special) else (p,)):
                if i % 2:
                    n += 1
                elif x:
                    words += findall(x)
            parts.append(words)
            extra.append(n)
        flat = list(dict.fromkeys(w for words in parts for w in words))
        found = dict(zip(flat, self.merge([w.encode("utf-8", "surrogatepass") for w in flat]).tolist())) if flat else {}
        return [n + sum([found[w] for w in words]) for n, words in zip(extra, parts)]

    def learn(self, memo: dict[str, int], pieces, before: str) -> None:
        new = [p for p in pieces if p not in memo]
        for i in range(0, len(new), 65536):
            part = new[i : i + 65536]
            memo.update(zip(part, self.pieces_count([before + p for p in part])))

    @common.without_gc
    def count(self, texts: list[str | None]) -> list[int]:
        """Texts are cut at lone spaces and line breaks, over which pre-tokens never reach; others are counted whole."""
        cut: list = []
        bare: set[str] = set()
        spaced: set[str] = set()
        odd: list[str] = []
        for t in texts:
            if not t:
                cut.append(())
            elif not cuts_anywhere(t):
                cut.append(None)
                odd.append(t)
            else:
                lines = t.split("\n")
                if len(lines) == 1:
                    pieces = t.split(" ")
                    bare.add(pieces[0])
                    rest = pieces[1:]
                    firsts = pieces[:1]
                else:
                    firsts, rest = [], []
                    for x in lines:
                        pieces = x.split(" ")
                        firsts.append(pieces[0])
                        rest += pieces[1:]
                    bare.update(firsts)
                spaced.update(rest)
                cut.append((firsts, rest))
        self.learn(self.memo, bare, "")
        self.learn(self.memo_spaced, spaced, " ")
        if len(self.memo) + len(self.memo_spaced) > MEMO:
            self.memo, self.memo_spaced = {p: self.memo[p] for p in bare}, {p: self.memo_spaced[p] for p in spaced}
        whole = iter(self.pieces_count(odd))
        a, b = self.memo.__getitem__, self.memo_spaced.__getitem__
        return [next(whole) if c is None else sum(map(a, c[0])) + sum(map(b, c[1])) + len(c[0]) - 1 if c else 0 for c in cut]


def counter(path: str) -> MergeCounter:
    return common.held(("counter", path), lambda: MergeCounter(path))


def count_tokens(docs: DataFrame, tokenizer: str, *, text: str = "text", limit: int = 512, n_bytes: str = "n_bytes", n_tokens: str = "n_tokens", over: str = "over_limit") -> DataFrame:
    """``docs`` with UTF-8 bytes, tokens and whether those exceed ``limit``; columns of these names are replaced. One pass, no shuffle."""
    spark = docs.sparkSession
    common.ship(spark)

    @F.pandas_udf("long")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            values = s.tolist()
            yield pd.Series([n for i in range(0, len(values), 2048) for n in counter(tokenizer).count(values[i : i + 2048])], dtype="int64")

    return docs.withColumns({n_bytes: F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long"), n_tokens: tokens(F.coalesce(F.col(text), F.lit("")))}).withColumn(over, F.col(n_tokens) > limit)
