"""Functions that no composition of built-ins gives, as Arrow-batched UDFs."""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import runs_on_executors
from .text import SUFFIX_GROUPS

runs_on_executors(__name__)

_SUFFIX = re.compile("|".join(rf"\b({g})" for g in SUFFIX_GROUPS), re.I)


def normalised(name: str) -> str:
    return re.sub(r"[-\s]+", " ", re.sub(r"[^\w\s-]", " ", _SUFFIX.sub("", name))).strip().lower()


def similarity(one: str, two: str) -> float:
    """1 for equal normalised names, 0.95 if one is within the other, else the better of sequence matching and 0.9 times the words' overlap. An empty one is within no other."""
    a, b = normalised(one), normalised(two)
    if a == b:
        return 1.0
    if a and b and (a in b or b in a):
        return 0.95
    x, y = set(a.split()), set(b.split())
    overlap = 0.9 * len(x & y) / max(len(x), len(y)) if x and y else 0.0
    return max(SequenceMatcher(None, a, b).ratio(), overlap)


@F.pandas_udf(T.DoubleType())
def name_similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in batches:
        yield pd.Series([None if x is None or y is None else similarity(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.StringType())
def unicode_title(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Title case of any script."""
    for s in batches:
        yield s.map(lambda x: None if x is None else x.strip().title())


@F.pandas_udf(T.ArrayType(T.FloatType()))
def hashed_embedding(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """An offline stand-in for an embedding model: 384 numbers of unit length from hashed words; null gives zeros."""
    import zlib

    import numpy as np

    def of(text: str | None) -> list[float]:
        v = np.zeros(384)
        for w in (text or "").lower().split():
            h = zlib.crc32(w.encode())
            v[h % 384] += 1 if h >> 16 & 1 else -1
        n = np.linalg.norm(v)
        return (v / n if n else v).astype(float).tolist()

    for s in batches:
        yield s.map(of)
