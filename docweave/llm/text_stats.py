"""Statistics of whole texts that quality rules read."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Characters that count as symbols, and the white space that parts words (fixed values of the statistics).
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: What ``statistics`` gives, in this order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_same_words", "n_distinct_words", "n_lines")


def repeat_words(words: list[bytes], window: int = 5) -> int:
    """Words that some window of five found twice or more in the text covers, the first find included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i:] for i in range(window))))
    if len(set(windows)) == n:
        return 0
    found = Counter(windows)
    total, until = 0, 0
    for i, w in enumerate(windows):
        if found[w] > 1:
            total += i + window - max(i, until)
            until = i + window
    return total


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS``; a null text has no words. Upper-case letters, ``!?`` marks and words equal to the one before are counted too."""
    words = common.words_of(text)
    if not words:
        return (0,) * len(COUNTS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(text) - len(text.translate(_UPPER)) if text.isascii() else sum(map(str.isupper, text)),
        text.count("!") + text.count("?"),
        sum(map(bytes.__eq__, words, words[1:])),
        len(set(words)),
        len(lines),
    )


_UPPER = {c: None for c in range(65, 91)}


def with_statistics(docs: DataFrame, *, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with a long column for each of ``COUNTS``; columns of these names are replaced. One pass, no shuffle."""
    common.ship(docs.sparkSession)
    schema = ", ".join(f"{c} long" for c in COUNTS)

    @F.pandas_udf(schema)
    def stats(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            yield pd.DataFrame(np.array([statistics(t) for t in s], np.int64).reshape(-1, len(COUNTS)), columns=list(COUNTS))

    found = docs.withColumn("__stats", stats(F.col(text)))
    return found.withColumns({f"{prefix}{c}": F.col("__stats")[c] for c in COUNTS}).drop("__stats")


