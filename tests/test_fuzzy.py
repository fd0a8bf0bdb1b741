"""Exact partial ratios against the quadratic definition."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.functions import fuzzy


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def plain(a, b):
    """Every window and every shorter one at the ends, each by the table of common subsequences."""
    if not a or not b:
        return 0.0

    def within(short, long):
        m = len(short)
        windows = [long[i : i + m] for i in range(len(long) - m + 1)] + [w for i in range(1, m) for w in (long[:i], long[-i:])]
        return max(200 * longest(short, w) / (m + len(w)) for w in windows)

    return max(within(a, b), within(b, a)) if len(a) == len(b) else within(*sorted((a, b), key=len))


@pytest.mark.parametrize("chars", [50, 200_000])
def test_random_texts(monkeypatch, chars):
    """Needles of one to three machine words; long texts in one part and in stretches; characters beyond 16 bits."""
    monkeypatch.setattr(fuzzy, "CHARS", chars)
    rng = random.Random(chars)
    for _ in range(150):
        letters = "ab cdé𝒜"[: rng.randint(1, 7)]
        write = lambda n: "".join(rng.choice(letters) for _ in range(n))
        needle = write(rng.choice([0, 1, 2, 5, 9, 20, 63, 64, 65, 70, 130]))
        texts = [write(rng.choice([0, 1, 3, 8, 20, 64, 65, 90, 140])) for _ in range(4)]
        assert fuzzy.partial_ratios(needle, texts) == pytest.approx([plain(needle, t) for t in texts])


def test_what_aligned_blocks_miss():
    """A window that no longest matching block points at: difflib's blocks give less."""
    assert fuzzy.partial("abcd", "aXbXcXd abXcd") == pytest.approx(plain("abcd", "aXbXcXd abXcd"))
    assert fuzzy.partial("initial fees", "item 5: initial fees and more") == 100.0
    assert fuzzy.partial("", "abc") == fuzzy.partial("abc", "") == 0.0


def test_columns(spark):
    rows = [("abc", "xxabcxx"), (None, "a"), ("a", None), ("", "a"), ("brass rod", "brass"), ("brass", "brass")]
    got = spark.createDataFrame(rows, "a string, b string").select(fuzzy.partial_ratio("a", "b")).collect()
    assert [r[0] for r in got] == [100.0, None, None, 0.0, 100.0, 100.0]
    assert spark.createDataFrame(rows, "a string, b string").limit(0).select(fuzzy.partial_ratio("a", F.lit("b"))).collect() == []


def test_best_of():
    needles, texts = ["initial fees", "other fees", "initial fees"], ["the initial fees", "fees of others", "", "the initial fees"]
    number, score = fuzzy.best_of(needles, texts)
    assert number.tolist() == [max(range(3), key=lambda i: (plain(needles[i], t), -i)) for t in texts]
    assert score.tolist() == pytest.approx([max(plain(n, t) for n in needles) for t in texts])


def test_best_needle_by_bounds(monkeypatch):
    """Needles of every word size, texts shorter and longer than they, parts of one and of many texts: as by each needle on its own."""
    rng = random.Random(5)
    needles = ["".join(rng.choices("abcde ", k=k)) for k in (1, 7, 8, 9, 16, 17, 32, 33, 47, 64, 65, 75, 130)] + ["", "abc", "abc"]
    texts = ["".join(rng.choices("abcdefgh ", k=rng.choice((0, 1, 5, 30, 64, 65, 90, 180)))) for _ in range(60)] + [needles[8], "xx" + needles[10] + "yy", "", "zzzz", "é" * 40, "a" * 2000]
    scores = np.stack([fuzzy.partial_ratios(n, texts) for n in needles])
    for part in (1, 500, 65_536):
        monkeypatch.setattr(fuzzy, "PART", part)
        worked = []
        some = fuzzy._longest
        monkeypatch.setattr(fuzzy, "_longest", lambda masks, m, windows, stride=1: worked.append(m * -(-windows // stride)) or some(masks, m, windows, stride))
        number, score = fuzzy.best_of(needles, texts)
        monkeypatch.setattr(fuzzy, "_longest", some)
        assert number.tolist() == scores.argmax(0).tolist()
        assert score.tolist() == pytest.approx(scores.max(0).tolist())
        if part > 1:  # fewer steps than every needle along every window
            assert sum(worked) < 0.7 * sum(len(n) * sum(len(t) + len(n) for t in texts) for n in needles)
