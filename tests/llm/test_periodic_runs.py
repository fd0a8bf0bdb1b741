"""Periodic runs against the definition tried out at every start and period, and the query against a plain version."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.llm import common, periodic_runs, queries


def plain_runs(words):
    """Every stretch with period q that can't grow, its smallest period by trial."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(words):
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def plain_words(doc_id, text):
    """A text's words with the stretch that the query repeats."""
    words = common.words_of(text)
    h, n = zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9)), max_size=8))
def test_against_the_definition(stretches):
    words = [w for block, times in stretches for w in block * times]
    got = periodic_runs.runs_of(np.array(words, np.int64))
    assert got == plain_runs(words)
    assert periodic_runs.collapsed(words, got) == [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in got)]


@pytest.mark.parametrize("pair_ns", [1e-9, 6.0, 1e9])
def test_lags_by_either_way(monkeypatch, pair_ns):
    """Only pairs, both, and only transforms count the same."""
    monkeypatch.setattr(periodic_runs, "PAIR_NS", pair_ns)
    rng = np.random.default_rng(3)
    for n in (1, 6, 7, 100, 1000, 3000):
        codes = np.unique((rng.zipf(1.3, n) % 400).astype(np.int64), return_inverse=True)[1]
        most = n // 4
        assert periodic_runs.matches_by_lag(codes, most).tolist() == [0, *[int((codes[q:] == codes[:-q]).sum()) for q in range(1, most + 1)]][: most + 1]


def test_long_run_of_one_word():
    """Scanned at lag 1 alone: half a million words would else take hours."""
    assert periodic_runs.runs_of(np.zeros(500_000, np.int64)) == [(0, 500_000, 1)]
    assert periodic_runs.runs_of(np.tile(np.arange(7), 40_000)) == [(0, 280_000, 7)]


def test_query_on_whole_table(spark, sf_dir):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    checked = 0
    for r in docs:
        words = plain_words(r["doc_id"], r["text"])
        if len(words) < 700:  # the plain version takes a cube of steps
            assert got[r["doc_id"]] == plain_row(words), r["doc_id"]
            checked += 1
    assert checked > 100 and any(g[0] for g in got.values())


def test_odd_rows(spark, tmp_path, small):
    """Null and empty texts, null and repeated ids, a long text, other columns with the operator's own names, an empty table."""
    rng = random.Random(1)
    rows = [*small, (9, "a b " * 30 + "c"), (9, "a b " * 30 + "c"), (10, " ".join(rng.choice("ab") for _ in range(300))), *[(i, "x y z \x1c é " * 9) for i in range(20, 60)]]
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in rows], "doc_id long, text string, runs string, found int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).fillna(-1).fillna(-9, ["doc_id"]).collect())
    want = [(-1 if i is None else i, *(-1 if x is None else x for x in plain_row(plain_words(i, t)))) for i, t in rows if len(t or "") < 10_000]
    assert [g for g in got if g[0] != 8] == sorted(want)
    assert periodic_runs.find_runs(df.limit(0)).collect() == []
    found = {r["doc_id"]: r for r in periodic_runs.find_runs(df).collect()}
    assert found[9]["collapsed"] == "a b c" and [tuple(r) for r in found[9]["runs"]] == [(0, 60, 2)]
    assert [tuple(r) for r in found[8]["runs"]] == [(0, 30000, 977)]


def test_texts_without_words_that_should_repeat(spark, tmp_path):
    """Ids whose crc32 ends in 0, with null, empty and blank texts."""
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    rows = list(zip(ids, (None, "", " \n\t", "a b c d e f g")))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect())
    assert got == [(i, *plain_row(plain_words(i, t))) for i, t in rows]
