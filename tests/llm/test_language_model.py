"""Elias-Fano levels against sorted arrays, the model against dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.llm import language_model as L
from docweave.llm.elias_fano import EliasFano, encode


@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=200), st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_elias_fano(values, queries):
    v = np.array(sorted(values), np.uint64)
    e = EliasFano(memoryview(encode(v, 2**64)))
    assert (e.access(np.arange(len(v))) == v).all()
    q = np.array([*queries, *values, 0, 2**64 - 1], np.uint64)
    assert (e.successor(q) == np.searchsorted(v, q)).all()


@given(st.lists(st.integers(0, 30), max_size=60))
def test_elias_fano_with_repeats(values):
    v = np.array(sorted(values), np.uint64)
    e = EliasFano(memoryview(encode(v, 31)))
    assert e.access(np.arange(len(v))).tolist() == v.tolist()
    q = np.arange(31, dtype=np.uint64)
    assert (e.successor(q) == np.searchsorted(v, q)).all()


def test_packing_of_arrays():
    a = np.array([0, 1, 2**63, 5], np.uint64)
    assert L.unpack(L.pack(a)).tolist() == a.tolist() and len(L.unpack(L.pack(a[:0]))) == 0


def words(t):
    return (t or "").encode().lower().split() + [b""]


class Slow:
    def __init__(self, texts, least=2):
        self.c = Counter(w for t in texts for w in words(t))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.kept = defaultdict(dict)
        for (h, w), n in Counter(p for t in texts for p in zip(words(t), words(t)[1:])).items():
            if n >= least:
                self.kept[h][w] = n

    def low(self, w):
        return (self.c[w] + 1) / (self.n + self.v + 1)

    def p(self, h, w):
        if not self.c[h]:
            return self.low(w)
        k = self.kept[h]
        left = 1 - sum(n - L.DISCOUNT for n in k.values()) / self.c[h]
        return (max(k.get(w, 0) - L.DISCOUNT, 0) if w in k else 0) / self.c[h] + left * self.low(w)

    def score(self, t):
        w = words(t)
        return math.log10(self.low(w[0])) + sum(math.log10(self.p(a, b)) for a, b in zip(w, w[1:]))


TEXTS = ["the cat sat on the mat", "the cat ran", "A cat sat on the mat", None, "", "the the the the", "dog " * 400]


@pytest.mark.parametrize("shards", [1, 5])
def test_small_model(spark, shards, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    model = L.train(df, shards=shards)
    slow = Slow(TEXTS)
    assert (model.tokens, model.distinct) == (slow.n, slow.v)
    assert model.pairs == sum(len(k) for k in slow.kept.values())
    asked = [*TEXTS, "unknown words the cat", "MAT THE DOG"]
    sizes, known, base, score = L.Trie(model).score(asked)
    for i, t in enumerate(asked):
        w = words(t)
        assert sizes[i] == len(w) and known[i] == sum(slow.c[x] > 0 for x in w)
        assert base[i] == pytest.approx(sum(math.log10(slow.low(x)) for x in w))
        assert score[i] == pytest.approx(slow.score(t), rel=0, abs=0.01 * len(w))
    # the model's probabilities after a word sum up to one
    assert sum(slow.p(b"the", w) for w in slow.c) + slow.p(b"the", b"nowhere") == pytest.approx(1)


def test_counts_beyond_a_byte_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(L, "WORDS_HELD", 3)
    data = L.encode_words(np.array([5, 9, 2**63], np.uint64), np.array([1, 255, 10**12], np.uint64))
    level = L.WordLevel(memoryview(data))
    assert level.find(np.array([9, 5, 6, 2**63], np.uint64)).tolist() == [1, 0, -1, 2]
    assert level.counts(np.array([2, 0, 1])).tolist() == [10**12, 1, 255]


def test_edge_cases(spark, docs, empty, small):
    nothing = L.train(empty)
    assert (nothing.tokens, nothing.distinct) == (0, 0)
    got = L.with_lm_score(docs, nothing).collect()
    assert len(got) == len(small) and all(r.n_known == 0 and r.score == 0.0 for r in got)
    model = L.train(docs)
    assert L.with_lm_score(empty, model).count() == 0
    assert {r.n_tokens for r in L.with_lm_score(docs, model).where("doc_id < 4").collect()} == {1}


class Whole(Slow):
    """All pairs and triples, none left out."""

    def __init__(self, texts):
        super().__init__(texts, least=1)
        self.third = defaultdict(Counter)
        for t in texts:
            for g, h, w in zip(words(t), words(t)[1:], words(t)[2:]):
                self.third[g, h][w] += 1

    def p3(self, g, h, w):
        k = self.third.get((g, h))
        if not k:
            return self.p(h, w)
        n = sum(k.values())
        return (max(k[w] - L.DISCOUNT, 0) + L.DISCOUNT * len(k) * self.p(h, w)) / n

    def score(self, t):
        w = words(t)
        return math.log10(self.low(w[0])) + sum(math.log10(self.p(*x)) for x in zip(w[:1], w[1:])) + sum(math.log10(self.p3(*x)) for x in zip(w, w[1:], w[2:]))


@pytest.mark.parametrize("shards", [1, 5])
def test_whole_model(spark, shards):
    texts = [*TEXTS, "the cat slept here once", "a rare pair stands here once"]
    model = L.train(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), min_count=1, order=3, shards=shards)
    slow = Whole(texts)
    assert model.pairs == sum(len(k) for k in slow.kept.values()) and model.triples == sum(len(k) for k in slow.third.values())
    asked = [*texts, "unknown words the cat", "MAT THE DOG", "the cat unknown sat on the mat"]
    score = L.Trie(model).score(asked)[3]
    for i, t in enumerate(asked):
        assert score[i] == pytest.approx(slow.score(t), rel=0, abs=0.02 * len(words(t)))
    assert sum(slow.p3(b"the", b"cat", w) for w in slow.c) + slow.p3(b"the", b"cat", b"nowhere") == pytest.approx(1)


def test_query(spark, sf_dir):
    from docweave.llm.queries import op9_lm_score

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 7 == 2}
    slow = Whole([t for i, t in docs.items() if i not in held])
    rows = op9_lm_score(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        w = words(docs[r.doc_id])
        assert r.held_out == (r.doc_id in held) and r.train_tokens == slow.n and r.n_tokens == len(w)
        assert r.n_known == sum(slow.c[x] > 0 for x in w)
        assert r.base_score == pytest.approx(sum(math.log10(slow.low(x)) for x in w))
        assert r.score == pytest.approx(slow.score(docs[r.doc_id]), rel=0, abs=0.015 * len(w) + 0.05)
    heard = [r for r in rows if r.held_out]
    assert sum(r.score for r in heard) > sum(r.base_score for r in heard)


def test_texts_as_numbers_score_alike(spark, docs, small, monkeypatch):
    """Over several dictionaries a task, with rows that don't teach, and with extra columns."""
    monkeypatch.setattr(L, "TEXTS", 2)
    monkeypatch.setattr(L, "WORDS_HELD", 5)
    from pyspark.sql import functions as F

    tokens, path = L.tokenize(docs, train=F.col("doc_id") != 4)
    model = L.learn(tokens, path)
    got = L.scored_tokens(tokens, model)
    assert {"lang", "source", "rule", "fp"} <= set(got.columns)
    other = L.train(docs.where("doc_id <> 4"), min_count=1, order=3)
    key = lambda rows: sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in rows)
    assert key(got.collect()) == key(L.with_lm_score(docs, other).collect())
    assert (model.tokens, model.distinct, model.pairs, model.triples) == (other.tokens, other.distinct, other.pairs, other.triples)
    nothing, path = L.tokenize(docs, train=F.lit(False))
    assert {(r.n_known, r.score) for r in L.scored_tokens(nothing, L.learn(nothing, path)).collect()} == {(0, 0.0)}
    tokens, path = L.tokenize(docs.limit(0))
    assert L.scored_tokens(tokens, L.learn(tokens, path)).count() == 0


def test_left_out_pairs_keep_their_weight(spark):
    """With a least count, triples that end in a pair left out still count towards their context."""
    texts = ["a b c", "a b c", "a b d", "a b c d", "x a b c"]
    model = L.train(spark.createDataFrame([(t,) for t in texts], "text string"), min_count=2, order=3)
    t = L.Trie(model)
    number, _, _ = t.tokens(["a b c"])
    at, _, _, pair, rank = t.pairs_of(number, np.array([True, False, False, False]))
    at, pair, rank = t.after_pairs(at, pair, rank, np.array([True, False, False, False]))
    logp, backoff = t.trigrams(pair, rank)
    # after "a b": c four times, d once
    low = (4 - 0.75) / 5 + (1 - (4 - 0.75) / 5) * (5 / (model.tokens + model.distinct + 1))
    assert 10 ** logp[at == 2][0] == pytest.approx((4 - 0.75) / 5 + (1 - (4 - 0.75) / 5) * low, rel=0.02)


def test_longer_contexts_help_on_unseen_texts(spark):
    """Texts by a rule of two words' memory, held out: the trigram model tells them better than the bigram model."""
    import random

    rng = random.Random(0)
    words = [f"w{i}" for i in range(12)]
    follow = {(a, b): rng.sample(words, 2) for a in words for b in words}

    def text():
        t = rng.choices(words, k=2)
        while len(t) < 60:
            t.append(rng.choice(follow[t[-2], t[-1]]))
        return " ".join(t)

    df = spark.createDataFrame([(text(),) for _ in range(300)], "text string")
    unseen = [text() for _ in range(20)]
    two, three = (sum(L.Trie(L.train(df, min_count=1, order=n)).score(unseen)[3]) for n in (2, 3))
    assert three > 0.7 * two
