"""Statistics and rules against brute force; models by held-out accuracy."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.llm import quality_model, quality_rules, text_stats
from docweave.llm.queries import op4_quality_classifier, op7_quality_rules


def slow_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\t#<\x1c\x85é"), max_size=60))
def test_statistics(text):
    got = dict(zip(text_stats.COUNTS, text_stats.statistics(text)))
    n, chars, symbols, dup, repeat = slow_statistics(text)
    assert (got["n_words"], got["n_dup_lines"], got["n_repeat_words"]) == (n, dup, repeat)
    assert got["word_chars"] == chars
    assert got["n_symbols"] == symbols or n == 0


def test_repeat_words_over_a_period():
    words = [b"a", b"b", b"c"] * 7 + [b"x"] * 3
    text = b" ".join(words).decode()
    assert text_stats.repeat_words(words) == slow_statistics(text)[4]


def test_rules_are_learned_and_apply_alike(spark):
    rng = np.random.default_rng(0)
    n = 3000
    counts = {c: rng.integers(20, 200, n) for c in text_stats.COUNTS}
    counts["n_symbols"] = np.where(rng.random(n) < 0.2, counts["word_chars"] // 3, 0)
    bad = counts["n_symbols"] > 0
    found = quality_rules.learn(quality_rules.features(counts), bad, np.arange(n))
    assert (found.rejects(quality_rules.features(counts)) == bad).mean() > 0.99
    rows = spark.createDataFrame([tuple(int(counts[c][i]) for c in text_stats.COUNTS) for i in range(200)], ", ".join(f"{c} long" for c in text_stats.COUNTS))
    by_spark = [r.v is not None for r in rows.select(found.verdict().alias("v")).collect()]
    assert by_spark == found.rejects(quality_rules.features({c: v[:200] for c, v in counts.items()})).tolist()


def test_few_rows_are_learned():
    """A hundred rows that one direction parts: an epoch is a single step."""
    rng = np.random.default_rng(4)
    y = (np.arange(100) % 3 > 0).astype(int)
    x = (rng.normal(0, 0.1, (100, quality_model.DIM)) + np.outer(y, np.eye(quality_model.DIM)[5])).astype(np.float32)
    model = quality_model.train(x, y, np.zeros(100, bool), [], np.zeros((0, quality_model.DIM), np.float32))
    scores = model.scores(x)
    assert scores[y == 1].min() > 0.9 and scores[y == 0].max() < 0.1


def test_noise_teaches_no_rule():
    rng = np.random.default_rng(1)
    counts = {c: rng.integers(20, 200, 1000) for c in text_stats.COUNTS}
    assert quality_rules.learn(quality_rules.features(counts), rng.random(1000) < 0.3, np.arange(1000)).rules == []


def labels_for(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_edge_cases(spark, docs, empty, small):
    none = labels_for(spark, [(1, None, 0), (None, 1, 0), (4, 7, 0)])
    judged, found = quality_rules.apply_rules(docs, none)
    assert found.rules == [] and judged.count() == len(small)
    got = {r.doc_id: r for r in judged.collect()}
    assert got[1].base_failed and got[2].base_failed and got[4].base_failed and got[5].kept
    assert got[8].n_words == 30000 and not got[8].kept  # its windows repeat
    assert quality_rules.apply_rules(empty, none)[0].count() == 0
    assert quality_model.fit(docs, none).untaught  # a defined result where there is nothing to learn


def test_model_scores_every_row(spark, docs, empty, small):
    rng = random.Random(0)
    good = [(1000 + i, " ".join(rng.choices("alpha beta gamma delta omega".split(), k=40))) for i in range(150)]
    bad = [(2000 + i, " ".join(w + "***" for w in rng.choices("alpha beta gamma delta omega".split(), k=40))) for i in range(150)]
    train = spark.createDataFrame(good + bad, "doc_id long, text string")
    model = quality_model.fit(train, labels_for(spark, [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad]))
    held = {r.doc_id: r.score for r in quality_model.with_score(train, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert len(held) > 40 and all((s >= 0.7) == (i < 2000) for i, s in held.items())
    got = quality_model.with_score(docs, model).collect()
    assert len(got) == len(small) and all(0 <= r.score <= 1 for r in got)
    assert quality_model.with_score(empty, model).count() == 0


def test_nothing_to_learn_from(spark, docs, empty, small):
    """Empty documents, empty labels, one class: a stated score for every row."""
    schema = "doc_id long, quality int, toxic int"
    for labels, share in (([], 0.5), ([(5, 1, 0), (5, 1, 0), (7, None, 0)], 2 / 3), ([(99, 0, 0), (99, 1, 0)], 0.5)):
        model = quality_model.fit(docs, spark.createDataFrame(labels, schema), held_out=-1)
        assert model.untaught
        got = quality_model.with_score(docs, model).collect()
        assert len(got) == len(small) and all(r.score == pytest.approx(share) for r in got)
    model = quality_model.fit(empty, spark.createDataFrame([(1, 1, 0), (2, 0, 0)], schema))
    assert model.untaught and quality_model.with_score(empty, model).count() == 0
    judged, found = quality_rules.apply_rules(docs, spark.createDataFrame([], schema))
    assert not found.rules and judged.count() == len(small)


def test_the_sample_is_bounded(spark):
    """A labelled id with many rows gives one, and labels of texts that aren't there none."""
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b"), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 100)], "doc_id long, quality int")
    got = quality_rules.labelled_sample(docs, labels, key="doc_id", text="text", label="quality", max_rows=3).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, "text 0"), (2, "b"), (3, "c")]


def test_labels_outside_the_training_fold_alone_are_read(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2][:40]
    docs = spark.createDataFrame([(i, f"text {i}") for i in held], "doc_id long, text string")
    model = quality_model.fit(docs, labels_for(spark, [(i, i % 2, 0) for i in held]))
    assert model.untaught and {r.score for r in quality_model.with_score(docs, model).collect()} == {0.5}


def test_classifier_query_is_accurate(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op4_quality_classifier(spark, folder).collect()}
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i in truth if got[i].held_out]
    one = np.mean([truth[i] for i in held])
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.93 > one  # always answering 1 gives the share of ones
    pairs = [(got[i].score > got[j].score) + (got[i].score == got[j].score) / 2 for i in held if truth[i] for j in held if not truth[j]]
    assert np.mean(pairs) > 0.95
    assert all(r.predicted == int(r.score >= 0.7) for r in got.values())


def test_rules_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op7_quality_rules(spark, folder).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        r, want = rows[i], slow_statistics(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    passed = [i for i in truth if not rows[i].base_failed]
    assert np.mean([rows[i].kept for i in passed if truth[i] == 1]) > 0.99
    assert np.mean([rows[i].kept for i in passed if truth[i] == 0]) < 0.3


def test_worker_caches_are_let_go(monkeypatch):
    from docweave.llm import common

    class Task:
        now = 1

        @classmethod
        def get(cls):
            return cls()

        def taskAttemptId(self):
            return Task.now

    monkeypatch.setattr(common, "TaskContext", Task)
    monkeypatch.setattr(common, "_held", {})
    monkeypatch.setattr(common, "_held_by", [None, None])
    made = []
    make = lambda: made.append(1) or len(made)
    assert common.held(("a",), make) == common.held(("a",), make) == 1
    Task.now = 2
    assert common.held(("a",), make) == 1
    assert common.held(("b", 1), make) == 2 and common.held(("a",), make) == 1  # both within one task
    Task.now = 3
    assert common.held(("b", 1), make) == 3  # the task before was the other's
    assert common.held(("a",), make) == 4


def test_rules_hold_on_labels_they_were_not_learned_from(spark):
    """Learned from two thirds of the labels; of what they reject among the rest, few are good."""
    from pyspark.sql import functions as F

    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumn("fold", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3)
    found = quality_rules.learn_from(docs, labels.where("fold <> 0"))
    asked = quality_rules.judge(docs.join(labels.where("fold = 0").select("doc_id", "quality"), "doc_id"), found)
    rejected = [r.quality for r in asked.where("not base_failed and rule is not null").select("quality").collect()]
    assert found.rules and len(rejected) >= 20 and sum(rejected) <= 0.1 * len(rejected)


def plain_words(text):
    return [w for x in (text or "").encode("utf-8", "surrogatepass").split() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]+", x)]


def plain_index(word, turn=0):
    h, v = xxhash.xxh64_intdigest(word, 5), np.zeros(64)
    for i in range(8):
        v[((h >> 6 * i) % 64 + turn) % 64] += 1 if i < 4 else -1
    return v


def plain_gathered(words):
    """What each place of a text gathers, one neighbour after another."""
    for i, w in enumerate(words):
        got = np.zeros(64)
        for d, turn in ((1, 11), (-1, 23), (2, 37), (-2, 51)):
            if 0 <= i + d < len(words):
                got += plain_index(b"") if words[i + d] == w else plain_index(words[i + d], turn)
        yield w, got


def plain_pooled(text, vocabulary, vectors):
    words = plain_words(text)
    row = {w: i for i, w in enumerate(vocabulary)}
    return sum((got / 4 + (vectors[row[w]] if w in row else 0) for w, got in plain_gathered(words)), np.zeros(64)) / max(len(words), 1)


TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAb.# \né日", max_size=40)), max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXTS, TEXTS)
def test_vectors_against_plain_version(seen, texts):
    """What words gather and how texts pool, with words that the model has and hasn't, before and after the memo is dropped."""
    vocabulary = [b"a", b"b", b"###", b"ab"]
    known = quality_model.Words(vocabulary)
    sums = np.zeros((4, 64), np.int32)
    quality_model.gather(seen, known, sums)
    want = np.zeros((4, 64))
    for t in seen:
        for w, got in plain_gathered(plain_words(t)):
            if w in vocabulary:
                want[vocabulary.index(w)] += got
    assert (sums == want).all()
    vectors = (sums / (np.sqrt((want**2).sum(1, keepdims=True)) + 10)).astype(np.float32)
    for _ in range(2):
        assert np.allclose(quality_model.pooled(texts, known, vectors), np.array([plain_pooled(t, vocabulary, vectors) for t in texts]).reshape(-1, 64), atol=1e-5)
        known.clear()
    none = quality_model.pooled(texts, quality_model.Words([]), np.zeros((0, 64), np.float32))
    assert np.allclose(none, np.array([plain_pooled(t, [], none) for t in texts]).reshape(-1, 64), atol=1e-5)


def test_query_against_plain_version(spark, sf_dir):
    """Vocabulary, sums, pooling and network from one text after another give the query's scores; word vectors are all that the network sees."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    model = quality_model.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    fold = [i for i in labels if labels[i] in (0, 1) and i in docs and zlib.crc32(str(i).encode()) % 4 != 2]
    counts = Counter(w for i in fold for w in plain_words(docs[i]))
    vocabulary = sorted((w for w, n in counts.items() if n >= 3), key=lambda w: (-counts[w], w))
    assert model.vocabulary == vocabulary and len(vocabulary) > 500
    row, sums = {w: i for i, w in enumerate(vocabulary)}, np.zeros((len(vocabulary), 64))
    for i in fold:
        for w, got in plain_gathered(plain_words(docs[i])):
            if w in row:
                sums[row[w]] += got
    vectors = sums / (np.sqrt((sums**2).sum(1, keepdims=True)) + 10)
    assert np.allclose(model.vectors, vectors, atol=1e-6)
    assert model.w1.shape[0] == 64  # a pooled vector and nothing beside it
    for r in op4_quality_classifier(spark, sf_dir).collect():
        x = (plain_pooled(docs[r.doc_id], vocabulary, vectors) - model.mean) / model.scale
        logit = np.tanh(x @ model.w1 + model.b1) @ model.w2 + model.b2
        assert r.score == pytest.approx(1 / (1 + np.exp(-logit / model.temperature)), abs=2e-3)


def test_a_worker_holds_one_models_words():
    one = quality_model._words([b"a"], 1)
    assert quality_model._words([b"a"], 1) is one
    quality_model._words([b"b"], 2)
    assert quality_model._words([b"a"], 1) is not one
