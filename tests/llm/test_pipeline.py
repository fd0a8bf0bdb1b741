"""The pipeline's stages on tables with known cases."""

import random

import numpy as np

import corpus_pipeline
from docweave.llm.queries import oracle_sql, queries


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "simhash near-dedup", "benchmark decontamination", "best-fit packing"]
    assert set(oracle_sql()) <= set(queries())


def test_stages_one_by_one(spark, tmp_path):
    rng = random.Random(0)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "lmnrst"]
    text = lambda k=60: " ".join(rng.choices(vocabulary, k=k))
    good = {i: text() for i in range(200)}
    junk = {i: " ".join(w + "***" for w in text().split()) for i in range(200, 300)}
    good[150] = good[3]
    good[151] = good[4]
    item = text(30)
    good[152] = f"{text(40)} {item} {text(40)}"
    docs = {**good, **junk}
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i in docs if i % 2 == 0 and i != 150], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if k < 4:
            assert out.columns == now.columns
        out.write.parquet(f"{tmp_path}/out{k}")
        now = spark.read.parquet(f"{tmp_path}/out{k}")
        left.append({r.doc_id for r in now.select("doc_id").collect()})
    assert left[0] == set(good) and left[1] == set(good)
    assert left[2] == set(good) - {150, 151}
    assert left[3] == left[2] - {152}
    assert left[4] == left[3]


def test_rows_that_share_an_id_or_have_none(spark, tmp_path):
    rng = random.Random(1)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "lmnrst"]
    t = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(9)]
    rows = [(None, t[0]), (None, t[1]), (None, t[2]), (None, t[2]), (1, t[3]), (None, t[3]), (2, t[4]), (2, t[5]), (3, t[6]), (3, t[4]), (4, t[7]), (4, t[7]), (None, None)]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x or "")) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [(None, t[0]), (None, t[1]), (None, t[2]), (1, t[3]), (2, t[4]), (2, t[5]), (3, t[6]), (4, t[7]), (None, None)]))
    # of null ids, and of repeated ones, the row that holds the item goes, and no two halves make one
    item = " ".join(t[8].split()[:30])
    half = t[8].split()
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in [(None, t[0]), (None, item), (None, t[1]), (5, item), (5, t[2]), (6, " ".join(half[:16])), (6, " ".join(half[12:30]))]], docs.schema)
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [(None, t[0]), (None, t[1]), (5, t[2]), (6, " ".join(half[:16])), (6, " ".join(half[12:30]))]))


def test_stages_against_plain_versions(spark, sf_dir, tmp_path, word_bpe):
    """Each stage on what the one before kept, whole tables, held against loops over its rows."""
    from tokenizers import Tokenizer

    from docweave.llm import quality_model, quality_rules, simhash, text_stats
    from docweave.llm.common import lower_words_of

    from .test_decontaminate import slow_holds

    def rows(k):
        return {r.doc_id: r.text for r in now.select("doc_id", "text").collect()}

    def stage(k):
        nonlocal now
        corpus_pipeline.STAGES[k][1](spark, now, sf_dir).write.parquet(f"{tmp_path}/out{k}")
        now = spark.read.parquet(f"{tmp_path}/out{k}")

    now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = rows(0)
    model = quality_model.fit(now, labels)
    scores = dict(zip(texts, model.scores(model.pooled(list(texts.values())))))
    stage(0)
    got = set(rows(1))
    assert got == {i for i, s in scores.items() if s >= 0.7} and 0 < len(got) < len(texts)

    texts = rows(1)
    learned = quality_rules.learn_from(now, labels)
    keep = set()
    for i, t in texts.items():
        counts = dict(zip(text_stats.COUNTS, text_stats.statistics(t)))
        x = quality_rules.features({k: np.array([v]) for k, v in counts.items()})
        base = counts["n_words"] < 10 or 100 * counts["n_repeat_words"] > 20 * counts["n_words"]
        if not base and not learned.rejects(x)[0]:
            keep.add(i)
    stage(1)
    assert set(rows(2)) == keep

    texts = rows(2)
    prints = {i: simhash.fingerprint(lower_words_of(t), 3) for i, t in texts.items()}
    left, keep = set(prints), set()
    while left:
        front = [min(left)]
        keep.add(front[0])
        while front:
            x = front.pop()
            left.discard(x)
            front += [y for y in left if (prints[x] ^ prints[y]).bit_count() <= corpus_pipeline.NEAR_BITS and y not in front]
    stage(2)
    assert set(rows(3)) == keep and len(keep) < len(texts)

    texts = rows(3)
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    keep = {i for i, t in texts.items() if not any(slow_holds(t or "", x or "") for x in items)}
    stage(3)
    assert set(rows(4)) == keep and len(keep) < len(texts)

    texts = rows(4)
    stage(4)
    lib = Tokenizer.from_file(word_bpe)
    want = sorted((i, k, at, len(ids[at : at + 2048])) for i, t in texts.items() for ids in [[*lib.encode(t or "", add_special_tokens=False).ids, 0]] for k, at in enumerate(range(0, len(ids), 2048)))
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in now.collect()) == want


def test_odd_tables(spark, tmp_path):
    """Null and repeated ids, null and empty texts, extra columns with names that stages use, labels that teach nothing, empty tables."""
    rng = random.Random(2)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "lmnrst"]
    text = lambda k=60: " ".join(rng.choices(vocabulary, k=k))
    t = [text() for _ in range(6)]
    item = text(30)
    rows = [(None, t[0]), (None, t[1]), (2, t[2]), (2, t[3]), (2, t[3]), (3, None), (4, ""), (None, None), (5, f"{t[4]} {item} {t[5]}"), (6, t[4])]
    schema = "doc_id long, text string, score double, n_words int, rule string, __fp string, __n string, row long, item_id long, length string"
    spark.createDataFrame([(i, x, 0.5, 7, "r", "f", "n", 1, 2, "l") for i, x in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda rows: sorted(rows, key=str)
    want = [rows, [rows[i] for i in (0, 1, 2, 3, 4, 8, 9)], [rows[i] for i in (0, 1, 2, 3, 8, 9)], [rows[i] for i in (0, 1, 2, 3, 9)]]
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    empty = now.limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out, none = stage(spark, now, str(tmp_path)), stage(spark, empty, str(tmp_path))
        assert none.count() == 0
        if k < 4:
            assert out.columns == now.columns and none.columns == now.columns
            out.write.parquet(f"{tmp_path}/odd{k}")
            now = spark.read.parquet(f"{tmp_path}/odd{k}")
            assert key((r.doc_id, r.text) for r in now.collect()) == key(want[k])
            assert {tuple(r)[2:] for r in now.collect()} == {(0.5, 7, "r", "f", "n", 1, 2, "l")}
        else:
            assert key(r.doc_id for r in out.collect()) == key([None, None, 2, 2, 6])


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
