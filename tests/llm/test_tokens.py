"""Token files, packing and token counts against the tokenizers library."""

import unicodedata
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docweave.llm import bpe_count, common, packing, sstable
from docweave.llm.tokenizing import PieceEncoder

TRICKY = ["a  b\t c\n\n d", "<|endoftext|> x <|endoftext|>y", " lead", "trail ", " ", "\n", " a\nb \nc", "", "don't\nyou're 12 345", "É́ é", "x y z　w", "\x02 a\x02 b", "a\n b", "aaa aaaaaaa hahahaha", "THE The the, the. the.. .,", "a\r\nb\r\n", "a\n\n\nb", "x\x1cy \x85z", "İstanbul ΣΑΣ ſ"]
texts = st.text(alphabet=st.sampled_from(" \n\t.,!'aAbBéÉ1 <|>\x02x"), max_size=40)


def library(path, values):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(values, add_special_tokens=False)]


@pytest.mark.parametrize("drops", [False, True])
def test_pieces_give_the_librarys_ids(byte_bpe, word_bpe, drops):
    path = word_bpe if drops else byte_bpe
    e = PieceEncoder(path, drops)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(texts, max_size=5))
    def holds(values):
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(values)] == library(path, values)

    holds()
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(TRICKY)] == library(path, TRICKY)
    assert e.encode([None]) == [b""]


def test_signs_beside_every_letter(byte_bpe, word_bpe):
    """Some letters turn into a letter and a mark, which the library joins with signs behind it."""
    signs = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    letters = [c for c in map(chr, [*range(128, 0xD800), *range(0xE000, 0x32000)]) if c.isalpha() or unicodedata.category(c)[0] in "MN"]
    values = [f"x {c}{signs[i % 32]} a{c}{signs[i % 32]}{signs[i * 7 % 32]} {signs[i * 7 % 32]}{c} {c}b{signs[i % 32]}" for i, c in enumerate(letters)]
    assert len(values) > 100_000 and "\u0130" in letters and "\u095c" in letters
    for path, drops in ((byte_bpe, False), (word_bpe, True)):
        e, lib = PieceEncoder(path, drops), Tokenizer.from_file(path)
        for i in range(0, len(values), 5000):
            want = [np.array(x.ids, "<u4").tobytes() for x in lib.encode_batch(values[i : i + 5000], add_special_tokens=False)]
            assert e.encode(values[i : i + 5000]) == want


def test_letters_that_go_to_the_model_at_once(word_bpe):
    """Pieces of letters, alone and beside each other, capitals and signs; what isn't the vocabulary's plain kind goes the long way."""
    letters = [chr(n) for n in range(0x41, 0x250) if chr(n).isalpha()] + ["\u0301", "\u1e9e", "\u212a", "\u03a3"]
    values = [f"{a} {a}{b} x{a}{b}y {b}{a}. Q{a}" for a in letters for b in letters[::23]]
    e, asked = PieceEncoder(word_bpe, True), []
    long_way = e._encoded
    e._encoded = lambda pieces, before: asked.extend(pieces) or long_way(pieces, before)
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(values)] == library(word_bpe, values)
    asked.clear()
    assert e.encode(["Plain words, Éclair"]) and "plain" in e.memo and not [p for p in asked if p != ","]
    # a vocabulary whose special strings are letters, or that keeps case, has no such way
    lib = Tokenizer.from_file(word_bpe)
    lib.add_special_tokens(["plain"])
    other = PieceEncoder(word_bpe, True)
    other.library, other.special = lib, [*other.special, "plain"]
    assert not other._letters_alone()


def test_memo_of_pieces_without_spaces_keeps_its_bound(word_bpe, monkeypatch):
    from docweave.llm import tokenizing

    monkeypatch.setattr(tokenizing, "MEMO", 100)
    e = PieceEncoder(word_bpe, True)
    for i in range(5):
        values = [" ".join(f"{'abcdefgh'[i]}x{'abcdefgh'[j % 8]}{'stuvw'[j // 8]}" for j in range(40)), None, "", "a\nb"]
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(values)] == library(word_bpe, [v or "" for v in values])
        assert len(e.memo) <= 50 + 43


def test_queries_give_the_librarys_ids(spark, sf_dir, byte_bpe, word_bpe):
    from docweave.llm import queries as Q

    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    ids, start, want = [[*x, 0] for x in library(byte_bpe, [t for _, t in docs])], 0, []
    for (i, _), x in zip(docs, ids):
        want.append((i, start, len(x), crc(x)))
        start += len(x)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in Q.op1_sstable_tokens(spark, sf_dir).collect()) == want
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in Q.op10_token_counts(spark, sf_dir).collect()) == [(i, len(t.encode()), len(x) - 1, len(x) > 513) for (i, t), x in zip(docs, ids)]
    want = [(i, k, at, len(x[at : at + 2048]), crc(x[at : at + 2048])) for (i, _), y in zip(docs, library(word_bpe, [t for _, t in docs])) for x in [[*y, 0]] for k, at in enumerate(range(0, len(x), 2048))]
    rows = Q.op3_best_fit_packing(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048 and len(ends) <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_memo_keeps_its_bound(byte_bpe, monkeypatch):
    from docweave.llm import tokenizing

    monkeypatch.setattr(tokenizing, "MEMO", 50)
    e = PieceEncoder(byte_bpe)
    for i in range(5):
        e.encode([" ".join(f"w{i}x{j}" for j in range(40))])
        assert len(e.memo) <= 50 + 41


def test_counts_equal_the_library(byte_bpe):
    counter = bpe_count.MergeCounter(byte_bpe)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(texts, max_size=5))
    def holds(values):
        assert counter.count(values) == [len(x) for x in library(byte_bpe, values)]

    holds()
    assert counter.count([*TRICKY, None]) == [*(len(x) for x in library(byte_bpe, TRICKY)), 0]


def test_count_tokens(docs, empty, small, byte_bpe):
    got = bpe_count.count_tokens(docs, byte_bpe, limit=5)
    want = sorted((i is not None, i or 0, len((t or "").encode()), len(library(byte_bpe, [t or ""])[0])) for i, t in small)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got.collect()) == want
    assert all(r.over_limit == (r.n_tokens > 5) for r in got.collect())
    assert bpe_count.count_tokens(empty, byte_bpe).count() == 0


def test_other_vocabularies_are_refused(word_bpe):
    with pytest.raises(ValueError):
        bpe_count.MergeCounter(word_bpe)


def shards(spark, docs, path, **kw):
    return sstable.write_token_shards(docs, path, common.fresh_dir(spark, "test-sst"), **kw)


@pytest.mark.parametrize("shard_bytes", [2**30, 40_000])
def test_shards_round_trip(spark, docs, small, byte_bpe, shard_bytes):
    manifest = shards(spark, docs, byte_bpe, shard_bytes=shard_bytes)
    rows = sorted(small, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for i, t in rows:
        ids = [*library(byte_bpe, [t or ""])[0], 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    got = sorted(sstable.read_token_shards(manifest).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in got] == want
    assert sorted(map(tuple, sstable.digest_token_shards(manifest).collect()), key=lambda r: r[1]) == [w[:4] for w in want]
    assert [x.tolist() for x in sstable.lookup(manifest, 8)] == [want[-1][4]]
    assert len(sstable.lookup(manifest, 5)) == 2 and len(sstable.lookup(manifest, None)) == 1
    assert sstable.lookup(manifest, 6) == []


def test_shards_of_an_empty_table(spark, empty, byte_bpe):
    manifest = shards(spark, empty, byte_bpe)
    assert sstable.read_token_shards(manifest).count() == 0 and sstable.lookup(manifest, 1) == []


def test_an_id_with_many_rows_is_dealt_out(spark, byte_bpe):
    """A hot id's rows make several shards, no task holds all; a lookup opens just those whose range holds the id."""
    rows = [(5, f"row {i} of the hot one " + "word " * 50) for i in range(2000)] + [(i, f"text {i}") for i in range(1000)] + [(None, "none"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    manifest = shards(spark, df, byte_bpe, shard_bytes=30_000)
    made = manifest.orderBy("task", "number").collect()
    assert sum(r.entries for r in made) == 3002 and max(r.entries for r in made) < 400 and len(made) > 10
    start = 0
    for r in made:
        assert r.start == start
        start += r.tokens
    assert len(sstable.lookup(manifest, 5)) == 2001 and len(sstable.lookup(manifest, None)) == 2 and len(sstable.lookup(manifest, 999)) == 1
    assert sstable.lookup(manifest, 1000) == [] and sstable.lookup(manifest, -1) == []
    got = sorted((r.start, r.doc_id is not None, r.doc_id or 0) for r in sstable.digest_token_shards(manifest).collect())
    assert len(got) == 3002 and [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_lookup_over_many_blocks():
    w = sstable.Writer()
    rng = np.random.default_rng(0)
    keys = sorted(rng.choice(10**6, 3000, replace=False).tolist())
    for k in keys:
        w.add(sstable.key_of(k - 5000), sstable.pack_ids(np.full(40, k, "<u4").tobytes()), 40)
    r = sstable.Reader(w.finish())
    assert len(r.places) > 3 and r.entries == 3000
    for k in keys[::37]:
        assert [sstable.unpack_ids(v)[0] for v in r.get(sstable.key_of(k - 5000))] == [k]
    absent = [k for k in range(2000) if k not in set(keys)]
    assert not any(r.get(sstable.key_of(k - 5000)) for k in absent)
    assert sum(r.may_hold(sstable.key_of(k - 5000)) for k in absent) < 0.05 * len(absent)
    with pytest.raises(ValueError):
        w.add(b"\x00", b"", 0)


# --- packing ------------------------------------------------------------------------------------------------------------


def check_plan(counts, capacity):
    plan = packing.plan_sequences(counts, capacity)
    got = np.zeros(capacity + 1, np.int64)
    for config, n in plan:
        assert sum(length * m for length, m in config.items()) <= capacity
        for length, m in config.items():
            got[length] += n * m
    assert (got == counts).all()
    return sum(n for _, n in plan)


def test_plan_is_near_the_lower_bound():
    rng = np.random.default_rng(3)
    lengths = np.clip(rng.lognormal(4, 1, 60_000).astype(int), 1, 256)
    n = check_plan(np.bincount(lengths, minlength=257), 256)
    assert n <= 1.004 * lengths.sum() / 256


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_any_plan_is_whole(lengths):
    n = check_plan(np.bincount(np.array(lengths, int), minlength=33), 32)
    assert -(-sum(lengths) // 32) <= n <= max(1, 2 * -(-sum(lengths) // 32))


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(20):
        worth = np.where(rng.random(13) < 0.5, rng.random(13), 0.0)
        worth[0] = 0
        best = np.zeros(13)
        for room in range(1, 13):
            best[room] = max([best[room - 1], *(best[room - x] + worth[x] for x in range(1, room + 1) if worth[x] > 0)])
        config = packing.knapsack(worth, 12)
        assert sum(k * m for k, m in config.items()) <= 12
        assert sum(worth[k] * m for k, m in config.items()) == pytest.approx(best[12])


def test_pack(docs, empty, small, word_bpe):
    packed = packing.pack(docs, word_bpe, capacity=64, with_ids=True)
    rows = packed.collect()
    pieces = {}
    for i, t in small:
        ids = [*library(word_bpe, [t or ""])[0], 0]
        for k, at in enumerate(range(0, len(ids), 64)):
            pieces.setdefault((i, k, at, len(ids[at : at + 64]), zlib.crc32(np.array(ids[at : at + 64], "<u4").tobytes())), []).append(1)
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
    assert got == pieces
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    for parts in by.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert whole == {s: b"".join(bytes(p[2]) for p in sorted(parts)) for s, parts in by.items()}
    assert packing.pack(empty, word_bpe).count() == 0
