"""Fingerprints, links and components against brute force."""

import random

import numpy as np
import xxhash

from docweave.llm import simhash
from docweave.llm.components import connected_components


def slow_print(text, shingle=3):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def slow_components(prints, distance):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints(small):
    from docweave.llm.common import lower_words_of

    for _, t in small[:8]:
        assert simhash.fingerprint(lower_words_of(t), 3) == slow_print(t)


def test_every_close_pair_shares_a_choice():
    rng = random.Random(0)
    for blocks in (4, 5, 6, 7):
        masks = simhash.choices(3, blocks)
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for _ in range(rng.randint(0, 3)):
                b ^= 1 << rng.randrange(64)
            assert any(a & m == b & m for m in masks)


def family(n, seed):
    """Random prints, with chains of near ones and one large group of near copies."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for start in out[:10]:
        x = start
        for _ in range(8):
            x ^= 1 << rng.randrange(64)
            x ^= 1 << rng.randrange(64)
            out.append(x)
    hub = rng.getrandbits(64)
    for _ in range(n // 2):
        out.append(hub ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    return out


def check_links(spark, prints, n, distance=3):
    distinct = sorted(set(prints))
    nodes = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in distinct], "fp long")
    roots = {r.node % 2**64: r.root for r in connected_components(simhash.near_links(nodes, "fp", distance, n)).collect()}
    want = slow_components(distinct, distance)
    got = [roots.get(p, p - 2**64 if p >= 2**63 else p) for p in distinct]
    groups = lambda labels: sorted(sorted(i for i, x in enumerate(labels) if x == v) for v in set(labels))
    assert groups(got) == groups(want)


def test_links_against_brute_force(spark):
    check_links(spark, family(300, 1), 300)


def test_chunks_of_hot_keys_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    check_links(spark, family(200, 2), 200)
    check_links(spark, family(100, 3), 2**34)  # more blocks, as for many more prints
    check_links(spark, family(150, 5), 150, distance=5)
    check_links(spark, family(80, 6), 2**26, distance=5)


def test_finer_choices_keep_every_close_pair():
    rng = random.Random(4)
    for mask in [*simhash.choices(3, 4), *simhash.choices(3, 7)]:
        finer = simhash.finer_choices(mask, 3)
        assert all(f & mask == mask and f != mask for f in finer)
        free = [i for i in range(64) if not mask >> i & 1]
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for i in rng.sample(free, rng.randint(0, 3)):
                b ^= 1 << i
            assert any(a & f == b & f for f in finer)


def test_a_hot_block_is_split_by_other_bits(spark, monkeypatch):
    """Prints that share a block by their nature: runs stay short, no link is lost."""
    monkeypatch.setattr(simhash, "CHUNK", 64)
    rng = random.Random(6)
    prints = [rng.getrandbits(48) for _ in range(1500)]
    prints += [p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(48)) for p in prints[:100]]
    check_links(spark, prints, len(prints))


def test_near_duplicates(spark, docs, empty, small):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(small)
    texts = {}
    for i, t in small:
        texts.setdefault(i, t)
    assert all(int(r.fingerprint, 16) == slow_print(texts[r.doc_id]) for r in got)
    by = {r.doc_id: r.component_id for r in got}
    assert by[1] == by[2] == by[3] == 1 and by[5] == 5
    assert simhash.near_duplicates(empty).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    from docweave.llm.queries import op2_simhash_dedup

    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    prints = [slow_print(r.text) for r in docs]
    roots = slow_components(prints, 3)
    want = [(r.doc_id, f"{p:016x}", docs[k].doc_id) for r, p, k in zip(docs, prints, roots)]
    assert sorted(map(tuple, op2_simhash_dedup(spark, sf_dir).collect())) == want


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (150, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
