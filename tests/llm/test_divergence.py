"""The source divergence audit against plain Python, on whole small tables and on odd ones."""

import re
from collections import Counter, defaultdict
from itertools import permutations

from docweave.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans(divergence.UPPER, divergence.LOWER)


def plain(rows, min_docs=3, scale=10**9, top=200):
    """By the definition, over (text, lang, source)."""
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = [t.translate(SMALL) for t in TERM.findall(text or "")]
        groups[lang].add(source)
        counts[lang, source].update(found)
        held[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= min_docs]

        def shares(count):
            below = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + scale * (count[t] + 1) // below for t in kept}

        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        away = lambda a, b: (a - b) * (a - b) // b
        found = defaultdict(list)
        for a, b in permutations(sources, 2):
            found[a, "pair"].append((-sum(away(p[a][t], p[b][t]) for t in kept), b.encode()))
        for s in sources:
            found[s, "term"] += [(-away(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
        for (s, part), items in found.items():
            out += [(lang, s, part, item.decode(), -v, r) for r, (v, item) in enumerate(sorted(items), 1) if part == "pair" or r <= top]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows_of(divergence.audit(docs)) == plain([(r["text"], r["lang"], r["source"]) for r in docs.collect()])


def test_odd_rows(spark):
    """Nulls, empty texts, groups without terms, languages without kept terms, ties, repeated rows, a long text, letters beyond ASCII and beyond 16 bits, clashing columns."""
    rows = [(None, None, None), ("", "en", "quiet"), ("a B c", "en", "s1"), ("a B c", "en", "s1"), ("A b É é İ ſ 𝒜𝒷 x\x00y", "en", "s2"), ("é b a 𝒜𝒷", "en", "s2"), ("[a]`b`{é}~𝒜𝒷\x7fc", "en", "S2"), ("alone", "de", "s1"), ("other", "de", "s2"), (" ".join(f"w{chr(97 + i % 26)}" for i in range(20000)), "en", "s3"), ("wa wb", "en", "s3"), ("wa", "en", ""), ("only", "fr", "one")]
    df = spark.createDataFrame([(*r, 1, "g", 2, 3) for r in rows], "text string, lang string, source string, n int, term string, t int, rank int")
    got = rows_of(divergence.audit(df))
    assert got == plain(rows)
    assert [r for r in got if r[0] == "de"] == [("de", "s1", "pair", "s2", 0, 1), ("de", "s2", "pair", "s1", 0, 1)]
    assert rows_of(divergence.audit(df, min_docs=1, top=2)) == plain(rows, 1, top=2)


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_share_beyond_64_bits(spark):
    numbers = [(0, 5, 7), (9223372034, 10**12, 10**6), (9223372035, 10**12, 10**6), (10**17, 10**17 + 5, 10**9)]
    df = spark.createDataFrame(numbers, "n long, own long, kept long")
    got = divergence.with_share(df, "p", "n", "own", "kept", 10**9)
    assert [r["p"] for r in got.collect()] == [1 + 10**9 * (n + 1) // (own + kept) for n, own, kept in numbers]
