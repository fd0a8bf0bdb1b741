"""Line dedup against plain Python; the filters miss nothing."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from docweave.llm import line_dedup, queries


def plain(rows, least=20, min_docs=3):
    """doc_id, text left, lines and lines dropped, by counting all keys."""
    cut = [[(x, line_dedup.key_of(x, least)) for x in line_dedup.lines_of(t)] for _, t in rows]
    held, last = Counter(), {}
    for (i, _), lines in zip(rows, cut):
        for k in {k for _, k in lines if k is not None}:
            held[k] += 1
            last[k] = max(last.get(k, -1), -1 if i is None else i)
    out = []
    for (i, _), lines in zip(rows, cut):
        left = [x for x, k in lines if k is None or held[k] < min_docs or last[k] == (-1 if i is None else i)]
        out.append((-1 if i is None else i, b"\n".join(left).decode(), len(lines), len(lines) - len(left)))
    return sorted(out)


def rows_of(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect())


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(rows)
    assert sum(r[3] for r in want) > 0
    got = queries.op13_line_dedup(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in want]


LONG = "This line is told again and again"


def odd_rows():
    return [
        (1, None), (2, ""), (3, "\n"), (4, f"{LONG}\nown words of this one document"), (5, f"  {LONG.upper()}\t\r\nshort\n{LONG}"), (6, f"\x0b{LONG}\x0c"), (6, f"{LONG}\nelse"),
        (None, f"{LONG}\nof no id at all, it seems"), (None, "of no id at all, it seems"), (None, "of no id at all, it seems"), (7, "é" * 19 + "\nshort"), (8, "é" * 19 + "\nshort"), (9, "é" * 19 + "\nshort"),
        (10, "É" * 20), (11, "É" * 20), (12, "É" * 20), (13, "é" * 20), (14, "twice only, not three times"), (15, "twice only, not three times"),
        (16, "\n".join(f"line number {i} of a long text" for i in range(30000))), (17, "\n".join(f"line number {i} of a long text" for i in range(0, 30000, 2))), (18, "\n".join(f"line number {i} of a long text" for i in range(0, 30000, 3))),
        (19, "\x1cthis has a separator that isn't white space\x1c"), (20, "this has a separator that isn't white space"), (21, "this has a separator that isn't white space"),
    ]


@pytest.mark.parametrize("max_bits", [1 << 31, 64])
def test_odd_rows(spark, max_bits):
    """Nulls, empty texts, ties on the largest id, repeated rows, long texts, clashing columns; a filter far too small changes nothing."""
    df = spark.createDataFrame([(i, t, "x", 1, b"") for i, t in odd_rows()], "doc_id long, text string, line string, __row int, __asked binary").repartition(5)
    got = line_dedup.drop_repeated_lines(df, max_bits=max_bits)
    assert got.columns == ["doc_id", "text", "line", "__row", "__asked", "n_lines", "n_dropped"]
    assert rows_of(got) == plain(odd_rows())


def test_empty_and_taken_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_repeated_lines(df).collect() == []
    with pytest.raises(ValueError, match="n_lines"):
        line_dedup.drop_repeated_lines(spark.createDataFrame([(1, "a", 1)], "doc_id long, text string, N_Lines int"))


def test_filters(spark, tmp_path):
    """All keys that two documents hold are suspected, whether one task or several saw them, and few others."""
    rows = [(i, "\n".join(f"sentence {k} that stands in a document" for k in (i, i + 1, 10_000 + i))) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    built = line_dedup.build_filter(df, str(tmp_path), text="text", least=20, bits_per_line=16, max_bits=1 << 31)
    asked = line_dedup.Filter(str(tmp_path), *built)
    key = lambda k: f"sentence {k} that stands in a document".encode()
    assert asked.holds(line_dedup.hashed([key(k) for k in range(1, 2000)])).all()
    assert asked.holds(line_dedup.hashed([key(10_000 + i) for i in range(2000)])).mean() < 0.02
    assert asked.holds(np.zeros(0, np.uint64)).tolist() == []
