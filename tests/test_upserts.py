"""Upserts from a stream: stopped, run again and cut otherwise, the table is that of one batch."""

import random

import pytest
from pyspark.sql import functions as F

from docweave.streaming import upserts

SCHEMA = "k string, part string, at long, new int"


def changes(n=300):
    rng = random.Random(n)
    return [(rng.choice([None, *"abcdefgh"]), rng.choice([None, "", "é/=x", "p"]), rng.choice([None, *range(20)]), i) for i in range(n)]


def plain(rows):
    last, loose = {}, []
    for r in rows:
        if r[0] is None or r[1] is None:
            loose.append(r)
        elif r[:2] not in last or (-1 if r[2] is None else r[2], r[3]) > (-1 if last[r[:2]][2] is None else last[r[:2]][2], last[r[:2]][3]):
            last[r[:2]] = r
    return sorted([*last.values(), *loose], key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("part", [None, "part"])
def test_batches_run_twice_and_break_off(spark, tmp_path, part, monkeypatch):
    rows = changes()
    table = upserts.VersionedTable(spark, f"file://{tmp_path}/t", SCHEMA, part)
    assert table.current().collect() == []
    frame = lambda lo, hi: spark.createDataFrame(rows[lo:hi], SCHEMA)
    keys = ["k", "part"]
    assert table.apply(frame(0, 100), 0, keys, "at")
    assert not table.apply(frame(0, 100), 0, keys, "at")  # again
    with monkeypatch.context() as m:  # broken off after the version, before the ledger
        m.setattr(table, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            table.apply(frame(100, 200), 1, keys, "at")
    assert rows_of(table.current()) == plain(rows[:100])
    other = upserts.VersionedTable(spark, f"file://{tmp_path}/t", SCHEMA, part)  # after a restart
    assert other.apply(frame(100, 200), 1, keys, "at")
    assert other.apply(frame(200, 200), 2, keys, "at")  # an empty batch
    assert other.apply(frame(200, 300), 3, keys, "at")
    assert rows_of(other.current()) == plain(rows)
    assert other.batches() == [0, 1, 2, 3] and not other._commit(3, {})
    if part is None:
        assert len(other._names("versions")) == 2  # nothing is left of what broke off


def test_stopped_and_restarted_stream(spark, tmp_path):
    """The checkpoint is behind the table: the batch that was done but not noted runs again and changes nothing."""
    rows = changes(90)
    for b in range(3):
        spark.createDataFrame(rows[b * 30 : b * 30 + 30], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    table = upserts.VersionedTable(spark, f"file://{tmp_path}/t", SCHEMA)
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    calls, apply = [], table.apply

    def failing(batch, n, keys, order):
        calls.append((n, apply(batch, n, keys, order)))
        if n == 1 and len(calls) == 2:
            raise RuntimeError("stopped after the batch was applied")

    table.apply = failing
    with pytest.raises(Exception, match="stopped after"):
        upserts.start(stream(), table, f"file://{tmp_path}/c", keys=["k", "part"], order="at").awaitTermination()
    upserts.start(stream(), table, f"file://{tmp_path}/c", keys=["k", "part"], order="at").awaitTermination()
    assert calls == [(0, True), (1, True), (1, False), (2, True)]
    assert rows_of(table.current()) == plain(rows)


def test_clashing_columns(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 6)], "k string, new int, rank int")
    assert rows_of(upserts.merged(df.limit(0), df, ["k"], "new")) == [("a", 2, 6)]
    assert upserts.merged(df, df.limit(0), ["k"], "new").count() == 1 and df.select(F.max("rank")).head()[0] == 6
