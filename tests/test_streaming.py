"""Streams run to their end over small files."""

import datetime
import os
from pathlib import Path

from pyspark.sql import functions as F

from docweave.streaming import metrics


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = metrics.event_stream(spark, sf_dir, batch.schema, pathGlobFilter="events.parquet")
    got = metrics.run_to_table(metrics.hourly_counts(stream), "hourly_test", f"file://{tmp_path}/c", "complete")
    want = metrics.hourly_counts(batch.withColumn("ts", F.col("ts").cast("timestamp")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_consecutive_failures(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1)
    rows = [("a", t + datetime.timedelta(minutes=i), i != 3) for i in range(8)] + [("b", t, True)]
    spark.createDataFrame(rows, "k string, ts timestamp, failed boolean").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, ts timestamp, failed boolean").parquet(f"{tmp_path}/in")
    got = metrics.run_to_table(metrics.consecutive_failures(stream, "k", "failed", 3), "failures_test", f"file://{tmp_path}/c")
    assert sorted(map(tuple, got.collect())) == [("a", 3), ("a", 3)]


def test_duplicates_within_watermark(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([("x", t), ("x", t), ("y", t)], "sha256 string, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = metrics.event_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    got = metrics.run_to_table(metrics.first_of_content(stream).select("sha256"), "content_test", f"file://{tmp_path}/c")
    assert sorted(r[0] for r in got.collect()) == ["x", "y"]


def plain_minutes(rows):
    """Each key's minutes from all its events at once: n, failed, the hour's share, the run at the end, the wait, stopped."""
    out = []
    for key in {k for k, *_ in rows}:
        events = sorted((at, i, bool(f)) for k, at, i, f in rows if k == key)
        run, stopped, minutes = 0, False, {}
        for at, _, f in events:
            minute = at.replace(second=0, microsecond=0)
            run = run + 1 if f else 0
            stopped = stopped or run >= 5
            n, failed, _, _ = minutes.get(minute, (0, 0, 0, False))
            minutes[minute] = (n + 1, failed + f, run, stopped)
        for minute, (n, failed, run, stopped) in minutes.items():
            near = [v for m, v in minutes.items() if minute - datetime.timedelta(minutes=60) < m <= minute]
            out.append((key, minute, n, failed, round(sum(v[1] for v in near) / sum(v[0] for v in near), 6), run, 0 if not run else min(60 * 2 ** (run - 1), 300), stopped))
    return sorted(out)


def test_monitoring_over_batches(spark, tmp_path):
    """Files one after another as batches: late events within the watermark, equal times, nulls, runs across batches; the same as all events at once."""
    import random

    from docweave.streaming import monitor

    rng, t = random.Random(3), datetime.datetime(2024, 1, 1)
    rows = [(rng.choice("ab"), t + datetime.timedelta(seconds=rng.randrange(4 * 3600) // 7 * 7), i, rng.choice([True, True, False, None])) for i in range(500)]
    rows.sort(key=lambda r: r[1] + datetime.timedelta(seconds=rng.randrange(300)))  # up to five minutes late
    schema = "k string, ts timestamp_ntz, id long, failed boolean"
    for b in range(4):
        part = [*rows[b * 125 : (b + 1) * 125], *([(None, t, 1, True)] if b == 0 else [])]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    spark.createDataFrame([(None, metrics.END, None, None)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    files = sorted(Path(f"{tmp_path}/in").glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    for n, p in enumerate(files):  # the order in which they are taken
        os.utime(p, (1_700_000_000 + n, 1_700_000_000 + n))
    events = metrics.event_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, maxFilesPerTrigger="1")
    with monitor.keyed_state(spark):
        out = metrics.run_to_files(monitor.monitored(events, key="k", at="ts", failed="failed", order="id"), f"file://{tmp_path}/run")
    got = sorted((r["k"], r["minute"].replace(tzinfo=None), r["n"], r["failed"], round(r["failed_1h"], 6), r["run"], r["wait_s"], r["stopped"]) for r in out.withColumn("minute", F.col("minute").cast("timestamp_ntz")).collect())
    assert got == plain_minutes(rows) and any(r[7] for r in got) and {r[6] for r in got} >= {0, 60, 120, 240, 300}


def test_monitoring_asks_the_state_by_batch(spark, tmp_path):
    """A key has one timer, whatever the minutes of a batch; days of failures, keys with one minute, and the result of all events at once."""
    from docweave.streaming import monitor

    t = datetime.datetime(2024, 1, 1)
    rows = [("long", t + datetime.timedelta(minutes=7 * i), i, i % 3 > 0 or 100 < i < 400) for i in range(450)]
    rows += [(f"k{i}", t + datetime.timedelta(minutes=i), i, i % 2 == 0) for i in range(20)]
    schema = "k string, ts timestamp_ntz, id long, failed boolean"
    spark.createDataFrame(rows[::-1] + [(None, t, 1, True)], schema).repartition(2).write.parquet(f"{tmp_path}/in")
    events = metrics.event_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, end=f"file://{tmp_path}/end")
    with monitor.keyed_state(spark):
        out = monitor.monitored(events, key="k", at="ts", failed="failed", order="id")
        q = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
        q.awaitTermination()
    timers = sum(s.customMetrics.get("numRegisteredTimers", 0) for p in q.recentProgress for s in p.stateOperators)
    assert timers == 21
    got = sorted((r["k"], r["minute"].replace(tzinfo=None), r["n"], r["failed"], round(r["failed_1h"], 6), r["run"], r["wait_s"], r["stopped"]) for r in spark.read.parquet(f"{tmp_path}/out").withColumn("minute", F.col("minute").cast("timestamp_ntz")).collect())
    assert got == plain_minutes(rows)


def test_walk_in_pieces():
    """Minutes cut anywhere give what one walk gives, and what each event in turn gives."""
    import random

    import numpy as np

    from docweave.streaming import monitor

    rng = random.Random(5)
    for share in (0.5, 0.9, 1.0):
        minutes, want, run, stopped, minute = [], [], 0, False, 0
        for _ in range(300):
            minute += rng.choice([1, 1, 2, 9, 61])
            fails = [rng.random() < share for _ in range(rng.randrange(1, 5))]
            lengths = [len(s) for s in "".join("x" if f else " " for f in fails).split(" ")]
            minutes.append((minute, len(fails), sum(fails), lengths[0], lengths[-1], max(lengths)))
            for f in fails:
                run = run + 1 if f else 0
                stopped = stopped or run >= monitor.STOP
            near = [m for m in minutes if m[0] > minute - monitor.HOUR]
            want.append((run, stopped, sum(m[2] for m in near) / sum(m[1] for m in near)))
        minutes = np.array(minutes, np.int64)
        for cuts in ([], sorted(rng.sample(range(1, 300), 20))):
            got, run, stopped = [], 0, False
            for a, b in zip([0, *cuts], [*cuts, 300]):
                hour = minutes[:a, :3]
                out = monitor.walk(run, stopped, hour[hour[:, 0] > minutes[max(a - 1, 0), 0] - monitor.HOUR], minutes[a:b])
                run, stopped = int(out[0][-1]), bool(out[1][-1])
                got += zip(*(x.tolist() for x in out))
            assert got == want
