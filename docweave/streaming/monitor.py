"""Monitoring as a stream: minutes by an aggregation, then state of its own per key: the last hour, runs of failures, backoff and stop.

Events of a key are gathered by minute until the watermark has passed the minute, so that late ones take their place; the minute then leaves the aggregation as
six numbers. A key's minutes of a batch come after those of all batches before, so they are put in order and walked as arrays, with one read and one write of the
key's state a batch. Each gives one row: its events, its failures, the share of failures over the last hour, the run of failures at its end, the seconds to
wait after them, and whether the key has stopped. The state holds the last hour's minutes; a key that has been silent for a day (``RING`` minutes) loses its state
by its timer. A run of ``STOP`` failures stops a key for good within that day.

What is held at once is a minute's events of a key, and a key's minutes of a batch as six numbers each: some 25 MB a year of minutes. Events go by time, then id.
Null times and keys are left out, a null ``failed`` is no failure, events of minutes that the watermark has passed are dropped by Spark.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import runs_on_executors

runs_on_executors(__name__)

# Minutes of silence after which a key's state goes, minutes of the mean, seconds between rounds and at most after failures, failures in a row that stop a key.
RING, HOUR, INTERVAL, MOST_WAIT, STOP = 1440, 60, 60, 300, 5
#: A minute's numbers: itself, its events, its failures, those before its first success, those after its last, its longest run.
NUMBERS = ["minute", "n", "failed", "head", "tail", "most"]
#: Minutes in a row on their way to their key's state, and minutes walked at once.
PACK, PIECE = 100, 10_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def wait_seconds(run: int) -> int:
    """After ``run`` failures in a row."""
    return min(INTERVAL * 2 ** min(run - 1, 20), MOST_WAIT) if run else 0


def walk(run: int, stopped: bool, hour: np.ndarray, minutes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The run at each minute's end, whether the key has stopped, and the hour's share of failures; ``minutes`` in order, a row each as in ``NUMBERS``, ``hour`` those before (minute, events, failures)."""
    minute, n, failed, head, tail, most = minutes.T
    # failures since the last minute with a success, and those at that minute's end; before the first one the run comes from before
    fails = np.cumsum(np.where(failed == n, n, 0))
    anchor = np.maximum.accumulate(np.where(failed == n, -1, np.arange(len(minute))))
    runs = fails + np.where(anchor < 0, run, (tail - fails)[anchor])
    longest = np.maximum(most, np.append(run, runs[:-1]) + head)
    near = np.concatenate([hour, minutes[:, :3]])
    sums = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(near[:, 1:], axis=0)])
    many = sums[len(hour) + 1 :] - sums[np.searchsorted(near[:, 0], minute - HOUR, side="right")]
    return runs, np.logical_or.accumulate(longest >= STOP) | stopped, many[:, 1] / many[:, 0]


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Minutes of the same key, up to ``PACK`` a row, as a state takes a row at a time; null keys stay behind."""
    for batch in batches:
        batch = batch.filter(batch["known"])
        keys = batch["key"].dictionary_encode()
        code, names = keys.indices.to_numpy(), keys.dictionary.to_pylist()
        order = np.argsort(code, kind="stable")
        code, rows = code[order], np.column_stack([batch[c].to_numpy() for c in NUMBERS])[order]
        ends = [*(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
        cuts = [(c, min(c + PACK, b)) for a, b in zip([0, *ends], ends) for c in range(a, b, PACK)]
        yield pa.RecordBatch.from_pydict({"key": pa.array([names[code[a]] for a, _ in cuts], pa.string()), "minutes": pa.array([rows[a:b].tobytes() for a, b in cuts], pa.binary())})


class Monitor(StatefulProcessor):
    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "run long, stopped boolean, last long, hour array<struct<minute: long, n: long, failed: long>>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = np.concatenate([np.frombuffer(m, np.int64) for piece in rows for m in piece.iloc[:, 1]]).reshape(-1, len(NUMBERS))
        order = np.argsort(held[:, 0])
        run, stopped, last, hour = self.now.get() if self.now.exists() else (0, False, None, [])
        hour = np.array([tuple(m) for m in hour], np.int64).reshape(-1, 3)
        if last is not None:
            self.handle.deleteTimer((last + RING + 1) * 60_000)
        for a in range(0, len(order), PIECE):
            minutes = held[order[a : a + PIECE]]
            runs, stops, share = walk(run, stopped, hour, minutes)
            run, stopped, last = int(runs[-1]), bool(stops[-1]), int(minutes[-1, 0])
            hour = np.concatenate([hour, minutes[:, :3]])
            hour = hour[hour[:, 0] > last - HOUR]
            waits = np.array([wait_seconds(r) for r in range(8)])[np.minimum(runs, 7)]  # the longest wait is reached by then
            yield pd.DataFrame({self.key: key[0], "minute": pd.to_datetime(minutes[:, 0] * 60, unit="s"), "n": minutes[:, 1], "failed": minutes[:, 2], "failed_1h": share, "run": runs, "wait_s": waits, "stopped": stops})
        self.now.update((run, stopped, last, [tuple(m) for m in hour.tolist()]))
        self.handle.registerTimer((last + RING + 1) * 60_000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.now.clear()  # a key has one timer, of its silence
        yield from ()

    def close(self) -> None:
        pass


@contextlib.contextmanager
def keyed_state(spark: SparkSession):
    """While this holds, streams that start keep their state in RocksDB, which timers and maps need."""
    was = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if was is None else spark.conf.set(_PROVIDER, was)


def monitored(events: DataFrame, *, key: str, at: str, failed: str, order: str) -> DataFrame:
    """A row for each key and minute with events, once the watermark on ``at`` has passed it. Start it within ``keyed_state``."""
    kind = events.schema[key].dataType.simpleString()
    # null keys stay till the minutes are packed: a filter on them would move below the watermark, and take the times of an end's marker away
    rows = events.where(F.col(at).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(key).isNotNull().alias("known"), F.col(at).alias("ts"),
        F.struct(F.unix_micros(at).alias("at"), F.coalesce(F.col(order).cast("long"), F.lit(0)).alias("id"), F.coalesce(F.col(failed), F.lit(False)).alias("failed")).alias("event"),
    )
    gathered = rows.groupBy("key", "known", F.window("ts", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if("event.failed").alias("failed"), F.array_sort(F.collect_list("event")).alias("events"))

    def step(so_far, event):
        run, head = F.when(event["failed"], so_far["tail"] + 1).otherwise(0), so_far["head"]
        return F.struct((so_far["n"] + 1).alias("n"), F.when(event["failed"] & (head == so_far["n"]), head + 1).otherwise(head).alias("head"), run.alias("tail"), F.greatest(so_far["most"], run).alias("most"))

    zero = F.lit(0).cast("long")
    runs = F.aggregate("events", F.struct(zero.alias("n"), zero.alias("head"), zero.alias("tail"), zero.alias("most")), step)
    minutes = gathered.select("key", "known", F.expr("unix_seconds(w.start) div 60").alias("minute"), "n", "failed", runs.alias("r")).select("key", "known", "minute", "n", "failed", "r.head", "r.tail", "r.most")
    schema = f"`{key}` string, minute timestamp, n long, failed long, failed_1h double, run int, wait_s int, stopped boolean"
    return minutes.mapInArrow(packed, "key string, minutes binary").groupBy("key").transformWithStateInPandas(Monitor(key), schema, "Append", "EventTime").withColumn(key, F.col(key).cast(kind))
