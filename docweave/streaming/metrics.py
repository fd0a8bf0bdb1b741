"""Structured Streaming over events: windowed counts, sliding means, duplicates within a watermark, alert states."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import runs_on_executors


runs_on_executors(__name__)

#: The time of an end marker, after which every window of a stream is closed: in the last year that nanoseconds reach, as pandas counts.
END = datetime.datetime(2262, 1, 1)


def event_stream(spark: SparkSession, folder: str, schema, at: str = "ts", lateness: str = "10 minutes", end: str | None = None, **options: str) -> DataFrame:
    """Parquet files as they come; the time column becomes a timestamp with zone, which a watermark needs.

    ``end``: a path for a marker beyond all times, for streams that are run to their end: it moves the watermark so that append mode gives their last windows too.
    """
    r = spark.readStream.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    events = r.parquet(folder)
    if end:
        spark.createDataFrame([tuple(END if f.name == at else None for f in schema)], schema).write.parquet(end)
        events = events.unionByName(spark.readStream.schema(schema).parquet(end))
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness)


def hourly_counts(events: DataFrame, at: str = "ts", key: str = "event_type", value: str = "value") -> DataFrame:
    """By hour and key: count and sum."""
    return events.groupBy(F.window(at, "1 hour").alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(24,6)")).alias("total")).select(F.col("w.start").alias("hour"), key, "n", "total")


def sliding_means(events: DataFrame, at: str = "ts", key: str = "event_type", value: str = "value", length: str = "1 hour", slide: str = "15 minutes") -> DataFrame:
    return events.groupBy(F.window(at, length, slide).alias("w"), key).agg(F.avg(value).alias("mean")).select(F.col("w.end").alias("until"), key, "mean")


def first_of_content(files: DataFrame, digest: str = "sha256") -> DataFrame:
    """Rows whose content the watermark's span hasn't seen yet."""
    return files.dropDuplicatesWithinWatermark([digest])


def run_to_table(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Everything that is there now, into a table in memory; for tests and small results."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def run_to_files(df: DataFrame, path: str) -> DataFrame:
    """Everything that is there now, in append mode into Parquet under ``path``, with the checkpoint beside it; the files are read back."""
    q = df.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/out")


def consecutive_failures(events: DataFrame, key: str, failed: str, limit: int = 5, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """A row each time a key has failed ``limit`` times in a row: key, failures; the run is kept between batches. Within a batch events go by ``order``; bound the batches where one key has many."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    kind = events.schema[key].dataType.simpleString()

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        run = state.get[0] if state.exists else 0
        rows = pd.concat([b[[c for c in (*order, failed) if c in b]] for b in batches], ignore_index=True)
        by = [c for c in order if c in rows]
        if by:
            rows = rows.sort_values(by, kind="stable")
        out = []
        for f in rows[failed]:
            run = run + 1 if f else 0
            if run == limit:
                out.append((k[0], run))
        state.update((run,))
        yield pd.DataFrame(out, columns=[key, "failures"])

    return events.groupBy(key).applyInPandasWithState(step, f"`{key}` {kind}, failures int", "run int", "append", GroupStateTimeout.NoTimeout)
