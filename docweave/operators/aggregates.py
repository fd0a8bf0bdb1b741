"""Aggregates of reports, metrics and facts; partial aggregation happens before each shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Part of whole in per cent, half-way cases by decimals; null of nothing."""
    return F.round(F.try_divide(part * F.lit(100.0), F.nullif(whole, F.lit(0))).cast("decimal(18,4)"), digits)


def status_counts(df: DataFrame, keys: list[str], status: Column, values: Mapping[str, str]) -> DataFrame:
    """Rows by key, with a count for each status."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(status == v).alias(k) for k, v in values.items()])


def attempt_metrics(df: DataFrame, keys: list[str], success: Column, duration: str, tokens: str) -> DataFrame:
    """Attempts, the share that succeeded, their mean duration, and mean tokens of the successes."""
    ok = F.count_if(success)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("attempts"),
        ok.alias("successes"),
        F.round(F.try_divide(ok, F.count(F.lit(1))).cast("decimal(18,6)"), 4).alias("success_rate"),
        F.round(F.avg(duration).cast("decimal(24,6)"), 4).alias("avg_duration"),
        F.round(F.avg(F.when(success, F.col(tokens))).cast("decimal(24,6)"), 4).alias("avg_tokens"),
    )


def top_messages(df: DataFrame, message: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent messages, lower-cased and trimmed; ties by text."""
    return df.groupBy(F.lower(F.trim(F.col(message))).alias("message")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "message").limit(k)


#: Percentiles and the number of values each one needs.
PERCENTILES = ((0.50, 1), (0.90, 10), (0.95, 20), (0.99, 100))


#: Ranges of values whose counts are summed up for percentiles.
RANGES = 1024


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join on keys that are equal or both null."""
    other = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    test = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        test = one if test is None else test & one
    return left.join(other, test).drop(*[f"__r_{k}" for k in keys])


def exclusive_percentiles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """p50, p90, p95 and p99 at ``(n + 1) p`` with linear interpolation; 0 where there are too few values.

    Distinct values are counted first, then the counts of ``RANGES`` ranges of values summed up; only ranges that hold a wanted rank are
    ranked value by value, each by itself. So no group's values are gathered, and no task ranks all of a group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    x = F.col(value).cast("double")
    ends = counts.groupBy(*keys).agg(F.min(x).alias("__min"), F.max(F.when(~F.isnan(x), x)).alias("__max"), F.sum("__c").alias("__n"))
    # grows with the value; not-a-number comes last
    at = F.when(F.isnan(x), F.lit(RANGES)).when(F.col("__max") > F.col("__min"), F.floor((x - F.col("__min")) / (F.col("__max") - F.col("__min")) * (RANGES - 1))).otherwise(0).cast("int")
    counts = join_null_safe(counts, ends, keys).withColumn("__b", at).drop("__min", "__max")
    of_range = counts.groupBy(*keys, "__b").agg(F.sum("__c").alias("__in"), F.max("__n").alias("__n")).withColumn("__before", F.sum("__in").over(W.partitionBy(*keys).orderBy("__b")) - F.col("__in"))
    ranks = [F.greatest(F.lit(1), F.least(F.floor((F.col("__n") + 1) * p) + k, F.col("__n"))) for p, _ in PERCENTILES for k in (-1, 0, 1)]
    wanted = of_range.where(F.greatest(*[(r > F.col("__before")) & (r <= F.col("__before") + F.col("__in")) for r in ranks])).drop("__n", "__in")
    held = join_null_safe(counts, wanted, [*keys, "__b"])
    ranked = held.withColumn("__to", F.col("__before") + F.sum("__c").over(W.partitionBy(*keys, "__b").orderBy(value))).withColumn("__from", F.col("__to") - F.col("__c") + 1)
    aggs = [F.max("__n").alias("n")]
    for p, _ in PERCENTILES:
        at = F.greatest(F.lit(1), F.least(F.floor((F.col("__n") + 1) * p), F.col("__n") - 1))
        here = lambda x: F.max(F.when((F.col("__from") <= x) & (x <= F.col("__to")), F.col(value)))
        aggs += [here(at).alias(f"__lo{p}"), here(F.least(at + 1, F.col("__n"))).alias(f"__hi{p}"), F.max((F.col("__n") + 1) * p - at).alias(f"__f{p}")]
    out = ranked.groupBy(*keys).agg(*aggs)
    return out.select(*keys, "n", *[F.when(F.col("n") >= least, F.col(f"`__lo{p}`") + (F.col(f"`__hi{p}`") - F.col(f"`__lo{p}`")) * F.col(f"`__f{p}`")).otherwise(F.lit(0.0)).alias(f"p{round(p * 100)}") for p, least in PERCENTILES])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Values with their counts and per cent of all rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("__t"))
    return counts.join(F.broadcast(total)).select("value", "n", percent(F.col("n"), F.col("__t")).alias("pct"))


def null_profile(df: DataFrame) -> DataFrame:
    """A row per column: rows, nulls, per cent null; one pass."""
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("__n").alias("n_rows"), F.col(f"n{i}").alias("n_null")) for i, c in enumerate(df.columns)])
    return one.select(F.inline(rows)).withColumn("pct_null", percent(F.col("n_null"), F.col("n_rows")))


def table_statistics(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A row per column: table, rows, column, type, whether it may be null; and the bytes of the files under ``path``, if it is given."""
    spark = df.sparkSession
    columns = spark.createDataFrame([(name, f.name, f.dataType.simpleString(), f.nullable) for f in df.schema], "table_name string, column_name string, data_type string, nullable boolean")
    if path is not None:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        columns = columns.withColumn("n_bytes", F.lit(at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()).cast("long"))
    return columns.join(F.broadcast(df.agg(F.count(F.lit(1)).alias("n_rows"))))


def growth(df: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """First and last year, their values, growth, and compound growth a year (null without a positive first value or a span)."""
    g = df.groupBy(*keys).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.min_by(value, year).alias("first_value"), F.max_by(value, year).alias("last_value"))
    span = F.col("last_year") - F.col("first_year")
    ratio = F.try_divide(F.col("last_value").cast("double"), F.col("first_value").cast("double"))
    return g.withColumns({"growth": F.round((ratio - 1).cast("decimal(24,8)"), 4), "cagr": F.when((span > 0) & (F.col("first_value") > 0), F.round((F.pow(ratio, 1.0 / span) - 1).cast("decimal(24,8)"), 4))})


def concentration(df: DataFrame, keys: list[str], part: str, value: str, k: int = 5) -> DataFrame:
    """Share of the ``k`` largest parts, and how many parts have any."""
    parts = df.groupBy(*keys, part).agg(F.sum(value).alias("v"))
    ranked = parts.withColumn("r", F.row_number().over(W.partitionBy(*keys).orderBy(F.col("v").desc(), part)))
    return ranked.groupBy(*keys).agg(percent(F.sum(F.when(F.col("r") <= k, F.col("v"))), F.sum("v")).alias("top_share"), F.count_if(F.col("v") > 0).alias("present"))
