"""Operators over neighbouring rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in an order; the order should have no ties."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def oldest_kept(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Each row with ``keep``: whether it is the first of its key."""
    return df.withColumn("keep", F.row_number().over(W.partitionBy(*keys).orderBy(*order)) == 1)


def continuity(df: DataFrame, keys: list[str], year: str, start: str, end: str) -> DataFrame:
    """Rows whose start isn't the end of the year before, where that year is there."""
    w = W.partitionBy(*keys).orderBy(year)
    linked = df.withColumns({"previous_year": F.lag(year).over(w), "previous_end": F.lag(end).over(w)})
    return linked.where((F.col(year) == F.col("previous_year") + 1) & (F.col(start) != F.col("previous_end")))


def changes(df: DataFrame, keys: list[str], year: str, measures: list[str]) -> DataFrame:
    """Each measure's change against the row before, as a share of that; null without a positive one before."""
    w = W.partitionBy(*keys).orderBy(year)
    out = {}
    for m in measures:
        before = F.lag(m).over(w)
        out[f"{m}_change"] = F.when(before > 0, F.round(((F.col(m) - before) / before).cast("decimal(24,8)"), 4))
    return df.withColumns(out)


def section_ends(df: DataFrame, doc: str, start: str, order: str, total: str | None = None, default_last: int = 75) -> DataFrame:
    """A section ends where the next starts (they share that page), at least at its own start; the last at the document's last page."""
    nxt = F.lead(start).over(W.partitionBy(doc).orderBy(order))
    last = F.coalesce(F.col(total), F.lit(default_last)) if total else F.lit(default_last)
    return df.withColumn("end_page", F.greatest(F.col(start), F.coalesce(nxt, last)))


def boundary_flags(df: DataFrame, doc: str, start: str, end: str, order: str) -> DataFrame:
    """Whether a section is reversed, starts before the one before, leaves pages between, or shares more than one page."""
    w = W.partitionBy(doc).orderBy(order)
    before_start, before_end = F.lag(start).over(w), F.lag(end).over(w)
    return df.withColumns({"reversed": F.col(start) > F.col(end), "out_of_order": F.coalesce(F.col(start) < before_start, F.lit(False)), "gap": F.coalesce(F.col(start) > before_end + 1, F.lit(False)), "overlap": F.coalesce(F.col(start) < before_end, F.lit(False))})


def strictly_increasing(df: DataFrame, doc: str, start: str, order: str) -> DataFrame:
    """A row per document: whether each start is beyond the one before."""
    ok = F.coalesce(F.col(start) > F.lag(start).over(W.partitionBy(doc).orderBy(order)), F.lit(True))
    return df.withColumn("__ok", ok).groupBy(doc).agg(F.bool_and("__ok").alias("increasing"))


SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def trailing_mean(df: DataFrame, keys: list[str], at: str, value: str, interval: str = "1 hour") -> DataFrame:
    """The mean over the interval (a number and seconds, minutes, hours, days or weeks) that ends at each row. Rows with a null time have their own mean.

    Time is cut into stretches of the interval's length: a row stands in its own and, for the rows there alone, in the next one. So a key's rows are dealt out by
    stretch, however many it has. The interval that ends at a row is the end of the stretch before and the beginning of its own: one running sum backwards over the
    former, whose rows are moved on by the interval, and one forwards over the latter, so that each row is added up twice, however many an interval has, and nothing is
    taken off again.
    """
    n, unit = interval.split()
    length = int(n) * SECONDS[unit.rstrip("s")] * 1_000_000
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    stretch = F.floor(micros / length)
    place = lambda s, own, u: F.struct(s.alias("s"), F.lit(own).alias("own"), u.alias("u"))
    places = F.when(F.col(at).isNull(), F.array(place(F.lit(None).cast("long"), True, micros))).otherwise(F.array(place(stretch, True, micros), place(stretch + 1, False, micros + length)))
    rows = df.withColumn("__w", F.explode(places))
    of_avg = df.select(F.avg(value)).schema[0].dataType
    x = F.col(value) if isinstance(of_avg, T.DecimalType) else F.col(value).cast("double")
    own = F.col("__w.own")
    stretches = W.partitionBy(*keys, "__w.s")
    # of rows at one place those of the stretch before come first, as they count
    before = stretches.orderBy(F.col("__w.u").desc(), own).rowsBetween(W.unboundedPreceding, W.currentRow)
    until = stretches.orderBy("__w.u").rangeBetween(W.unboundedPreceding, W.currentRow)
    summed = rows.withColumns({"__a": F.sum(F.when(~own, x)).over(before), "__b": F.count(F.when(~own, x)).over(before)}).withColumns({"__c": F.sum(F.when(own, x)).over(until), "__d": F.count(F.when(own, x)).over(until)})
    total = F.coalesce(F.col("__a") + F.col("__c"), F.col("__a"), F.col("__c"))
    mean = (total / F.nullif(F.col("__b") + F.col("__d"), F.lit(0))).cast(of_avg)
    return summed.where(own).withColumn("trailing_mean", mean).drop("__w", "__a", "__b", "__c", "__d")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
