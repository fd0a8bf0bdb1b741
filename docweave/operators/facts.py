"""Extraction results flattened into fact rows: a main fact, listed ones, and derived ones, in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fee(name: Column, cents: Column, percentage: Column, kind: str, basis: Column | None = None) -> Column:
    """A fee as a struct of one shape, whichever list it comes from."""
    return F.struct(
        name.cast("string").alias("fee_name"),
        cents.cast("long").alias("amount_cents"),
        percentage.cast("double").alias("amount_percentage"),
        F.lit(kind).alias("fee_kind"),
        (basis if basis is not None else F.lit(None)).cast("string").alias("calculation_basis"),
    )


def flattened(df: DataFrame, key: list[str], *parts: Column) -> DataFrame:
    """``parts``: structs or arrays of structs of one shape; a row per struct that isn't null, numbered from 0 in their order."""
    arrays = [p if is_array else F.array(p) for p, is_array in parts]
    return df.select(*key, F.posexplode(F.array_compact(F.concat(*arrays))).alias("fact_no", "__f")).select(*key, "fact_no", "__f.*")


def initial_fees(df: DataFrame, key: list[str]) -> DataFrame:
    """The franchise fee, additional fees, and the fee of a further unit if there is one."""
    none = F.lit(None)
    main = fee(F.lit("Initial Franchise Fee"), F.col("initial_franchise_fee_cents"), none, "primary")
    more = F.transform(F.coalesce("additional_fees", F.array()), lambda f: fee(f["fee_name"], f["amount_cents"], none, "additional"))
    unit = F.when(F.coalesce("additional_unit_fee_cents", F.lit(0)) != 0, fee(F.lit("Additional Unit Fee"), F.col("additional_unit_fee_cents"), none, "unit"))
    return flattened(df, key, (main, False), (more, True), (unit, False))


def other_fees(df: DataFrame, key: list[str]) -> DataFrame:
    """Royalty and marketing fees where they are said, then the others. A marketing percentage is of gross sales and comes before an amount."""
    none = F.lit(None)
    royalty = F.when(F.col("royalty_percentage").isNotNull(), fee(F.lit("Royalty Fee"), none, F.col("royalty_percentage"), "royalty", F.col("royalty_basis")))
    by_share = F.col("marketing_fee_percentage").isNotNull()
    marketing = F.when(
        by_share | F.col("marketing_fee_cents").isNotNull(),
        fee(F.lit("Marketing/Advertising Fee"), F.when(~by_share, F.col("marketing_fee_cents")), F.col("marketing_fee_percentage"), "marketing", F.when(by_share, F.lit("Gross Sales"))),
    )
    more = F.transform(F.coalesce("other_fees", F.array()), lambda f: fee(f["fee_name"], f["amount_cents"], f["amount_percentage"], "other"))
    return flattened(df, key, (royalty, False), (marketing, False), (more, True))


def investment_totals(items: DataFrame, key: list[str], *, stated_low: str = "stated_low", stated_high: str = "stated_high", tolerance: int = 100) -> DataFrame:
    """Totals of an investment's items: the stated ones or, where absent, the items' sums if those are above zero; and whether both agree."""
    sums = items.groupBy(*key).agg(F.sum(F.coalesce("low_cents", F.lit(0))).alias("sum_low"), F.sum(F.coalesce("high_cents", F.lit(0))).alias("sum_high"), F.max(stated_low).alias(stated_low), F.max(stated_high).alias(stated_high))
    total = lambda said, s: F.coalesce(F.col(said), F.when(F.col(s) > 0, F.col(s)))
    agrees = (F.abs(F.coalesce(F.col(stated_low), F.col("sum_low")) - F.col("sum_low")) <= tolerance) & (F.abs(F.coalesce(F.col(stated_high), F.col("sum_high")) - F.col("sum_high")) <= tolerance)
    return sums.select(*key, total(stated_low, "sum_low").alias("total_low"), total(stated_high, "sum_high").alias("total_high"), agrees.alias("totals_match"))


def minimum_total(base: Column, extra: Column) -> Column:
    """A base fee and the sum of an array of others."""
    return F.coalesce(base, F.lit(0)) + F.aggregate(F.coalesce(extra, F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x, F.lit(0)))


def discounted(fee_cents: Column, discounts: Column, kind: str) -> Column:
    """The fee less the first discount of a kind: an amount or a percentage; the fee itself where there is none."""
    first = F.get(F.filter(F.coalesce(discounts, F.array()), lambda d: F.lower(d["kind"]) == kind.lower()), F.lit(0))
    return F.when(first["amount_cents"].isNotNull(), fee_cents - first["amount_cents"]).when(first["percentage"].isNotNull(), (fee_cents * (1 - first["percentage"] / 100)).cast("long")).otherwise(fee_cents)
