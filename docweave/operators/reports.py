"""Reports over validation runs and financial statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .aggregates import percent


def recommendations(scores: DataFrame, patterns: DataFrame, k: int = 5) -> DataFrame:
    """type, subject, priority: of entities scored below 80 with bypasses over 10 % or over two errors on average, and the ``k`` most frequent patterns of high severity."""
    low = scores.where("quality_score < 80")
    bypass = low.where("bypass_rate > 10").select(F.lit("HIGH_BYPASS_RATE").alias("type"), F.col("entity_type").alias("subject"), F.when(F.col("bypass_rate") > 20, "HIGH").otherwise("MEDIUM").alias("priority"))
    errors = low.where("avg_errors > 2").select(F.lit("HIGH_ERROR_RATE").alias("type"), F.col("entity_type").alias("subject"), F.lit("HIGH").alias("priority"))
    frequent = patterns.where("severity = 'HIGH'").orderBy(F.col("frequency").desc(), "field_name").limit(k).select(F.lit("FREQUENT_ERROR").alias("type"), F.col("field_name").alias("subject"), F.lit("HIGH").alias("priority"))
    return bypass.unionByName(errors).unionByName(frequent)


def slow_entities(runs: DataFrame, entity: str, duration: str, limit_ms: float = 500.0) -> DataFrame:
    """Entities whose mean duration is over the limit, with the share of slow runs."""
    g = runs.groupBy(entity).agg(F.avg(duration).alias("__m"), percent(F.count_if(F.col(duration) > limit_ms), F.count(F.lit(1))).alias("slow_rate"))
    return g.where(F.col("__m") > limit_ms).select(entity, F.round(F.col("__m").cast("decimal(24,6)"), 2).alias("avg_duration_ms"), "slow_rate")


def often_bypassed(findings: DataFrame, keys: list[str], bypassed, limit: float = 30.0) -> DataFrame:
    """Rules whose findings are bypassed in more than ``limit`` per cent of cases."""
    g = findings.groupBy(*keys).agg(percent(F.count_if(bypassed), F.count(F.lit(1))).alias("bypass_rate"))
    return g.where(F.col("bypass_rate") > limit)


def entity_quality(runs: DataFrame, entity: str) -> DataFrame:
    """By entity type: runs, share that passed, mean errors and warnings, bypass rate, score."""
    from ..functions import scalar as S

    n = F.count(F.lit(1))
    g = runs.groupBy(entity).agg(n.alias("runs"), percent(F.count_if("is_valid"), n).alias("pass_rate"), F.avg("error_count").alias("avg_errors"), F.avg("warning_count").alias("avg_warnings"), percent(F.count_if(F.col("bypass_reason").isNotNull()), n).alias("bypass_rate"))
    return g.withColumn("quality_score", F.round(S.entity_quality("avg_errors", "avg_warnings", "bypass_rate").cast("decimal(18,4)"), 2))


def financial_health(years: DataFrame, entity: str, year: str = "fiscal_year") -> DataFrame:
    """The latest year's growth, margin, current ratio and leverage, what they indicate, and the whole: Good, Concerning or Mixed."""
    w = W.partitionBy(entity).orderBy(year)
    last = years.withColumns({"__previous": F.lag("revenue_cents").over(w), "__k": F.row_number().over(W.partitionBy(entity).orderBy(F.col(year).desc()))}).where("__k = 1")
    some = lambda a, b: (F.coalesce(F.col(a), F.lit(0)) != 0) & (F.col(b) > 0)
    raw = {
        "revenue_growth": F.when(some("revenue_cents", "__previous"), (F.col("revenue_cents") - F.col("__previous")) / F.col("__previous") * 100),
        "net_margin": F.when(some("net_income_cents", "revenue_cents"), F.col("net_income_cents") / F.col("revenue_cents") * 100),
        "current_ratio": F.when(some("current_assets_cents", "current_liabilities_cents"), F.col("current_assets_cents") / F.col("current_liabilities_cents")),
        "debt_to_equity": F.when(some("liabilities_cents", "equity_cents"), F.col("liabilities_cents") / F.col("equity_cents")),
    }
    df = last.withColumns(raw)
    c = F.col
    good = F.array_compact(F.array(F.when(c("revenue_growth") > 10, "Strong revenue growth"), F.when(c("net_margin") > 10, "Strong profitability"), F.when(c("current_ratio") > 2, "Strong liquidity"), F.when(c("debt_to_equity") < 0.5, "Conservative capital structure")))
    bad = F.array_compact(F.array(F.when(c("revenue_growth") < -10, "Declining revenue"), F.when(c("net_margin") < 0, "Operating at a loss"), F.when(c("current_ratio") < 1, "Potential liquidity concerns")))
    neutral = F.array_compact(F.array(F.when(c("debt_to_equity") > 2, "High leverage")))
    rounded = {m: F.round(c(m).cast("decimal(24,6)"), 2) for m in raw}
    return df.select(entity, year, *[v.alias(k) for k, v in rounded.items()], F.concat(good, bad, neutral).alias("indicators"), F.when(F.size(good) > F.size(bad), "Good").when(F.size(bad) > F.size(good), "Concerning").otherwise("Mixed").alias("overall"))


def flow_metrics(df: DataFrame, keys: list[str], status: str) -> DataFrame:
    """Discovered, created and downloaded, and their shares."""
    n = F.count(F.lit(1))
    created, downloaded = F.count_if(F.col(status).isin("created", "downloaded")), F.count_if(F.col(status) == "downloaded")
    return df.groupBy(*keys).agg(n.alias("discovered"), created.alias("created"), downloaded.alias("downloaded"), percent(created, n).alias("created_rate"), percent(downloaded, created).alias("download_rate"))
