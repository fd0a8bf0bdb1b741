"""Validation rules as columns: one pass evaluates all rules of an entity, findings come out as rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"


@dataclass(frozen=True)
class Rule:
    """``fails``: true where the rule finds something; null finds nothing."""

    name: str
    field: str
    fails: Column
    message: str
    severity: str = ERROR
    category: str = "BUSINESS_RULE"
    actual: Column | None = None
    expected: str | None = None

    def finding(self) -> Column:
        actual = self.actual if self.actual is not None else F.col(self.field)
        parts = F.struct(
            F.lit(self.name).alias("rule"),
            F.lit(self.field).alias("field"),
            F.lit(self.message).alias("message"),
            F.lit(self.severity).alias("severity"),
            F.lit(self.category).alias("category"),
            actual.cast("string").alias("actual"),
            F.lit(self.expected).cast("string").alias("expected"),
        )
        return F.when(self.fails, parts)


class Registry:
    """Rules by entity; callers add their own."""

    def __init__(self) -> None:
        self.rules: dict[str, list[Rule]] = {}

    def register(self, entity: str, *rules: Rule) -> None:
        self.rules.setdefault(entity, []).extend(rules)

    def of(self, entity: str) -> list[Rule]:
        return self.rules.get(entity, [])


def findings(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """A row per rule that fails: the key and the finding. One projection, no shuffle."""
    # exploded first and filtered then: within generated code, which functions over arrays would leave
    return df.select(F.col(key), F.explode(F.array(*[r.finding() for r in rules])).alias("__f")).where(F.col("__f").isNotNull()).select(key, "__f.*")


def validated(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """A row per entity: its counts by severity and status (any error: invalid; any warning: needs_review; else validated)."""
    n = lambda s: sum((F.when(r.fails, 1).otherwise(0) for r in rules if r.severity == s), F.lit(0))
    counted = df.select(F.col(key), n(ERROR).alias("errors"), n(WARNING).alias("warnings"), n(INFO).alias("infos"))
    return counted.withColumn("status", F.when(F.col("errors") > 0, "invalid").when(F.col("warnings") > 0, "needs_review").otherwise("validated"))


def validated_json(df: DataFrame, key: str, column: str, schema: str, rules: Sequence[Rule]) -> DataFrame:
    """``validated`` of JSON texts read by a schema (no field named ``__broken``): a text that can't be read is an error of its own, and stops none of the others."""
    read = F.from_json(column, f"{schema}, __broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__broken"})
    rows = df.select(F.col(key), read.alias("__r")).select(key, "__r.*")
    broken = Rule("malformed", column, F.col("__broken").isNotNull(), f"{column} can't be read", ERROR, "SCHEMA")
    return validated(rows, key, [broken, *rules])


def without_bypassed(found: DataFrame, bypasses: DataFrame, key: str, as_of: Column) -> DataFrame:
    """Findings but those of a rule that an unexpired bypass covers for the entity."""
    live = bypasses.where(F.col("expires_at").isNull() | (F.col("expires_at") > as_of)).select(key, "rule").distinct()
    return found.join(live, [key, "rule"], "left_anti")


def bounds(field: str, low: float | None = None, high: float | None = None, severity: str = ERROR, of: Column | None = None) -> list[Rule]:
    out, value = [], F.col(field) if of is None else of
    if low is not None:
        out.append(Rule(f"{field}_min", field, value < low, f"{field} is below {low}", severity, "SCHEMA", expected=f">= {low}"))
    if high is not None:
        out.append(Rule(f"{field}_max", field, value > high, f"{field} is above {high}", severity, "SCHEMA", expected=f"<= {high}"))
    return out


def required(field: str) -> Rule:
    return Rule(f"{field}_required", field, F.col(field).isNull() | (F.trim(F.col(field).cast("string")) == ""), f"{field} is missing", ERROR, "SCHEMA")


def one_of(field: str, values: Sequence[str]) -> Rule:
    return Rule(f"{field}_enum", field, ~F.col(field).isin(*values), f"{field} is none of its values", ERROR, "SCHEMA", expected=", ".join(values))


def pattern(field: str, regex: str) -> Rule:
    return Rule(f"{field}_pattern", field, ~F.col(field).rlike(regex), f"{field} has another form", ERROR, "SCHEMA", expected=regex)


#: Spark's types for what rule files call types; texts are of any.
KINDS = {"number": "double", "integer": "bigint", "boolean": "boolean", "date": "date"}


def of_type(field: str, kind: str) -> Rule:
    """Whether a text reads as a value of a type; ``string`` finds nothing. Whole numbers alone are integers."""
    if kind == "string":
        return Rule(f"{field}_type", field, F.lit(False), f"{field} is no string", ERROR, "SCHEMA", expected=kind)
    text = F.trim(F.col(field).cast("string"))
    read = text.try_cast(KINDS[kind]).isNotNull()
    if kind == "integer":
        read = read & text.rlike(r"^[+-]?\d+$")
    return Rule(f"{field}_type", field, text.isNotNull() & ~read, f"{field} is no {kind}", ERROR, "SCHEMA", expected=kind)


def either(one: str, two: str, name: str, both: str | None = None, none: str | None = None) -> list[Rule]:
    """Just one of two fields is set."""
    a, b = F.col(one), F.col(two)
    return [
        Rule(f"{name}_both", one, a.isNotNull() & b.isNotNull(), both or f"{one} and {two} are both set", ERROR, "CROSS_FIELD"),
        Rule(f"{name}_none", one, a.isNull() & b.isNull(), none or f"neither {one} nor {two} is set", ERROR, "CROSS_FIELD"),
    ]


def ordered_range(low: str, high: str, name: str) -> list[Rule]:
    """At least one end is set, and the high one isn't below the low one."""
    return [
        Rule(f"{name}_unset", low, F.col(low).isNull() & F.col(high).isNull(), f"neither {low} nor {high} is set", ERROR, "CROSS_FIELD"),
        Rule(f"{name}_reversed", high, F.col(high) < F.col(low), f"{high} below {low}", ERROR, "CROSS_FIELD"),
    ]


def within_total(part: str, total: str) -> Rule:
    """A component is no larger than what it is part of."""
    return Rule(f"{part}_over_{total}", part, F.col(part) > F.col(total), f"{part} over {total}", ERROR, "CROSS_FIELD")


def discount_rules() -> list[Rule]:
    """Discounts: an amount or a percentage, of 0 to 100."""
    return [*either("amount_cents", "percentage", "discount"), *bounds("amount_cents", 0), *bounds("percentage", 0, 100)]


def component_rules() -> list[Rule]:
    """Parts of financial statements and of outlets, where those columns are."""
    return [within_total("franchise_revenue_cents", "revenue_cents"), within_total("multi_unit_operators", "total_franchisees")]


def from_rule_list(rules: Sequence[dict]) -> list[Rule]:
    """Rules as prompt files list them: each with its ``field`` and any of type, required, min, max, enum, pattern; what else they say, such as a default, is no rule."""
    out: dict[str, dict] = {}
    for r in rules:
        out.setdefault(r["field"], {}).update({k: v for k, v in r.items() if k != "field"})
    return from_spec(out)


def from_spec(spec: dict[str, dict]) -> list[Rule]:
    """Rules from data: by field any of type, required, min, max, enum, pattern. Bounds of a field that has a numeric type are on its number."""
    out: list[Rule] = []
    for field, s in spec.items():
        if s.get("required"):
            out.append(required(field))
        if "type" in s:
            out.append(of_type(field, s["type"]))
        number = F.col(field).try_cast("double") if s.get("type") in ("number", "integer") else None
        out += bounds(field, s.get("min"), s.get("max"), of=number)
        if "enum" in s:
            out.append(one_of(field, s["enum"]))
        if "pattern" in s:
            out.append(pattern(field, s["pattern"]))
    return out


# Limits of the rules below (fixed values), amounts in cents.
MAX_FEE, BIG_FEE, MAX_INVESTMENT = 10_000_000_00, 1_000_000_00, 100_000_000_00
ROYALTY_LIMIT, MARKETING_LIMIT = 50.0, 20.0
AUDIT_REVENUE, LOW_EQUITY, BALANCE_TOLERANCE = 50_000_000_00, -10_000_000_00, 100
MIN_SAMPLE, MAX_HISTORY_YEARS = 5, 10


def initial_fee_rules() -> list[Rule]:
    return [
        Rule("refund_conditions", "refund_conditions", F.col("refundable") & F.coalesce(F.col("refund_conditions"), F.lit("")).eqNullSafe(""), "refundable without conditions", WARNING),
        Rule("fee_too_high", "amount_cents", F.col("amount_cents") > MAX_FEE, "fee over $10M", WARNING, expected=f"<= {MAX_FEE}"),
        Rule("fee_high", "amount_cents", (F.col("amount_cents") > BIG_FEE) & (F.col("amount_cents") <= MAX_FEE), "fee over $1M", INFO),
    ]


def other_fee_rules() -> list[Rule]:
    both, none = F.col("amount_cents").isNotNull() & F.col("amount_percentage").isNotNull(), F.col("amount_cents").isNull() & F.col("amount_percentage").isNull()
    return [
        Rule("amount_or_percentage", "amount_cents", both | none, "just one of amount and percentage is wanted", ERROR, "CROSS_FIELD"),
        Rule("max_below_min", "max_cents", F.col("max_cents") < F.col("min_cents"), "maximum below minimum", ERROR, "CROSS_FIELD"),
        Rule("percentage_basis", "calculation_basis", F.col("amount_percentage").isNotNull() & F.col("calculation_basis").isNull(), "percentage without a basis", ERROR),
        Rule("royalty_high", "amount_percentage", F.lower("fee_name").contains("royalty") & (F.col("amount_percentage") > ROYALTY_LIMIT), "royalty over 50 %", WARNING),
    ]


def investment_rules() -> list[Rule]:
    return [
        Rule("high_below_low", "high_cents", F.col("high_cents") < F.col("low_cents"), "high below low", ERROR, "CROSS_FIELD"),
        Rule("wide_range", "high_cents", F.try_divide(F.col("high_cents"), F.nullif("low_cents", F.lit(0))) > 10, "high over ten times low", INFO),
        Rule("investment_too_high", "high_cents", F.col("high_cents") > MAX_INVESTMENT, "investment over $100M", WARNING),
    ]


def performance_rules() -> list[Rule]:
    low, avg, med, high = (F.col(c) for c in ("low_cents", "average_cents", "median_cents", "high_cents"))
    return [
        Rule("small_sample", "sample_size", F.col("sample_size") < MIN_SAMPLE, "sample below 5", WARNING),
        Rule("average_outside", "average_cents", (avg < low) | (avg > high), "average outside the range", ERROR, "CROSS_FIELD"),
        Rule("median_outside", "median_cents", (med < low) | (med > high), "median outside the range", ERROR, "CROSS_FIELD"),
        Rule("skewed", "median_cents", F.abs(avg - med) > (high - low) / 2, "average and median far apart", INFO),
        Rule("long_period", "period_years", F.col("period_years") > MAX_HISTORY_YEARS, "more than ten years", WARNING),
    ]


def outlet_rules() -> list[Rule]:
    from ..functions.scalar import outlet_math

    expected = outlet_math("count_start", "opened", "closed", "transferred_in", "transferred_out")
    return [Rule("outlet_math", "count_end", expected != F.col("count_end"), "outlets don't add up", ERROR, "CROSS_FIELD")]


def financial_rules() -> list[Rule]:
    off = F.abs(F.col("assets_cents") - F.col("liabilities_cents") - F.col("equity_cents"))
    return [
        Rule("balance", "assets_cents", off > BALANCE_TOLERANCE, "assets aren't liabilities and equity", ERROR, "CROSS_FIELD", off),
        Rule("low_equity", "equity_cents", F.col("equity_cents") < LOW_EQUITY, "equity below -$10M", WARNING),
        Rule("gross_profit", "gross_profit_cents", F.abs(F.col("revenue_cents") - F.col("cost_cents") - F.col("gross_profit_cents")) > BALANCE_TOLERANCE, "gross profit isn't revenue less cost", WARNING, "CROSS_FIELD"),
        Rule("audit_missing", "audit_opinion", (F.col("revenue_cents") > AUDIT_REVENUE) & F.col("audit_opinion").isNull(), "no audit over $50M", WARNING, "DOC_RULE"),
    ]


RULES = Registry()


def standard_rules() -> Registry:
    """The rules of each kind of item; they need an active session, as columns do."""
    if not RULES.rules:
        makers: dict[str, Callable[[], list[Rule]]] = {"item5": initial_fee_rules, "item6": other_fee_rules, "item7": investment_rules, "item19": performance_rules, "item20": outlet_rules, "item21": financial_rules}
        for entity, make in makers.items():
            RULES.register(entity, *make())
    return RULES


# --- reports over runs, alerts -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Alert:
    name: str
    metric: str
    threshold: float
    comparison: str  # gt, lt or eq
    message: str


def alerts(metrics: DataFrame, key: str, rules: Sequence[Alert]) -> DataFrame:
    """Metric columns against thresholds: key, alert, metric, value, threshold. A null metric alerts nothing."""
    tests = []
    for a in rules:
        c = F.col(a.metric).cast("double")
        hit = {"gt": c > a.threshold, "lt": c < a.threshold, "eq": c == a.threshold}[a.comparison]
        tests.append(F.when(hit, F.struct(F.lit(a.name).alias("alert"), F.lit(a.metric).alias("metric"), c.alias("value"), F.lit(float(a.threshold)).alias("threshold"), F.lit(a.message).alias("message"))))
    return metrics.select(F.col(key), F.explode(F.array_compact(F.array(*tests))).alias("__a")).select(key, "__a.*")


def health(score: Column, high: Column) -> Column:
    return F.when(score < 70, "DEGRADED").when(high > 5, "WARNING").otherwise("HEALTHY")


# --- rules over extraction results -----------------------------------------------------------------------------------


def extraction_rules(item: str) -> list[Rule]:
    """What an extraction of an item should look like before it is stored; issues are warnings but where a value contradicts another."""
    c = F.col
    doubt = Rule("low_confidence", "extraction_confidence", c("extraction_confidence") < 0.7, "extraction confidence below 0.7", WARNING, "EXTRACTION")
    by_item: dict[str, Callable[[], list[Rule]]] = {
        "item5": lambda: [
            Rule("zero_fee", "initial_franchise_fee_cents", (c("initial_franchise_fee_cents") == 0) & F.coalesce(c("notes"), F.lit("")).eqNullSafe(""), "zero fee without a note", WARNING, "EXTRACTION"),
            Rule("discount_over_half", "discounts", F.exists("discounts", lambda d: d["percentage"] > 50), "discount over 50 %", WARNING, "EXTRACTION"),
            Rule("additional_over_primary", "additional_fees", F.exists("additional_fees", lambda f: f["amount_cents"] > c("initial_franchise_fee_cents")), "additional fee over the primary one", WARNING, "EXTRACTION"),
        ],
        "item6": lambda: [
            Rule("royalty_missing", "royalty_percentage", c("royalty_percentage").isNull() & ~F.coalesce(F.exists("other_fees", lambda f: F.lower(f["fee_name"]).contains("royalty")), F.lit(False)), "no royalty", WARNING, "EXTRACTION"),
            Rule("royalty_over_limit", "royalty_percentage", c("royalty_percentage") > ROYALTY_LIMIT, "royalty over 50 %", WARNING, "EXTRACTION"),
            Rule("marketing_over_limit", "marketing_fee_percentage", c("marketing_fee_percentage") > MARKETING_LIMIT, "marketing over 20 %", WARNING, "EXTRACTION"),
            Rule("fee_over_20", "other_fees", F.exists("other_fees", lambda f: f["amount_percentage"] > 20), "fee over 20 %", WARNING, "EXTRACTION"),
        ],
        "item7": lambda: [
            Rule(f"missing_{'_'.join(name.lower().split())}", "categories", ~F.array_contains("categories", name), f"no {name}", WARNING, "EXTRACTION", F.array_join("categories", ", ")) for name in ("Initial Franchise Fee", "Working Capital")
        ]
        + [Rule("total_reversed", "total_high_cents", c("total_high_cents") < c("total_low_cents"), "total high below low", ERROR, "EXTRACTION")],
        "item19": lambda: [
            Rule("low_coverage", "units_included", F.try_divide(c("units_included") * 100.0, F.nullif("total_units", F.lit(0))) < 50, "under half of the units", WARNING, "EXTRACTION"),
            Rule("no_disclaimers", "disclaimers", c("has_fpr") & F.coalesce(c("disclaimers"), F.lit("")).eqNullSafe(""), "no disclaimers", WARNING, "EXTRACTION"),
            Rule("quartile_order", "median_cents", (c("bottom_quartile_cents") > c("median_cents")) | (c("median_cents") > c("top_quartile_cents")), "quartiles out of order", ERROR, "EXTRACTION"),
            Rule("figures_without_fpr", "has_fpr", ~c("has_fpr") & c("median_cents").isNotNull(), "figures though there is no representation", WARNING, "EXTRACTION"),
            Rule("fpr_without_figures", "has_fpr", c("has_fpr") & c("median_cents").isNull() & c("average_cents").isNull(), "representation without figures", WARNING, "EXTRACTION"),
        ],
        "item21": lambda: [
            Rule("going_concern", "going_concern", F.coalesce(c("going_concern"), F.lit(False)), "going concern", WARNING, "EXTRACTION"),
            Rule("no_figures", "revenue_cents", F.coalesce(c("revenue_cents"), c("assets_cents")).isNull(), "neither revenue nor assets", WARNING, "EXTRACTION"),
        ],
    }
    return [doubt, *by_item[item]()]


def fpr_consistency_rules() -> list[Rule]:
    """Whether performance figures and tables are there just where a representation is made; zero figures count as none."""
    c = F.col
    revenue = [F.coalesce(c(f), F.lit(0)) != 0 for f in ("average_gross_revenue_cents", "median_gross_revenue_cents")]
    profit = [F.coalesce(c(f), F.lit(0)) != 0 for f in ("average_net_profit_cents", "median_net_profit_cents")]
    made, tables = F.coalesce(c("has_fpr"), F.lit(False)), F.coalesce(F.size("performance_tables"), F.lit(0)) > 0
    return [
        Rule("tables_without_fpr", "performance_tables", ~made & tables, "performance tables though there is no representation", WARNING, "CROSS_FIELD"),
        Rule("metrics_without_fpr", "has_fpr", ~made & (revenue[0] | revenue[1] | profit[0] | profit[1]), "figures though there is no representation", WARNING, "CROSS_FIELD"),
        Rule("fpr_without_data", "has_fpr", made & ~tables & ~(revenue[0] | revenue[1]), "representation without tables or figures", WARNING, "CROSS_FIELD"),
    ]


def documented_rules() -> list[Rule]:
    """Rules that only the reference's documentation has; their category says so."""
    c = F.col
    margin = F.try_divide(c("net_income_cents") * 100.0, F.nullif("revenue_cents", F.lit(0)))
    return [
        Rule("royalty_over_15", "royalty_percentage", c("royalty_percentage") > 15, "royalty over 15 %", WARNING, "DOC_RULE"),
        Rule("stale", "document_age_years", c("document_age_years") > 3, "document over three years old", ERROR, "DOC_RULE"),
        Rule("ageing", "document_age_years", (c("document_age_years") > 2) & (c("document_age_years") <= 3), "document over two years old", WARNING, "DOC_RULE"),
        Rule("current_over_total", "current_assets_cents", c("current_assets_cents") > c("assets_cents"), "current assets over all assets", ERROR, "DOC_RULE"),
        Rule("repeated_states", "state_codes", F.size("state_codes") != F.size(F.array_distinct("state_codes")), "a state stands twice", ERROR, "DOC_RULE"),
        Rule("fiscal_gap", "fiscal_years", (F.size("fiscal_years") > 0) & (F.array_max("fiscal_years") - F.array_min("fiscal_years") + 1 > F.size(F.array_distinct("fiscal_years"))), "fiscal years leave a gap", WARNING, "DOC_RULE"),
        Rule("no_auditor", "auditor_name", (c("revenue_cents") > AUDIT_REVENUE) & (F.coalesce(F.trim("auditor_name"), F.lit("")) == ""), "no auditor for revenue over $50M", WARNING, "DOC_RULE"),
        Rule("margin_outside", "net_income_cents", F.abs(margin) > 50, "margin beyond 50 %", WARNING, "DOC_RULE", margin),
    ]


def document_rules() -> list[Rule]:
    """Bounds, dates and page ranges of documents and sections."""
    c = F.col
    return [
        Rule("amendment_before_issue", "amendment_date", c("amendment_date") < c("issue_date"), "amended before it was issued", ERROR, "CROSS_FIELD"),
        Rule("page_range", "end_page", c("end_page") < c("start_page"), "ends before it starts", ERROR, "CROSS_FIELD"),
        *bounds("item_no", 0, 24),
    ]
