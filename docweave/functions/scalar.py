"""Dates, numbers, arrays and JSON as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# The date formats tried in turn, as Spark writes them, with the shape each one needs.
DATE_FORMATS = (
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\d{1,2}-\d{1,2}-\d{2}$", "M-d-yy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^[A-Za-z]{3} \d{4}$", "MMM yyyy"),
    (r"^[A-Za-z]+ \d{4}$", "MMMM yyyy"),
)


def _date(c: Column, pattern: str, fmt: str) -> Column:
    d = F.try_to_timestamp(F.when(c.rlike(pattern), c), F.lit(fmt)).cast("date")
    # two-digit years from 69 on are of the last century
    return F.when(F.year(d) > 2068, F.add_months(d, -1200)).otherwise(d) if fmt.endswith("-yy") or fmt.endswith("/yy") else d


def parse_date(c: Column | str) -> Column:
    """The first of twelve formats that fits; else January 1 of the first ``20dd``; else null."""
    x = F.trim(col(c))
    year = F.nullif(F.regexp_extract(x, r"20\d{2}", 0), F.lit("")).cast("int")
    return F.coalesce(*[_date(x, p, f) for p, f in DATE_FORMATS], F.make_date(year, F.lit(1), F.lit(1)))


def parse_iso_or_us_date(c: Column | str, default_year: int | None = None) -> Column:
    """``yyyy-mm-dd`` or ``mm/dd/yyyy``; else January 1 of ``default_year``, if given."""
    x = F.trim(col(c))
    found = [_date(x, *DATE_FORMATS[2]), _date(x, *DATE_FORMATS[0])]
    return F.coalesce(*found, *([F.make_date(F.lit(default_year), F.lit(1), F.lit(1))] if default_year else []))


def dollars(cents: Column | str) -> Column:
    return (col(cents) / 100).cast("decimal(18,2)")


def cents(amount: Column | str) -> Column:
    """Half cents go to the even one, counted in decimals."""
    return F.bround(col(amount).cast("decimal(18,4)") * 100).cast("long")


def parse_amount(c: Column | str) -> Column:
    """``$1,234.56`` and ``(500)`` to cents, cut to whole ones as floats come; ``2.5 million`` too; else null."""
    x = F.regexp_replace(F.lower(F.trim(col(c))), r"[$,\s]", "")
    negative = x.rlike(r"^\(.*\)$") | x.startswith("-")
    number = F.regexp_extract(x, r"^[(\-]*(\d+(?:\.\d+)?)(million|billion|thousand|m|b|k)?\)?$", 1).try_cast("double")
    unit = F.regexp_extract(x, r"^[(\-]*(\d+(?:\.\d+)?)(million|billion|thousand|m|b|k)?\)?$", 2)
    scale = F.when(unit.isin("thousand", "k"), 1e3).when(unit.isin("million", "m"), 1e6).when(unit.isin("billion", "b"), 1e9).otherwise(1.0)
    value = (number * scale * 100).cast("long")
    return F.when(negative, -value).otherwise(value)


def fiscal_year(name: Column | str, headers: Column | str) -> Column:
    """The first ``19dd`` or ``20dd`` of the name, else of the headers in turn."""
    pattern = r"\b((?:19|20)\d{2})\b"
    of = lambda x: F.nullif(F.regexp_extract(x, pattern, 1), F.lit(""))
    return F.coalesce(of(col(name)), F.get(F.filter(F.transform(col(headers), of), lambda y: y.isNotNull()), F.lit(0))).cast("int")


def ratio(a: Column | str, b: Column | str, digits: int = 4) -> Column:
    """a / b rounded; null where either is null or zero."""
    a, b = col(a), col(b)
    return F.when((a != 0) & (b != 0), F.round((a / b).cast("decimal(24,8)"), digits))


def outlet_math(start: Column | str, opened: Column | str, closed: Column | str, transferred_in: Column | str, transferred_out: Column | str) -> Column:
    return col(start) + col(opened) - col(closed) + col(transferred_in) - col(transferred_out)


def average_cents(low: Column | str, high: Column | str) -> Column:
    """Half the sum, rounded down; a missing one counts as the other."""
    lo, hi = F.coalesce(col(low), col(high)), F.coalesce(col(high), col(low))
    return F.floor((lo + hi) / 2).cast("long")


def coverage(values, digits: int = 2) -> Column:
    """Per cent of the columns that are neither null nor empty."""
    said = sum((F.when(col(v).isNotNull() & (col(v).cast("string") != ""), 1).otherwise(0) for v in values), F.lit(0))
    return F.round((said * 100.0 / len(values)).cast("decimal(18,4)"), digits)


def section_quality(errors: Column | str, size: Column | str, blank: Column | str, unreadable: Column | str) -> Column:
    """1 less 0.3 an error, 0.4 under 1 KB or 0.2 under 10 KB, 0.5 if blank, 0.3 if unreadable; within 0 and 1."""
    size = col(size)
    score = F.lit(1.0) - 0.3 * col(errors) - F.when(size < 1024, 0.4).when(size < 10240, 0.2).otherwise(0.0) - F.when(col(blank), 0.5).otherwise(0.0) - F.when(col(unreadable), 0.3).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def entity_quality(errors: Column | str, warnings: Column | str, bypass_rate: Column | str) -> Column:
    """100 less three capped penalties: errors, warnings, bypasses."""
    score = F.lit(100.0) - F.least(col(errors) * 10.0, F.lit(50.0)) - F.least(col(warnings) * 2.0, F.lit(30.0)) - F.least(col(bypass_rate) * 0.5, F.lit(20.0))
    return F.greatest(F.lit(0.0), score)


def quality_label(score: Column | str) -> Column:
    s = col(score)
    return F.when(s >= 90, "excellent").when(s >= 75, "good").when(s >= 50, "fair").otherwise("poor")


def tokens_estimate(c: Column | str) -> Column:
    """A token per four characters, rounded down."""
    return F.floor(F.length(col(c)) / 4).cast("long")


def backoff(attempt: Column | str, base: float = 1.0, most: float = 60.0) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(2.0), col(attempt)), F.lit(most))


def interpolated_pages(total: Column | str, items: int = 25) -> Column:
    """Even shares of the pages: an array of a start page for each item from 0 on."""
    return F.transform(F.sequence(F.lit(0), F.lit(items - 1)), lambda i: (F.floor(i * (col(total) - 1) / items) + 1).cast("int"))


def span_text(blocks: Column | str) -> Column:
    """Text of layout blocks: the trimmed contents of their lines' spans and their nested blocks' lines, joined by spaces."""
    lines = lambda b: F.flatten(F.transform(F.coalesce(b["lines"], F.array()), lambda x: F.transform(x["spans"], lambda s: F.trim(s["content"]))))
    own = F.flatten(F.transform(col(blocks), lines))
    nested = F.flatten(F.transform(col(blocks), lambda b: F.flatten(F.transform(F.coalesce(b["blocks"], F.array()), lines))))
    return F.array_join(F.filter(F.concat(own, nested), lambda t: t.isNotNull() & (t != "")), " ")


def column_values(headers: Column | str, rows: Column | str, name: str) -> Column:
    """A table's column by its header; null where there is none."""
    at = F.array_position(col(headers), name)
    return F.when(at > 0, F.transform(col(rows), lambda r: F.get(r, (at - 1).cast("int"))))


def cell_value(rows: Column | str, label: str, column: int = -1) -> Column:
    """The cell of the first row whose first cell holds the label (any case); -1: the row's last."""
    row = F.get(F.filter(col(rows), lambda r: F.lower(F.get(r, F.lit(0))).contains(label.lower())), F.lit(0))
    return F.get(row, (F.size(row) + column) if column < 0 else F.lit(column))


def fit_rows(headers: Column | str, rows: Column | str) -> Column:
    """Rows cut or padded with nulls to the headers' number."""
    n = F.size(col(headers))
    return F.transform(col(rows), lambda r: F.slice(F.concat(r, F.array_repeat(F.lit(None).cast("string"), n)), F.lit(1), n))


def is_ragged(headers: Column | str, rows: Column | str) -> Column:
    return F.exists(col(rows), lambda r: F.size(r) != F.size(col(headers)))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two arrays of numbers; null where either is all zero."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    dot = total(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")))
    norm = lambda v: F.sqrt(total(F.transform(col(v), lambda x: x.cast("double") * x.cast("double"))))
    return F.try_divide(dot, norm(a) * norm(b))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Shared over all words of two texts, lower-cased and parted by white space."""
    words = lambda x: F.array_distinct(F.filter(F.split(F.lower(col(x)), r"\s+"), lambda w: w != ""))
    return F.try_divide(F.size(F.array_intersect(words(a), words(b))), F.size(F.array_union(words(a), words(b))))
