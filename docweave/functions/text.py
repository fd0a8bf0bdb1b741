"""Text functions as Column builders; all of them stay in generated code but where a docstring says otherwise.

A null text gives null unless a function names a default.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes, word lists and patterns that results depend on.
STATES_51 = "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC".split()
STATES_56 = [*STATES_51, "PR", "VI", "GU", "AS", "MP"]
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&quot;", '"'), ("&nbsp;", " "))
FILING_PATTERNS = (
    r"(?i)Filing Number[:\s]*#?\s*(\d{4,})",
    r"(?i)Registration Number[:\s]*#?\s*(\d{4,})",
    r"(?i)File Number[:\s]*#?\s*(\d{4,})",
    r"(?i)File No[.:\s]*#?\s*(\d{4,})",
    r"(?i)Number[:\s]*#?\s*(\d{4,})",
    r"(?i)#\s*(\d{4,})",
    r"\b(\d{6,})\b",
)
NAME_ENDINGS = (", inc.", ", inc", " inc.", " inc", ", llc", " llc", ", ltd.", ", ltd", " ltd.", " ltd", ", corp.", ", corp", " corp.", " corp", ", co.", ", co", " co.", " co", ", franchise", " franchise", ", franchising", " franchising")
SUFFIX_GROUPS = (
    r"LLC|L\.L\.C\.",
    r"Inc|Inc\.|Incorporated",
    r"Corp|Corp\.|Corporation",
    r"Ltd|Ltd\.|Limited",
    r"Co|Co\.|Company",
    r"LP|L\.P\.|Limited Partnership",
    r"LLP|L\.L\.P\.|Limited Liability Partnership",
    r"PC|P\.C\.|Professional Corporation",
    r"PA|P\.A\.|Professional Association",
    r"PLLC|P\.L\.L\.C\.",
    r"Franchising|Franchise|Franchises",
    r"International|Intl|Int'l",
    r"USA|U\.S\.A\.|US|U\.S\.",
    r"America|American",
    r"Systems|System",
    r"Brands|Brand",
    r"Group|Grp",
    r"Holdings|Holding",
    r"Enterprises|Enterprise",
    r"Services|Service|Svcs",
)
CATEGORIES = {
    "REAL ESTATE": "Real Estate",
    "EQUIPMENT": "Equipment",
    "SIGNAGE": "Signage",
    "INVENTORY": "Inventory",
    "WORKING CAPITAL": "Working Capital",
    "TRAINING": "Training",
    "FRANCHISE FEE": "Initial Franchise Fee",
    "INSURANCE": "Insurance",
    "LICENSES": "Licenses and Permits",
    "PROFESSIONAL FEES": "Professional Fees",
    "MARKETING": "Grand Opening Marketing",
    "CONSTRUCTION": "Construction/Build-out",
    "FIXTURES": "Fixtures and Furniture",
    "POS": "Point of Sale System",
    "TECHNOLOGY": "Technology/Software",
    "DEPOSITS": "Security Deposits",
    "OTHER": "Other Costs",
}
CATEGORY_SYNONYMS = ((("LEASE", "RENT", "PROPERTY"), "REAL ESTATE"), (("COMPUTER", "SOFTWARE", "IT"), "TECHNOLOGY"), (("FURNITURE", "FIXTURE", "FURNISHING"), "FIXTURES"))
SIZE_UNITS = {"B": 1, "BYTE": 1, "BYTES": 1, "KB": 2**10, "KILOBYTE": 2**10, "KILOBYTES": 2**10, "MB": 2**20, "MEGABYTE": 2**20, "MEGABYTES": 2**20, "GB": 2**30, "GIGABYTE": 2**30, "GIGABYTES": 2**30}
STATEMENT_TERMS = (("balance_sheet", ("balance sheet", "assets", "liabilities")), ("income_statement", ("income", "revenue", "profit loss", "p&l")), ("cash_flow", ("cash flow", "cash flows")), ("equity_statement", ("equity", "shareholders", "stockholders")))
AUDIT_TERMS = (("unqualified", ("unqualified", "clean")), ("qualified", ("qualified",)), ("adverse", ("adverse",)), ("disclaimer", ("disclaimer",)), ("not_audited", ("not audited", "unaudited")))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(c: Column | str) -> Column:
    """Runs of white space become one space."""
    return F.regexp_replace(col(c), r"\s+", " ")


def contains_any(c: Column | str, words) -> Column:
    return reduce(lambda a, b: a | b, [col(c).contains(w) for w in words])


def first_match(c: Column | str, patterns, group: int = 1) -> Column:
    """The group of the first pattern that matches, else null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(col(c), p, group), F.lit("")) for p in patterns])


def sanitize_filename(c: Column | str, length: int = 200) -> Column:
    """Without characters that file names can't hold; empty: ``unnamed``."""
    x = F.btrim(squeeze(F.regexp_replace(col(c), r'[\\/*?:"<>|]', "")), F.lit(". "))
    x = F.when(x == "", "unnamed").otherwise(x)
    return F.when(F.length(x) > length, F.regexp_replace(F.substring(x, 1, length), r"\s+$", "")).otherwise(x)


def clean_text(c: Column | str) -> Column:
    """Six entities in a fixed order (so ``&amp;lt;`` ends as ``<``), white space squeezed and trimmed; null: empty."""
    x = F.coalesce(col(c), F.lit(""))
    for entity, plain in ENTITIES:
        x = F.replace(x, F.lit(entity), F.lit(plain))
    return F.regexp_replace(squeeze(x), r"^ | $", "")


def title_case(c: Column | str) -> Column:
    """Each run of letters of either case, of any script, starts with a capital, the rest is small: ``o'neil`` is ``O'Neil``, ``élan`` is ``Élan``, ``ßx`` is ``Ssx``. Letters without case part runs."""
    parts = F.regexp_extract_all(F.lower(col(c)), F.lit(r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"), F.lit(0))

    def first_large(p: Column) -> Column:
        large = F.upper(F.substring(p, 1, 1))
        return F.concat(F.substring(large, 1, 1), F.lower(F.substring(large, 2, 2**30)), F.substring(p, 2, 2**30))

    return F.array_join(F.transform(parts, first_large), "")


def format_franchise_name(c: Column | str) -> Column:
    """A legal suffix and a parenthesis at the end go, then title case with its usual exceptions; nothing: ``Unknown Franchise``."""
    x = clean_text(c)
    y = F.regexp_replace(x, r"(?i)\s*,?\s*(LLC|L\.L\.C\.|Inc\.|INC\.|Corp\.|Corporation)$", "")
    y = title_case(F.regexp_replace(y, r"\s*\([^)]*\)$", ""))
    y = F.regexp_replace(F.regexp_replace(y, r"\bLlc\b", "LLC"), r"\bFdd\b", "FDD")
    return F.when(x == "", "Unknown Franchise").otherwise(y)


def extract_filing_number(c: Column | str) -> Column:
    return first_match(c, FILING_PATTERNS)


def extract_state_code(c: Column | str, states=STATES_51) -> Column:
    """The first upper-case state code that stands alone, else the first in any case."""

    def of(x: Column) -> Column:
        found = F.regexp_extract_all(x, F.lit(r"\b([A-Z]{2})\b"), F.lit(1))
        return F.get(F.filter(found, lambda m: m.isin(*states)), F.lit(0))

    return F.coalesce(of(col(c)), of(F.upper(col(c))))


def extract_year(c: Column | str) -> Column:
    """``20dd``; else ``'dd`` or ``19dd``, of which up to 30 are of this century."""
    full = F.nullif(F.regexp_extract(col(c), r"20\d{2}", 0), F.lit(""))
    two = F.nullif(F.regexp_replace(F.regexp_extract(col(c), r"'(\d{2})|19(\d{2})", 0), r"^(19|')", ""), F.lit(""))
    return F.coalesce(full, F.concat(F.when(two.cast("int") <= 30, "20").otherwise("19"), two))


def parse_address(c: Column | str) -> Column:
    """Struct of full, street, city, state, zip; parts that aren't there are empty. The zip is the last number of five digits, as a house may have such a number too, and goes from its own place alone."""
    text = F.coalesce(col(c), F.lit(""))
    zip_ = F.regexp_extract(text, r"(?s)^.*\b(\d{5}(?:-\d{4})?)\b", 1)
    rest = F.regexp_replace(text, r"(?s)^(.*)\b\d{5}(?:-\d{4})?\b", "$1")
    state = F.coalesce(extract_state_code(rest), F.lit(""))
    bare = F.when(state != "", F.regexp_replace(rest, F.concat(F.lit(r"(?i)\b"), state, F.lit(r"\b")), F.lit(""))).otherwise(rest)
    parts = F.transform(F.split(bare, ","), lambda p: F.trim(p))
    return F.struct(clean_text(c).alias("full"), F.get(parts, F.lit(0)).alias("street"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("city"), state.alias("state"), zip_.alias("zip"))


def document_filename(name: Column | str, year: Column | str, number: Column | str, kind: Column | str, uuid: Column | str, extension: str = ".pdf") -> Column:
    """``uuid_year_name_kind_#number.pdf`` of the parts that are there; the kind ``FDD`` isn't said."""
    some = lambda x: F.nullif(col(x).cast("string"), F.lit(""))
    base = F.concat_ws("_", some(uuid), some(year), sanitize_filename(name), F.nullif(some(kind), F.lit("FDD")), F.concat(F.lit("#"), some(number)))
    return F.when(base.endswith(extension), base).otherwise(F.concat(base, F.lit(extension)))


def normalize_url(c: Column | str, base: Column | str) -> Column:
    """Absolute URLs stay; ``//host`` gets the base's scheme; others are resolved against it (``.`` and ``..`` folded); null or empty: empty."""
    url, base = F.coalesce(col(c), F.lit("")), col(base)
    scheme = F.regexp_extract(base, r"^([A-Za-z][\w+.-]*):", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][\w+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^[A-Za-z][\w+.-]*://[^/?#]*(/(?:[^?#]*/)?)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    path, tail = F.regexp_extract(url, r"^([^?#]*)", 1), F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    joined = F.when(path.startswith("/"), path).when(path == "", F.regexp_extract(base, r"^[A-Za-z][\w+.-]*://[^/?#]*([^?#]*)", 1)).otherwise(F.concat(folder, path))
    parts = F.split(F.regexp_replace(joined, "^/", ""), "/")
    # a fold over the path's parts: .. takes the last one away
    kept = F.aggregate(parts, F.expr("cast(array() as array<string>)"), lambda acc, p: F.when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(p == ".", acc).otherwise(F.concat(acc, F.array(p))))
    ends = F.when(joined.rlike(r"/\.{1,2}$"), "/").otherwise("")
    resolved = F.concat(root, F.lit("/"), F.array_join(kept, "/"), ends, tail)
    return F.when(url == "", "").when(url.rlike("^https?://"), url).when(url.startswith("//"), F.concat(scheme, F.lit(":"), url)).otherwise(resolved)


def parse_file_size(c: Column | str) -> Column:
    """``2.5 MB`` to bytes, by powers of 1024, cut to a whole number; else null."""
    pattern = r"(\d+(?:\.\d+)?)\s*(KILOBYTES?|MEGABYTES?|GIGABYTES?|BYTES?|KB|MB|GB|B)"
    x = F.upper(F.trim(col(c)))
    unit = F.create_map(*[F.lit(v) for kv in SIZE_UNITS.items() for v in kv])
    return (F.regexp_extract(x, pattern, 1).try_cast("double") * F.try_element_at(unit, F.regexp_extract(x, pattern, 2))).cast("long")


def normalize_name_endings(c: Column | str) -> Column:
    """Lower case, the first of the endings that fits cut off, white space squeezed, signs but hyphens dropped."""
    x = F.lower(col(c))
    cut = None
    for e in NAME_ENDINGS:
        value = F.substring(x, F.lit(1), F.length(x) - len(e))
        cut = F.when(x.endswith(e), value) if cut is None else cut.when(x.endswith(e), value)
    return F.regexp_replace(F.trim(squeeze(cut.otherwise(x))), r"[^\w\s-]", "")


def normalize_name_suffixes(c: Column | str) -> Column:
    """Suffix words go wherever one begins (so ``Costco`` loses ``Co``), signs become spaces, lower case."""
    pattern = "(?i)" + "|".join(rf"\b({g})" for g in SUFFIX_GROUPS)
    x = F.regexp_replace(F.regexp_replace(col(c), pattern, ""), r"[^\w\s-]", " ")
    return F.lower(F.trim(F.regexp_replace(x, r"[-\s]+", " ")))


def phone(c: Column | str) -> Column:
    """``(ddd) ddd-dddd`` of ten digits, ``+1 (ddd) ddd-dddd`` of eleven that start with 1, else null."""
    d = F.regexp_replace(col(c), r"\D", "")
    shown = lambda x: F.concat(F.lit("("), F.substring(x, 1, 3), F.lit(") "), F.substring(x, 4, 3), F.lit("-"), F.substring(x, 7, 4))
    return F.when(F.length(d) == 10, shown(d)).when((F.length(d) == 11) & d.startswith("1"), F.concat(F.lit("+1 "), shown(F.substring(d, 2, 10))))


def website(c: Column | str) -> Column:
    """With a scheme: ``https://`` before what has none."""
    return F.when(col(c).rlike("^https?://"), col(c)).otherwise(F.concat(F.lit("https://"), col(c)))


def is_email(c: Column | str) -> Column:
    return col(c).rlike(r"^[\w.+-]+@[\w-]+\.[\w.-]+$")


def truncate(c: Column | str, length: int = 10_000, suffix: str = "... [truncated]") -> Column:
    """A longer text ends in the suffix and is ``length`` characters in all."""
    return F.when(F.length(col(c)) > length, F.concat(F.substring(col(c), 1, length - len(suffix)), F.lit(suffix))).otherwise(col(c))


def item_number(c: Column | str) -> Column:
    """The number of a section heading: ``ITEM n``, ``n. text`` or ``n text``; null beyond 0 to 24."""
    n = first_match(c, (r"(?i)^\s*ITEM\s+(\d{1,2})\b", r"^\s*(\d{1,2})\s*\.\s*\S", r"(?i)\bITEM\s*#?\s*(\d{1,2})\b")).try_cast("int")
    return F.when(n.between(0, 24), n)


# How a document's front matter (item 0) and its appendices (item 24) begin.
FRONT_WORDS = (r"FRANCHISE\s+DISCLOSURE\s+DOCUMENT", "FDD", r"TABLE\s+OF\s+CONTENTS", "INTRODUCTION", r"COVER\s+PAGE")
APPENDIX_WORDS = ("APPENDIX", "EXHIBIT", "ATTACHMENT")


def begins_item(c: Column | str, item: Column | str) -> Column:
    """Whether a text begins as its item does: front matter for 0, ``Item n`` for 1 to 23, an appendix for 24."""
    x, n = F.trim(col(c)), col(item)
    starts = lambda words: x.rlike("(?i)^(" + "|".join(words) + ")")
    said = F.regexp_extract(x, r"(?i)^item\s+(\d{1,3})\b", 1).try_cast("int")
    return F.when(n == 0, starts(FRONT_WORDS)).when(n == 24, starts(APPENDIX_WORDS)).when(n.between(1, 23), F.coalesce(said == n, F.lit(False))).otherwise(F.lit(False))


#: Phrases that short headers hold (fixed values).
HEADER_PHRASES = (
    "INITIAL FEES", "OTHER FEES", "ESTIMATED INITIAL INVESTMENT", "BUSINESS EXPERIENCE", "LITIGATION", "BANKRUPTCY", "FINANCING", "TERRITORY", "TRADEMARKS", "PATENTS", "CONTRACTS", "RECEIPTS", "FRANCHISEE'S OBLIGATIONS",
    "FINANCIAL PERFORMANCE", "FINANCIAL STATEMENTS", "RESTRICTIONS ON", "FRANCHISOR'S ASSISTANCE", "PUBLIC FIGURES", "OUTLETS AND FRANCHISE",
)


def is_header_like(c: Column | str, phrases=HEADER_PHRASES) -> Column:
    """At most 150 characters, and all capitals, titled words, ``ITEM`` and a digit, or one of the phrases within less than 100 characters.

    Texts without letters equal their capitals, so they count, unless white space stands at an end. Titled: every run of letters that have case, of any
    script, begins with a capital and goes on small, and there is one.
    """
    x = col(c)
    large = F.upper(F.trim(x))
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    titled = x.rlike(rf"^[^{cased}]*[\p{{Lu}}\p{{Lt}}]\p{{Ll}}*(?:[^{cased}]+[\p{{Lu}}\p{{Lt}}]\p{{Ll}}*)*[^{cased}]*$")
    numbered = large.contains("ITEM ") & x.rlike(r"\d")
    by_phrase = (contains_any(large, phrases) & (F.length(x) < 100)) if phrases else F.lit(False)
    return (F.length(x) <= 150) & ((large == x) | titled | numbered | by_phrase)


def has_keywords(c: Column | str, words, veto=()) -> Column:
    """Whether any keyword stands in the lower-cased text and no veto does."""
    x = F.lower(col(c))
    return contains_any(x, words) & ~contains_any(x, veto) if veto else contains_any(x, words)


def standard_category(c: Column | str) -> Column:
    """Exact names, then the first that holds or is held by the text, then synonyms, else the text itself."""
    x = F.upper(col(c))
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for k, v in CATEGORIES.items():
        out = out.when(x == k, v)
    for k, v in CATEGORIES.items():
        out = out.when(x.contains(k) | F.lit(k).contains(x), v)
    for words, k in CATEGORY_SYNONYMS:
        out = out.when(contains_any(x, words), CATEGORIES[k])
    return out.otherwise(col(c))


def table_type(headers: Column | str, name: Column | str) -> Column:
    h, n = F.lower(col(headers)), F.lower(col(name))
    return F.when(h.contains("state") | n.contains("state"), "by_state").when(h.contains("year") | h.contains("fiscal"), "summary").when(n.contains("projection") | n.contains("forecast"), "projections").otherwise("other")


def _ladder(c: Column, terms) -> Column:
    out = None
    for value, words in terms:
        test = contains_any(c, words)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def statement_type(headers: Column | str, name: Column | str) -> Column:
    return _ladder(F.lower(F.concat_ws("\n", col(name), col(headers))), STATEMENT_TERMS).otherwise("notes")


def audit_opinion(c: Column | str) -> Column:
    """``unqualified`` is asked before ``qualified``; null where nothing fits."""
    return _ladder(F.lower(col(c)), AUDIT_TERMS)


def cache_name(c: Column | str) -> Column:
    """Letters, digits and ``._- `` alone, at most 100."""
    return F.substring(F.regexp_replace(col(c), r"[^A-Za-z0-9._\- ]", ""), 1, 100)
