"""Golden literals of the text and scalar functions."""

import pytest
from pyspark.sql import functions as F

from docweave.functions import scalar as S
from docweave.functions import text as T
from docweave.functions import udfs


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def of(spark, f, text, *more):
    return spark.createDataFrame([(text,)], "t string").select(f("t", *more).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("test/file:name*.pdf", "testfilename.pdf"), (" .hidden.file. ", "hidden.file"), ("", "unnamed"), ("a   b", "a b"), (None, None), ("x" * 300, "x" * 200)],
)
def test_sanitize_filename(spark, text, want):
    assert of(spark, T.sanitize_filename, text) == want


@pytest.mark.parametrize(("text", "want"), [("A &amp; B", "A & B"), ("line\nbreaks\r\nand\ttabs", "line breaks and tabs"), ("&amp;lt;", "<"), ("  a&nbsp; b ", "a b"), (None, "")])
def test_clean_text(spark, text, want):
    assert of(spark, T.clean_text, text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("MCDONALDS CORP", "Mcdonalds Corp"), ("Franchise Name, LLC", "Franchise Name"), ("fdd document inc", "FDD Document Inc"), ("", "Unknown Franchise"), (None, "Unknown Franchise"), ("o'neil grill (west)", "O'Neil Grill")],
)
def test_format_franchise_name(spark, text, want):
    assert of(spark, T.format_franchise_name, text) == want


@pytest.mark.parametrize(("text", "want"), [("Registration Number: #67890", "67890"), ("File No. 11111", "11111"), ("Random text 123456 more text", "123456"), ("none", None), (None, None)])
def test_filing_number(spark, text, want):
    assert of(spark, T.extract_filing_number, text) == want


@pytest.mark.parametrize(("text", "want"), [("TX-based company", "TX"), ("Located in WI near the border", "WI"), ("it is in there", "IN"), ("nothing", None), (None, None)])
def test_state_code(spark, text, want):
    assert of(spark, T.extract_state_code, text) == want


@pytest.mark.parametrize(("text", "want"), [("Filed in '23", "2023"), ("From 1999", "1999"), ("2024 and '99", "2024"), ("'45", "1945"), ("x", None)])
def test_year(spark, text, want):
    assert of(spark, T.extract_year, text) == want


@pytest.mark.parametrize(("text", "want"), [("2.5 MB", 2621440), ("1024 KILOBYTES", 1048576), ("512 bytes", 512), ("big", None), (None, None)])
def test_file_size(spark, text, want):
    assert of(spark, T.parse_file_size, text) == want


@pytest.mark.parametrize(
    ("url", "want"),
    [("../file.pdf", "https://example.com/file.pdf"), ("file.pdf?x=1", "https://example.com/path/file.pdf?x=1"), ("/a/./b", "https://example.com/a/b"), ("//cdn.x/y", "https://cdn.x/y"), ("http://a/b", "http://a/b"), ("", ""), (None, "")],
)
def test_normalize_url(spark, url, want):
    assert of(spark, T.normalize_url, url, F.lit("https://example.com/path/")) == want


def test_normalize_url_agrees_with_the_standard_library(spark):
    from urllib.parse import urljoin

    base = "https://h.example/a/b/c?q=1"
    for u in ("x", "../x", "../../x", "./x/../y", "/z", "?p=2", "x/", ".."):
        assert of(spark, T.normalize_url, u, F.lit(base)) == urljoin(base, u), u


def test_address(spark):
    a = of(spark, T.parse_address, "123 Main St, Minneapolis, MN 55401")
    assert (a["street"], a["city"], a["state"], a["zip"]) == ("123 Main St", "Minneapolis", "MN", "55401")
    assert of(spark, T.parse_address, "1 A St, Chicago, IL 60601-1234")["zip"] == "60601-1234"
    assert of(spark, T.parse_address, None)["full"] == ""


def test_address_with_a_house_number_of_five_digits(spark):
    for house, code in (("12345", "12345"), ("10086", "55401"), ("123456", "60601-1234")):
        a = of(spark, T.parse_address, f"{house} Main St, Madison, WI {code}")
        assert (a["street"], a["city"], a["state"], a["zip"]) == (f"{house} Main St", "Madison", "WI", code)
    a = of(spark, T.parse_address, "10086 Main St, Madison, WI")
    assert a["zip"] == "10086"  # the only one there


def test_document_filename(spark):
    f = T.document_filename(F.lit("TestFranchise"), F.lit("2024"), F.lit("12345"), F.lit("Amendment"), F.lit("abc123"))
    assert value(spark, f) == "abc123_2024_TestFranchise_Amendment_#12345.pdf"


@pytest.mark.parametrize(("text", "want"), [("Pizza Palace, Inc.", "pizza palace"), ("A  B LLC", "a b"), ("O'Neil Co", "oneil")])
def test_name_endings(spark, text, want):
    assert of(spark, T.normalize_name_endings, text) == want


def test_name_suffixes_keep_the_word_start_quirk(spark):
    assert of(spark, T.normalize_name_suffixes, "Costco") == "stco"


@pytest.mark.parametrize(("text", "want"), [("SECURITY DEPOSIT", "Point of Sale System"), ("", "Real Estate"), ("Rent", "Real Estate"), ("Training costs", "Training"), ("zzz", "zzz"), (None, None)])
def test_category(spark, text, want):
    assert of(spark, T.standard_category, text) == want


@pytest.mark.parametrize(("text", "want"), [("Unqualified", "unqualified"), ("a qualified opinion", "qualified"), ("unaudited", "not_audited"), ("x", None)])
def test_audit(spark, text, want):
    assert of(spark, T.audit_opinion, text) == want


@pytest.mark.parametrize(("text", "want"), [("Dec 31, 2023", "2023-12-31"), ("Filed in 2023 somewhere", "2023-01-01"), ("13/45/2023", "2023-01-01"), ("not a date", None), ("12/31/69", "1969-12-31"), ("20231231", "2023-12-31"), (None, None)])
def test_dates(spark, text, want):
    got = of(spark, S.parse_date, text)
    assert (str(got) if got else None) == want


@pytest.mark.parametrize(("text", "want"), [("$1,234.56", 123456), ("(500)", -50000), ("2.5 million", 250000000), ("19.99", 1998), ("x", None)])
def test_amounts(spark, text, want):
    assert of(spark, S.parse_amount, text) == want


def test_small_scalars(spark):
    assert [value(spark, S.backoff(F.lit(n))) for n in (0, 3, 10)] == [1.0, 8.0, 60.0]
    assert value(spark, S.average_cents(F.lit(-7), F.lit(0))) == -4
    assert value(spark, S.average_cents(F.lit(None).cast("long"), F.lit(5))) == 5
    assert value(spark, S.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0)))) is None
    assert value(spark, T.phone(F.lit("1-612-555-0100"))) == "+1 (612) 555-0100"


def test_similarity():
    assert udfs.similarity("Burger King LLC", "burger king") == 1.0
    assert udfs.similarity("Burger King West", "Burger King") == 0.95
    assert udfs.similarity("LLC", "Burger King") < 0.95


@pytest.mark.parametrize(("text", "item", "want"), [("Item 7: investment", 7, True), ("ITEM 70", 7, False), ("item 7", 8, False), ("Cover  page", 0, True), ("exhibit B", 24, True), ("Item 24", 24, False), ("Item 30", 30, False), (None, 3, False)])
def test_begins_item(spark, text, item, want):
    assert bool(of(spark, T.begins_item, text, F.lit(item))) == want


@pytest.mark.parametrize("text", ["Élan Café Señor LLC", "O'NEIL'S 2nd-hand x1y", "жизнь ΣΟΦΊΑΣ", "日a b", "ßtraße", "e\u0301a", "", "ALL CAPS"])
def test_titles_of_any_script(spark, text):
    assert of(spark, T.title_case, text) == text.title()


@pytest.mark.parametrize(("text", "want"), [
    ("our initial fees and costs", True), ("INITIAL FEES", True), ("Élan Café", True), ("Élan café", False), ("see item 5 of this", True), ("see item five", False), ("running text about the weather", False), ("123.", True), (" PADDED", False), (" Padded", True),
    ("the territory " * 8, False), ("A" * 151, False), ("A" * 150, True), ("the territory", True), ("O'Neil'S", True), ("O'Neil's", False), ("", True),
])
def test_header_like(spark, text, want):
    assert of(spark, T.is_header_like, text) == want
    reference = len(text) <= 150 and (text.upper().strip() == text or text.istitle() or ("ITEM " in text.upper().strip() and any(map(str.isdigit, text))) or (len(text) < 100 and any(p in text.upper() for p in T.HEADER_PHRASES)))
    assert reference == want
