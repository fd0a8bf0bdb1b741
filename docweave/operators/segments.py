"""Sections of documents: candidates from page text, their sequential assignment, repair and fallback.

A document's candidates are few and bounded by its pages, so they meet in one row: the assignment carries a least page from item
to item, which no window function expresses but a fold over the items does. The repair is a pandas function of a document's sections.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fuzzy import best_of
from ..functions.text import is_header_like, item_number
from ..session import runs_on_executors
from .entity import written
from .text_match import heading_similarity

runs_on_executors(__name__)

ITEMS = 25
#: Phases of the assignment, in order (fixed values), and the confidence a method starts from.
METHODS = {"title": 0.95, "fuzzy": None, "pattern": 0.8, "cosine": None}
#: Least pages of some late items (fixed values).
LEAST_PAGES = {20: 3, 21: 2, 7: 2, 11: 3, 17: 3, 19: 2}


#: Headings of items 0 to 24, and other phrasings of some (fixed values).
HEADINGS = [
    "Cover/Introduction/Table of Contents",
    "The Franchisor, and any Parents, Predecessors, and Affiliates",
    "Business Experience",
    "Litigation",
    "Bankruptcy",
    "Initial Fees",
    "Other Fees",
    "Estimated Initial Investment",
    "Restrictions on Sources of Products and Services",
    "Franchisee's Obligations",
    "Financing",
    "Franchisor's Assistance, Advertising, Computer Systems, and Training",
    "Territory",
    "Trademarks",
    "Patents, Copyrights, and Proprietary Information",
    "Obligation to Participate in the Actual Operation of the Franchise Business",
    "Restrictions on What the Franchisee May Sell",
    "Renewal, Termination, Transfer, and Dispute Resolution",
    "Public Figures",
    "Financial Performance Representations",
    "Outlets and Franchisee Information",
    "Financial Statements",
    "Contracts",
    "Receipts",
    "Appendix/Exhibits",
]
OTHER_HEADINGS = {
    1: ["The Franchisor", "Franchisor and Parents", "The Franchisor and Any Parents"],
    5: ["Initial Fees", "Initial Fee", "Franchise Fee"],
    6: ["Other Fees", "Ongoing Fees", "Additional Fees"],
    7: ["Estimated Initial Investment", "Initial Investment", "Total Investment"],
    11: ["Franchisor's Assistance", "Training", "Support"],
    17: ["Renewal, Termination", "Contract Terms"],
    19: ["Financial Performance", "Earnings Claims", "Financial Performance Representations"],
    20: ["Outlets and Franchisee Information", "Outlet Information", "System Information"],
    21: ["Financial Statements", "Financials"],
}
#: Phrases of running text that no heading has (fixed values).
BOILERPLATE = ["the franchisor is", "this disclosure document", "if we offer you", "if we do not deliver", "receipt (your copy)", "receipt (copy - submit", "list of administrators", "agents for service"]
#: Headings at most, as every text of a heading's length is compared with each.
MOST_HEADINGS = 1000


def standard_headings(spark: SparkSession) -> DataFrame:
    """item_no, heading: the standard ones and their other phrasings."""
    rows = [(i, h) for i, standard in enumerate(HEADINGS) for h in dict.fromkeys([standard, *OTHER_HEADINGS.get(i, [])])]
    return spark.createDataFrame(rows, "item_no int, heading string")


def best_heading(headings: list[tuple[int, str]]):
    """A function of a text: the heading most alike by exact partial ratio, as item_no and score; of equal ones the first. Long texts, and those with boilerplate, have none."""

    lower = [h.lower() for _, h in headings]

    @F.pandas_udf("item_no int, score double")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            texts = [None if x is None or len(x) > 200 else x.lower() for x in s]
            asked = [i for i, x in enumerate(texts) if x is not None and lower and not any(p in x for p in BOILERPLATE)]
            number, score = best_of(lower, [texts[i] for i in asked])
            out = pd.DataFrame({"item_no": [None] * len(texts), "score": [None] * len(texts)}, dtype=object)
            out.loc[asked, "item_no"] = [headings[n][0] for n in number]
            out.loc[asked, "score"] = score
            yield out.astype({"item_no": "Int32", "score": "Float64"})

    return best


def candidates(blocks: DataFrame, headings: DataFrame | None = None, *, doc: str = "doc_id", page: str = "page", text: str = "text", kind: str = "kind", total: str = "total_pages", fuzzy_at: float = 75.0, cosine_at: float = 0.5, early: float = 0.8) -> DataFrame:
    """doc, item_no, page, confidence, method from text blocks: titles and patterns by their item number, fuzzy and cosine ones by the heading most like them.

    ``headings`` (item_no, heading; the standard ones unless given) is a lookup of at most ``MOST_HEADINGS`` rows, more raise ValueError. Fuzzy and cosine matching
    look at the first ``early`` share of the pages; fuzzy at texts that look like headings, of 5 to 200 characters; cosine at those of 10 or more.
    """
    headings = standard_headings(blocks.sparkSession) if headings is None else headings.select("item_no", "heading")
    known = [(r["item_no"], r["heading"]) for r in headings.where("heading is not null").limit(MOST_HEADINGS + 1).collect()]
    if len(known) > MOST_HEADINGS:
        raise ValueError("more headings than a lookup has")
    numbered = blocks.withColumn("item_no", item_number(text)).where("item_no is not null")
    found = lambda df, score, method: df.select(doc, "item_no", page, score.cast("double").alias("confidence"), F.lit(method).alias("method"))
    titled = F.coalesce(F.col(kind) == "title", F.lit(False))
    titles, patterns = found(numbered.where(titled), F.lit(0.95), "title"), found(numbered.where(~titled), F.lit(0.8), "pattern")
    first = blocks.where(F.col(page) <= F.greatest(F.lit(1), F.floor(F.col(total) * early)))
    short = first.where((F.length(text) >= 5) & (F.length(text) <= 200) & is_header_like(text)).withColumn("__b", best_heading(known)(F.col(text)))
    fuzzy = found(short.where(F.col("__b.score") >= fuzzy_at).withColumn("item_no", F.col("__b.item_no")), F.col("__b.score") / 100, "fuzzy")
    # numbers of rows must stay the same on either side of the join: written once
    long = written(first.where(F.length(text) >= 10).select(doc, page, F.col(text).alias("__text"), F.monotonically_increasing_id().alias("__row")))
    lookup = blocks.sparkSession.createDataFrame([(n, i, h) for n, (i, h) in enumerate(known)], "n int, item_no int, heading string")
    alike = heading_similarity(long, lookup, text_id="__row", text="__text", heading_id="n", heading="heading", least=cosine_at)
    best = alike.groupBy("text").agg(F.max(F.struct("similarity", (-F.col("heading")).alias("first"))).alias("b")).select(F.col("text").alias("__row"), F.col("b.similarity").alias("__s"), (-F.col("b.first")).alias("n"))
    cosine = found(long.join(best, "__row").join(F.broadcast(lookup.select("n", "item_no")), "n"), F.col("__s"), "cosine")
    return titles.unionByName(patterns).unionByName(fuzzy).unionByName(cosine)


def best_per_page(found: DataFrame, doc: str = "doc_id", page: str = "page") -> DataFrame:
    """Of the candidates of an item on a page the most confident; ties in the order in which the methods look."""
    tie = F.array_position(F.array(*map(F.lit, ("title", "pattern", "fuzzy", "cosine"))), F.col("method"))
    return found.withColumn("__n", F.row_number().over(W.partitionBy(doc, "item_no", page).orderBy(F.col("confidence").desc(), tie))).where("__n = 1").drop("__n")


def assign(found: DataFrame, *, doc: str = "doc_id", page: str = "page", total: str = "total_pages") -> DataFrame:
    """``found`` with each document's total pages: doc, item_no, start_page, method.

    Item 0 starts on page 1, each next item at the best candidate not before the item before: by phase, then confidence, then the earliest page; the last page
    begins nothing. An item's candidates are sorted first, so that the fold over a document's items takes the first one that is late enough.
    """
    rank = F.array_position(F.array(*map(F.lit, METHODS)), F.col("method"))
    begins = (rank > 0) & F.col("item_no").between(1, ITEMS - 1) & (F.col(page) < F.col(total))
    ranked = F.struct(rank.cast("int").alias("rank"), F.coalesce(-F.col("confidence"), F.lit(float("inf"))).alias("less"), F.col(page).cast("int").alias("page"))
    # the item's name stays apart from the document's, whatever that is called
    by_item = found.groupBy(F.col(doc).alias("doc"), F.when(begins, F.col("item_no").cast("int")).alias("item")).agg(F.array_sort(F.collect_list(F.when(begins, ranked))).alias("at"))
    by_doc = by_item.groupBy("doc").agg(F.array_sort(F.collect_list(F.when(F.col("item").isNotNull(), F.struct("item", "at")))).alias("items"))
    row = lambda item, start, method: F.struct(item.cast("int").alias("item_no"), start.cast("int").alias("start_page"), method.alias("method"))

    def placed(so_far: Column, x: Column) -> Column:
        best = F.get(F.filter(x["at"], lambda c: c["page"] >= so_far["least"]), F.lit(0))
        method = F.get(F.array(*map(F.lit, METHODS)), best["rank"] - 1)
        return F.struct(F.coalesce(best["page"], so_far["least"]).alias("least"), F.concat(so_far["starts"], F.array(row(x["item"], best["page"], method))).alias("starts"))

    first = F.struct(F.lit(1).alias("least"), F.array(row(F.lit(0), F.lit(1), F.lit("fixed"))).alias("starts"))
    # the same type from the beginning on, as a fold asks for: starts may be null
    kind = "struct<least:int,starts:array<struct<item_no:int,start_page:int,method:string>>>"
    starts = F.aggregate("items", first.cast(kind), lambda a, x: placed(a, x).cast(kind), lambda a: F.filter(a["starts"], lambda r: r["start_page"].isNotNull()))
    return by_doc.select(F.col("doc").alias(doc), F.inline(starts))


def repaired_starts(starts: list[int], items: list[int], total: int) -> list[int]:
    """Backward from the last item: one that has fewer pages than its least moves earlier, and those before it with it."""
    starts = list(starts)
    ends = total
    for i in range(len(starts) - 1, -1, -1):
        need = LEAST_PAGES.get(items[i], 1)
        starts[i] = max(1, min(starts[i], ends - need + 1))
        ends = starts[i]
    return starts


def repair(sections: DataFrame, *, doc: str = "doc_id", total: str = "total_pages") -> DataFrame:
    """Starts moved so that items have their least pages."""

    def of_doc(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("item_no")
        return rows.assign(start_page=repaired_starts(rows["start_page"].tolist(), rows["item_no"].tolist(), int(rows[total].iloc[0])))

    return sections.groupBy(doc).applyInPandas(of_doc, sections.schema)


def even_sections(docs: DataFrame, *, doc: str = "doc_id", total: str = "total_pages", items: int = ITEMS) -> DataFrame:
    """The fallback: items spread evenly over the pages."""
    i = F.explode(F.sequence(F.lit(0), F.lit(items - 1))).alias("item_no")
    return docs.select(doc, total, i).select(doc, "item_no", (F.floor(F.col("item_no") * (F.col(total) - 1) / items) + 1).cast("int").alias("start_page"), F.lit("even").alias("method"))


def with_fallback(sections: DataFrame, docs: DataFrame, *, doc: str = "doc_id", total: str = "total_pages", required: int = 3) -> DataFrame:
    """Detected sections of documents with at least ``required`` items in page order, even ones for the others."""
    w = W.partitionBy(doc).orderBy("item_no")
    checked = sections.withColumn("__ok", F.coalesce(F.col("start_page") >= F.lag("start_page").over(w), F.lit(True))).groupBy(doc).agg(F.bool_and("__ok").alias("__ok"), F.count(F.lit(1)).alias("__n"))
    good = checked.where(F.col("__ok") & (F.col("__n") >= required)).select(doc)
    return sections.join(good, doc, "left_semi").unionByName(even_sections(docs.join(good, doc, "left_anti"), doc=doc, total=total))
