"""A corpus pipeline of five stages, each one operator over all that the stage before it kept.

    quality classifier    documents that it scores below 0.7 go
    quality rules         documents that the base or a learned rule rejects go
    simhash near-dedup    of each group of near copies the document with the smallest id stays
    decontamination       documents that hold a benchmark item's template go
    best-fit packing      the rest is cut and packed into sequences: the pieces with their places

All but the last return the columns of documents. Models are fitted on each stage's own input and the labels table.
Rows with a null id are judged like others; of near copies one stays only where no row with an id is. Rows that share
an id or have none are documents of their own: of each group of near copies just one row stays, and a contaminated row goes alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common, decontaminate, packing, quality_model, quality_rules, simhash
from docweave.llm.queries import WORD_BPE, table, vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    if model.untaught:
        return docs
    score = common.unused(docs, "__score")
    return quality_model.with_score(docs, model, out=score).where(F.col(score) >= 0.7).select(*docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learned = quality_rules.learn_from(docs, table(spark, sf_dir, "labels"))
    # counts may take a column's name, so the rows go along as one
    row, text = common.unused(docs, "__row"), common.unused(docs, "__text")
    whole = docs.select(F.struct(*docs.columns).alias(row), F.col("text").alias(text))
    return quality_rules.judge(whole, learned, text=text).where("kept").select(F.inline(F.array(row)))


#: Bits in which the fingerprints of near copies differ at most. Texts with a five-word-shingle similarity of 0.8 or more differ in some five to ten.
NEAR_BITS = 5


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: that of the smallest id, nulls last."""
    return simhash.one_of_each(docs, shingle=3, distance=NEAR_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary(WORD_BPE), capacity=2048)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: The stages learn models and pack by a program: no SQL says their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.materialize(docs, f"stage-{i}")
    return docs
