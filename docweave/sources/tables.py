"""Table scans, lookups, listings and JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(spark: SparkSession, folder: str, names) -> None:
    """Temporary views for SQL text."""
    for n in names:
        scan(spark, folder, n).createOrReplaceTempView(n)


def by_id(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == value).limit(1)


def listing(files: DataFrame, mime: str | None = None, column: str = "mime_type") -> DataFrame:
    return files if mime is None else files.where(F.col(column) == mime)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Permissive: a broken line becomes a row of nulls with its text under ``_corrupt_record``, if the schema has that."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def infer_json_schema(spark: SparkSession, texts: DataFrame, column: str) -> str:
    """The merged schema of all JSON texts as DDL; arrays of objects merge their fields."""
    return texts.where(F.col(column).isNotNull()).agg(F.call_function("schema_of_variant_agg", F.try_parse_json(F.col(column))).alias("s")).first()["s"]


def required_fields(texts: DataFrame, column: str) -> list[str]:
    """The top-level fields that every JSON object has; texts that are none don't count. Without any object: none."""
    objects = texts.select(F.json_object_keys(F.when(F.try_parse_json(F.col(column)).isNotNull(), F.col(column))).alias("k")).where("k is not null")
    n = objects.count()
    found = objects.select(F.explode(F.array_distinct("k")).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == n)
    return sorted(r["k"] for r in found.select("k").collect())


def renamed_by_part(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns renamed by the first of ``names`` that is part of theirs, in lower case."""
    return df.toDF(*[next((new for part, new in names.items() if part in c.lower()), c) for c in df.columns])


def mapped(df: DataFrame, column: str, values: dict[str, str]) -> DataFrame:
    """A column's values by a map; others stay."""
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return df.withColumn(column, F.coalesce(F.try_element_at(table, column), column))


def file_type(content: Column, mime: Column | None = None) -> Column:
    """By MIME type if it says, else by the first bytes."""
    head = F.hex(F.substring(content, 1, 8))
    by_bytes = F.when(head.startswith("25504446"), "pdf").when(head.startswith("504B0304"), "zip").when(head.startswith("89504E47"), "png").when(head.startswith("FFD8FF"), "jpeg").when(head.startswith("D0CF11E0"), "ole").when(F.upper(head).rlike("^(3C21|3C68|3C48)"), "html").otherwise("unknown")
    if mime is None:
        return by_bytes
    return F.when(mime == "application/pdf", "pdf").when(mime.startswith("image/"), F.substring_index(mime, "/", -1)).when(mime == "text/html", "html").otherwise(by_bytes)


def pages_between(pages: DataFrame, start: Column | int, end: Column | int, page: str = "page") -> DataFrame:
    return pages.where(F.col(page).between(start, end))


def page_chunks(pages: DataFrame, key: str, page: str, text: str, size: int) -> DataFrame:
    """Pages (from 0) joined in chunks of ``size``: key, chunk, n_pages, text (by page, a line break between)."""
    parts = F.sort_array(F.collect_list(F.struct(page, text)))
    return pages.groupBy(key, F.floor(F.col(page) / size).cast("long").alias("chunk")).agg(F.count(F.lit(1)).alias("n_pages"), F.array_join(parts[text], "\n").alias("text"))


def document_text(pages: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """A document's pages in one text, each under ``--- Page n ---``."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(page), F.concat(F.lit("--- Page "), F.col(page).cast("string"), F.lit(" ---\n"), F.coalesce(F.col(text), F.lit(""))).alias("t"))))
    return pages.groupBy(key).agg(F.array_join(parts["t"], "\n").alias("text"))


def layout_pages(layouts: DataFrame, column: str = "layout") -> DataFrame:
    """Layout JSON to a row per page: page_idx and its blocks; texts without ``pdf_info`` drop out."""
    lines = "array<struct<spans:array<struct<type:string,content:string>>>>"
    schema = f"struct<pdf_info:array<struct<page_idx:int,para_blocks:array<struct<type:string,lines:{lines},blocks:array<struct<lines:{lines}>>>>>>>"
    parsed = layouts.withColumn("__l", F.from_json(column, schema)).where(F.col("__l.pdf_info").isNotNull())
    return parsed.select(*[c for c in layouts.columns if c != column], F.explode("__l.pdf_info").alias("__p")).select("*", F.col("__p.page_idx").alias("page_idx"), F.col("__p.para_blocks").alias("blocks")).drop("__p")


def render_prompt(template: str, **values: Column) -> Column:
    """``{{ name }}`` replaced by columns."""
    out = F.lit(template)
    for k, v in values.items():
        out = F.regexp_replace(out, F.lit(r"\{\{\s*" + k + r"\s*\}\}"), F.replace(F.replace(F.coalesce(v.cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$")))
    return out
