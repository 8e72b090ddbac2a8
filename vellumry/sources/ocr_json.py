"""OCR results, page sizes, polygons and label pages as JSON files in folders.

Paths carry the document and page; a file that doesn't parse gives a row of nulls, which the callers drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry import schemas


def _read(spark: SparkSession, schema: str, *globs: str) -> DataFrame:
    return spark.read.schema(schemas.parsed(schema)).option("multiLine", True).json(list(globs)).withColumn("path", F.col("_metadata.file_path"))


def read_page_folders(spark: SparkSession, root: str) -> DataFrame:
    """``<root>/<document>/page-<n>/read.json``: the first page of each file; folders of analyses are skipped."""
    df = _read(spark, schemas.OCR_PAGES, f"{root}/*/page-*/read.json")
    at = r"/([^/]+)/page-(\d+)/read\.json$"
    out = df.select(F.regexp_extract("path", at, 1).alias("document"), F.regexp_extract("path", at, 2).try_cast("long").alias("page_number"), F.get("pages", F.lit(0)).alias("page"))
    return out.where(~F.col("document").startswith("_analysis") & F.col("page_number").isNotNull() & F.col("page").isNotNull())


def read_page_files(spark: SparkSession, root: str, folders: list[str]) -> tuple[DataFrame, DataFrame]:
    """``<root>/<folder>/page_<i>.json`` in the order of ``folders``: files of exactly one page, and the rejected ones.

    Folders without such files give nothing.
    """
    order = spark.createDataFrame([(f, i) for i, f in enumerate(folders)], "folder string, folder_order int")
    df = _read(spark, schemas.OCR_PAGES, f"{root}/*/page_*.json")
    at = r"/([^/]+)/page_(\d+)\.json$"
    named = df.select("path", F.regexp_extract("path", at, 1).alias("folder"), F.regexp_extract("path", at, 2).try_cast("long").alias("page_number"), "pages", F.size(F.coalesce("pages", F.array().cast(df.schema["pages"].dataType))).alias("n")).join(order, "folder")
    good = (F.col("n") == 1) & F.col("page_number").isNotNull()
    kept = named.where(good).select("folder_order", "folder", "page_number", F.get("pages", F.lit(0)).alias("page"))
    return kept, named.where(~good | F.col("page_number").isNull()).select("path", F.col("n").alias("pages"))


def read_documents(spark: SparkSession, root: str, first_pages: int = 0) -> DataFrame:
    """``<root>/<name>.pdf.json``: one row for each page, the first ``first_pages`` of them (0: all)."""
    df = _read(spark, schemas.OCR_PAGES, f"{root}/*.json")
    pages = F.slice("pages", 1, first_pages) if first_pages else F.col("pages")
    return df.select(F.regexp_extract("path", r"([^/]+)\.pdf\.json$", 1).alias("document"), F.posexplode(pages).alias("i", "page")).select("document", (F.col("i") + 1).cast("long").alias("page_number"), "page")


def words_of(pages: DataFrame, by: list[str]) -> DataFrame:
    """One row for each word of ``page``, with its 0-based place."""
    return pages.select(*by, F.posexplode("page.words").alias("seq", "w")).select(*by, "seq", "w.content", "w.polygon", "w.confidence", F.col("w.span.offset").alias("span_offset"), F.col("w.span.length").alias("span_length"))


def lines_of(pages: DataFrame, by: list[str]) -> DataFrame:
    return pages.select(*by, F.posexplode("page.lines").alias("line_index", "l")).select(*by, "line_index", "l.content", "l.polygon", "l.spans")


def read_page_records(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """``page_sizes``, ``polygons`` or ``labels`` from ``<root>/<document>/<kind>/page_<n>.json``."""
    schema = {"page_sizes": schemas.PAGE_SIZE, "polygons": schemas.POLYGON, "labels": schemas.LABEL_PAGE}[kind]
    df = _read(spark, schema, f"{root}/*/{kind}/page_*.json")
    return df.withColumn("document", F.regexp_extract("path", rf"/([^/]+)/{kind}/page_\d+\.json$", 1)).drop("path")
