"""Which files and pages to work on: file selection, page scopes, plans, chunks, and whether to merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK, PREVIEW = 50, 12


def select_files(files: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Names ending in ``.pdf`` of either case; an empty include list means all; exclusion comes after."""
    out = files.where(F.lower("name").endswith(".pdf"))
    if include:
        out = out.where(F.col("name").isin(include))
    return out.where(~F.col("name").isin(exclude)) if exclude else out


def select_files_ordered(files: DataFrame, wanted: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Files in the order of ``wanted`` (name, ordinal)."""
    return select_files(files, exclude=exclude).join(wanted, "name").select("ordinal", "name")


def missing_files(files: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.join(files, "name", "left_anti")


def documents_of(paths: DataFrame) -> DataFrame:
    """``path`` split into document, page folder and page number; folders of analyses are skipped.

    Folders of pages keep their text order (page-1, page-10, page-2).
    """
    out = paths.select("path", F.regexp_extract("path", r"([^/]+)/([^/]+)/[^/]+$", 1).alias("document"), F.regexp_extract("path", r"([^/]+)/([^/]+)/[^/]+$", 2).alias("page_folder"))
    return out.where(~F.col("document").startswith("_analysis") & F.col("page_folder").rlike(r"^page-(\d+)$")).withColumn("page_number", F.regexp_extract("page_folder", r"^page-(\d+)$", 1).try_cast("long"))


def only_document(files: DataFrame) -> DataFrame:
    """The one PDF there is; any other number is an error when the result is read."""
    found = select_files(files).agg(F.count("*").alias("n"), F.min("name").alias("name"))
    return found.select(F.when(F.col("n") == 1, F.col("name")).otherwise(F.raise_error(F.lit("there must be exactly one document"))).alias("name"))


def scope_swapped(total: Column, start: Column, end: Column) -> Column:
    """Pages of a requested range: missing ends mean all, reversed ends are swapped, then cut to the document."""
    s, e = F.coalesce(start, F.lit(1)), F.coalesce(end, total)
    lo, hi = F.greatest(F.lit(1), F.least(s, e)), F.least(total, F.greatest(s, e))
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def scope_collapsed(total: Column, start: Column, end: Column) -> Column:
    """The other rule for ranges: a reversed one leaves only its end page."""
    s, e = F.coalesce(start, F.lit(1)), F.coalesce(end, total)
    lo = F.greatest(F.lit(1), F.least(s, e))
    hi = F.least(total, F.greatest(lo, e))
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def target_pages(total: Column, targets: Column) -> Column:
    """Listed pages that the document has; no list means all pages, a list without a valid page none."""
    all_ = F.sequence(F.lit(1), total)
    valid = F.array_sort(F.array_distinct(F.filter(targets, lambda p: (p >= 1) & (p <= total))))
    return F.when(F.size(F.coalesce(targets, F.array().cast("array<int>"))) == 0, all_).otherwise(valid)


def pages_to_process(total: Column, start: Column, end: Column, targets: Column) -> Column:
    """The collapsed scope within the targets; targets without a valid page are ignored."""
    scope = scope_collapsed(total, start, end)
    valid = F.filter(F.coalesce(targets, F.array().cast("array<int>")), lambda p: (p >= 1) & (p <= total))
    return F.when(F.size(valid) > 0, F.array_intersect(scope, valid)).otherwise(scope)


def plan(pages: DataFrame) -> DataFrame:
    """``action`` of each page from ``is_target, in_scope, exists``: render, reuse or missing."""
    action = F.when(F.col("in_scope") & (F.col("is_target") | ~F.col("exists")), "render").when(F.col("exists"), "reuse").otherwise("missing")
    return pages.withColumn("action", action)


def chunks(pages: DataFrame, by: list[str], page: str = "page", size: int = CHUNK) -> DataFrame:
    """``chunk`` from 0 within ``by``: runs of consecutive pages, at most ``size`` each."""
    w = Window.partitionBy(*by).orderBy(page)
    island = pages.withColumn("_island", F.col(page) - F.row_number().over(w))
    part = F.floor((F.row_number().over(Window.partitionBy(*by, "_island").orderBy(page)) - 1) / size)
    first = island.withColumn("_part", part).withColumn("_new", (F.row_number().over(Window.partitionBy(*by, "_island", "_part").orderBy(page)) == 1).cast("int"))
    return first.withColumn("chunk", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1).drop("_island", "_part", "_new")


def merge_gate(planned: DataFrame, by: str, strict_compat: bool = False) -> DataFrame:
    """Per document: nothing done is a failure, a page missing keeps it from being merged, else it is merged.

    ``failed`` pages (rendered without success) count as missing, except with ``strict_compat``, where only those of a
    failed single page do (``failed_chunk`` is then passed over).
    """
    lost = F.col("failed") if strict_compat else (F.col("failed") | F.col("failed_chunk"))
    got = (F.col("action") == "reuse") | ((F.col("action") == "render") & ~(F.col("failed") | F.col("failed_chunk")))
    gone = (F.col("action") == "missing") | ((F.col("action") == "render") & lost)
    per = planned.groupBy(by).agg(F.count_if(got).alias("done"), F.count_if(gone).alias("missing"), F.slice(F.array_sort(F.collect_set(F.when(gone, F.col("page")))), 1, PREVIEW).alias("_first"))
    status = F.when(F.col("done") == 0, "failed").when(F.col("missing") > 0, "not_merged").otherwise("merged")
    preview = F.concat(F.array_join(F.col("_first").cast("array<string>"), ", "), F.when(F.col("missing") > PREVIEW, F.lit(" ...")).otherwise(F.lit("")))
    return per.select(by, "done", "missing", status.alias("status"), preview.alias("missing_pages"))


def run_summary(statuses: DataFrame) -> DataFrame:
    """Documents processed, succeeded (merged or not) and failed."""
    return statuses.agg(F.count("*").alias("processed"), F.count_if(F.col("status") != "failed").alias("succeeded"), F.count_if(F.col("status") == "failed").alias("failed"))
