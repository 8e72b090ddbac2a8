"""Located corrections applied to error records, and the lean low-confidence export."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumry.functions import geometry, text
from vellumry.operators import shred
from vellumry.operators.errors import EXPORT_CONFIDENCE, EXPORT_LIMIT
from vellumry.scale import dense_id

KEY = ["source_document", "page_number", "line_number", "word_number"]


def records_of(entries: DataFrame) -> DataFrame:
    """One row for each error number; of unlike deliveries the one exported last."""
    rest = ["exported_at", *KEY, "error_type", "error"]
    return entries.groupBy("error_id").agg(F.max(F.struct(*rest, F.col("context.line_text").alias("line_text"))).alias("r")).select("error_id", "r.*")


def last_at_location(records: DataFrame) -> DataFrame:
    """Of the records at one location the one with the highest number: the one a correction finds."""
    return records.dropna(subset=KEY).groupBy(*KEY).agg(F.max("error_id").alias("error_id"))


def distinct_corrections(corrections: DataFrame) -> DataFrame:
    return corrections.select("correction_id", *KEY, "corrected", "submitted_at").distinct()


def unmatched(corrections: DataFrame, entries: DataFrame) -> DataFrame:
    """Corrections whose location no record has; nulls never match."""
    keys = entries.select(*KEY).distinct()
    return distinct_corrections(corrections).join(keys, KEY, "left_anti").select("correction_id", *KEY)


def apply(corrections: DataFrame, entries: DataFrame, on_missing: str = "skip") -> DataFrame:
    """``error_id, line_text, corrected_text, corrections`` of all records.

    Corrections of one location are applied in order of submission to the line of its last record: each replaces the first
    occurrence of the record's error text. Their order matters, so they meet in one array. A null correction, error text
    or line changes nothing. ``on_missing="error"`` refuses to give any result if a correction has no record.
    """
    if on_missing == "error" and unmatched(corrections, entries).limit(1).count():
        raise KeyError("a correction names a location without a record")
    records = records_of(entries)
    found = distinct_corrections(corrections).where("corrected is not null").join(last_at_location(records), KEY)
    listed = found.groupBy("error_id").agg(F.array_sort(F.collect_list(F.struct("submitted_at", "correction_id", "corrected"))).alias("fixes"))
    both = records.join(listed, "error_id", "left")
    fixed = F.aggregate("fixes", F.col("line_text"), lambda line, c: F.coalesce(text.replace_first(line, F.col("error"), c["corrected"]), line))
    return both.select("error_id", "line_text", F.when(F.col("fixes").isNull(), F.col("line_text")).otherwise(fixed).alias("corrected_text"), F.coalesce(F.size("fixes"), F.lit(0)).alias("corrections"))


def placed_words(reads: DataFrame) -> DataFrame:
    """Words with the native line that holds them: number of the line and of the word in it, from 1.

    Only a line's first span counts, lines without one are skipped. Words are numbered by offset within each line, and
    then of several lines the last is taken; words on no line are left out.
    """
    pages = shred.latest(reads, ("source_document", "pages")).dropDuplicates(["read_id"]).select("read_id", "source_document", F.posexplode("pages").alias("page_index", "page"))
    base = ["read_id", F.col("page_index").cast("long").alias("page_index")]
    words = pages.select(*base, "source_document", F.posexplode("page.words").alias("seq", "w")).where("w is not null").select("read_id", "page_index", "source_document", "seq", "w.content", F.coalesce("w.confidence", F.lit(1.0)).alias("confidence"), F.col("w.span.offset").alias("span_offset"), geometry.flat_bbox(F.col("w.polygon")).alias("err"))
    lines = pages.select(*base, F.posexplode("page.lines").alias("line_index", "l")).select("read_id", "page_index", F.col("line_index").cast("long").alias("line_index"), F.col("l.content").alias("line_text"), geometry.flat_bbox(F.col("l.polygon")).alias("ctx"), F.get("l.spans", F.lit(0)).alias("s"))
    spans = lines.select("read_id", "page_index", "line_index", F.col("s.offset").alias("offset"), F.col("s.length").alias("length"))
    met = shred.covering(words, spans).where("line_index is not null")
    number = F.row_number().over(Window.partitionBy("read_id", "page_index", "line_index").orderBy("span_offset", "seq"))
    last = F.row_number().over(Window.partitionBy("read_id", "page_index", "seq").orderBy(F.desc("line_index")))
    one = met.withColumn("word_number", number.cast("long")).withColumn("_last", last).where("_last = 1").drop("_last")
    return one.join(lines.drop("s"), ["read_id", "page_index", "line_index"]).withColumn("line_number", F.col("line_index") + 1)


def low_confidence_export(reads: DataFrame, threshold: float = EXPORT_CONFIDENCE, limit: int = EXPORT_LIMIT) -> DataFrame:
    """The first ``limit`` (0: all) words below the threshold of each page, in array order, numbered over all pages."""
    low = placed_words(reads).where(F.col("confidence") < F.lit(threshold))
    if limit:
        low = low.withColumn("_k", F.row_number().over(Window.partitionBy("read_id", "page_index").orderBy("seq"))).where(F.col("_k") <= limit).drop("_k")
    numbered = dense_id(low, ["source_document", "read_id", "page_index", "seq"], "_n")
    return numbered.select(text.prefixed_id(F.col("_n")).alias("error_id"), F.lit("low_confidence").alias("error_type"), "source_document", "read_id", (F.col("page_index") + 1).alias("page_number"), "line_number", "word_number", F.col("content").alias("error"), "line_text", F.col("err.x0").alias("err_x0"), F.col("err.y0").alias("err_y0"), F.col("err.x1").alias("err_x1"), F.col("err.y1").alias("err_y1"))
