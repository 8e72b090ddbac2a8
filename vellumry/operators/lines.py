"""Reading lines rebuilt from word boxes, and per-page measures."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumry.functions.geometry import center

Y_THRESHOLD_IN = 0.12
PAGE = ["source_document", "page_number"]


KEY = [*PAGE, "line_number", "word_number"]
REST = ["content", "confidence", "span_offset", "span_length", "x0", "y0", "x1", "y1"]


def page_words(words: DataFrame) -> DataFrame:
    """One row for each page: ``at``, its words in reading order as delivered. The only shuffle that lines need.

    Rows delivered twice fall together; of unlike contents for one place the last delivery counts (``ingested_at``, where
    there is one), of several at one time the least by value. Rows without a key or a box are left out.
    """
    whole = words.where(" and ".join(f"{c} is not null" for c in [*KEY, "x0", "y0", "x1", "y1"]))
    age = -F.unix_micros(F.col("ingested_at").cast("timestamp")) if "ingested_at" in words.columns else F.lit(0).cast("long")
    word = F.struct("line_number", "word_number", F.coalesce(age, F.lit((1 << 63) - 1)).alias("_age"), *REST)
    pages = whole.groupBy(*PAGE).agg(F.sort_array(F.collect_list(word)).alias("all"))
    place = lambda w: F.struct(w["line_number"], w["word_number"])
    first = lambda w, i: (i == 0) | (place(F.get("all", i - 1)) != place(w))
    return pages.select(*PAGE, F.transform(F.filter("all", first), lambda w: w.dropFields("_age")).alias("at"))


def distinct_words(words: DataFrame) -> DataFrame:
    """One row for each word of a page, with ``seq``, its 0-based place in reading order as delivered."""
    return page_words(words).select(*PAGE, F.posexplode("at").alias("seq", "w")).select(*PAGE, "w.*", "seq")


def fold_lines(threshold: float = Y_THRESHOLD_IN):
    """Line numbers from 1 for the sorted centres of a page's words.

    A word joins the current line while its centre lies within the threshold of the mean of the line so far.
    """

    @F.pandas_udf("array<int>")
    def fold(centres: pd.Series) -> pd.Series:
        made = []
        for ys in centres:
            lines, line, n, mean = [], 0, 0, 0.0
            for y in ys.tolist():
                if n and abs(y - mean) <= threshold:
                    n += 1
                    mean = (mean * (n - 1) + y) / n
                else:
                    line, n, mean = line + 1, 1, y
                lines.append(line)
            made.append(lines)
        return pd.Series(made)

    return fold


def group_lines(words: DataFrame, threshold: float = Y_THRESHOLD_IN) -> DataFrame:
    """Words with ``seq``, their ``line`` and ``pos`` in it, both from 1, and the page's ``median_height``.

    Words are taken by height of centre, then from the left; within a line they stand by centre from the left. Only the
    centres go to Python, a list for each page; everything after stays partitioned by page.
    """
    sorted_ = F.array_sort(F.transform("at", lambda w, i: F.struct(center(w["y0"], w["y1"]).alias("yc"), center(w["x0"], w["x1"]).alias("xc"), i.alias("seq"))))
    pages = page_words(words).withColumn("o", sorted_).withColumn("lines", fold_lines(threshold)(F.col("o.yc")))
    word = lambda o, i: F.struct(F.get("at", o["seq"]).alias("w"), o["seq"].alias("seq"), o["yc"].alias("yc"), o["xc"].alias("xc"), F.get("lines", i).alias("line"))
    each = pages.select(*PAGE, _upper_median("at").alias("median_height"), F.explode(F.transform("o", word)).alias("x")).select(*PAGE, "median_height", "x.w.*", "x.seq", "x.yc", "x.xc", "x.line")
    pos = F.row_number().over(Window.partitionBy(*PAGE, "line").orderBy("xc", "yc", "seq"))
    return each.withColumn("pos", pos).drop("yc", "xc")


def _text(at: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(at), lambda s: s["content"]), " ")


CONTEXT = ["line_text", "ctx_x0", "ctx_y0", "ctx_x1", "ctx_y1"]


def line_context(lined: DataFrame, *more: Column) -> DataFrame:
    """Text and box of each line, its number of words, and ``more`` aggregates."""
    box = [F.min("x0").alias("ctx_x0"), F.min("y0").alias("ctx_y0"), F.max("x1").alias("ctx_x1"), F.max("y1").alias("ctx_y1")]
    return lined.groupBy(*PAGE, "line").agg(_text(F.collect_list(F.struct("pos", "content"))).alias("line_text"), *box, F.count("*").alias("words"), *more)


def line_bases(context: DataFrame) -> DataFrame:
    """Offset of each line in its page's text, lines joined by a newline."""
    before = Window.partitionBy(*PAGE).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    return context.withColumn("base", F.coalesce(F.sum(F.length("line_text") + 1).over(before), F.lit(0)))


def _upper_median(at: str) -> Column:
    h = F.array_sort(F.transform(at, lambda w: w["y1"] - w["y0"]))
    return F.element_at(h, F.floor(F.size(h) / 2).cast("int") + 1)


def upper_median_height(words: DataFrame) -> DataFrame:
    """The page's word height in the middle of the sorted list, the upper one of two."""
    return page_words(words).select(*PAGE, _upper_median("at").alias("median_height"))
