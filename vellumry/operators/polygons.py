"""Polygon records: inserting, keeping, rescaling, patching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.functions import geometry as g

#: The polygon that a bulk patch puts on late pages, and the first page of it.
PATCH = [(342, 649), (2655, 874), (5273, 833), (5270, 5919), (3273, 5933), (3211, 6770), (40, 6835), (40, 3438)]
PATCH_FROM = 61


def upsert(pages: DataFrame, existing: DataFrame, by: list[str], overwrite: bool = False) -> DataFrame:
    """``pages`` (page_width, page_height, render_dpi) merged with ``existing`` (the same and ``polygon``).

    No record: the default polygon. The same size and resolution: the record as it is. Else the old polygon rescaled to
    the new size. Missing sizes in a record count as the new ones. Existing records of other pages stay.
    """
    old = existing.select(*by, *[F.col(c).alias(f"_{c}") for c in ("page_width", "page_height", "render_dpi", "polygon")], F.lit(True).alias("_has"))
    both = pages.join(old, by, "left")
    ow, oh, od = (F.coalesce(f"_{c}", c) for c in ("page_width", "page_height", "render_dpi"))
    default = g.default_polygon()
    same = (ow == F.col("page_width")) & (oh == F.col("page_height")) & (od == F.col("render_dpi"))
    scaled = g.rescale(F.col("_polygon"), ow, oh, F.col("page_width"), F.col("page_height"))
    if overwrite:
        polygon, action = default, F.lit("overwritten")
    else:
        action = F.when(F.col("_has").isNull(), "inserted").when(same, "kept").otherwise("rescaled")
        polygon = F.when(F.col("_has").isNull() | F.col("_polygon").isNull(), default).when(same, F.col("_polygon")).otherwise(scaled)
    done = both.select(*by, "page_width", "page_height", "render_dpi", polygon.alias("polygon"), action.alias("action"))
    rest = existing.join(pages, by, "left_anti").select(*by, "page_width", "page_height", "render_dpi", "polygon", F.lit("untouched").alias("action"))
    return done.unionByName(rest)


def load(pages: DataFrame, records: DataFrame, by: list[str]) -> DataFrame:
    """``pages`` with their record's columns, ``found`` and ``failure``: a page without a record fails, the others go on.

    Sizes of pages are joined by the same rule; they are null where there is no record.
    """
    both = pages.join(records.withColumn("_has", F.lit(True)), by, "left")
    return both.withColumns({"found": F.col("_has").isNotNull(), "failure": F.when(F.col("_has").isNull(), "no polygon record")}).drop("_has")


def patch(records: DataFrame, page: str = "page_number", first: int = PATCH_FROM, polygon: list[tuple[int, int]] | None = None) -> DataFrame:
    points = F.array(*[g.point(F.lit(float(x)), F.lit(float(y))) for x, y in polygon or PATCH])
    return records.withColumn("polygon", F.when(F.col(page) >= first, points).otherwise(F.col("polygon")))


def save(records: DataFrame) -> DataFrame:
    return records.withColumn("polygon", g.saved(F.col("polygon"), F.col("page_width"), F.col("page_height")))
