"""Label pages: documents on a page, each with polygons by info type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumry.functions import geometry as g
from vellumry.functions import maps as m

ARTIFACT_EXTRA = ["unified", "labels"]


def seed(pages: DataFrame, existing: DataFrame, polygons: DataFrame, sizes: DataFrame, by: list[str]) -> DataFrame:
    """New label pages for pages that have none, with the page's polygon as first content if it has three points.

    Coordinates are truncated; page sizes may be missing.
    """
    new = pages.join(existing.select(*by), by, "left_anti").join(polygons.select(*by, "polygon"), by, "left").join(sizes.select(*by, "page_width", "page_height"), by, "left")
    whole = F.transform("polygon", lambda q: g.point(q["x"].cast("long").cast("double"), q["y"].cast("long").cast("double")))
    start = F.when(F.size("polygon") >= 3, F.array(whole)).otherwise(F.array().cast(m.POLYGONS))
    first = "src_content" if "src_content" in m.INFO_TYPES else m.INFO_TYPES[0]
    record = F.map_zip_with(m.empty_record(), F.create_map(F.lit(first), F.coalesce(start, F.array().cast(m.POLYGONS))), lambda _, a, b: F.coalesce(b, a))
    return new.select(*by, "page_width", "page_height", F.lit(1).alias("num_documents"), F.create_map(F.lit("doc_1"), record).alias("documents"))


def created(pages: DataFrame, existing: DataFrame, by: list[str], document: str) -> DataFrame:
    """``document, created, skipped``: how many label pages ``seed`` makes for each document and how many it leaves alone."""
    known = existing.select(*by).distinct().withColumn("_has", F.lit(True))
    return pages.join(known, by, "left").groupBy(document).agg(F.count_if(F.col("_has").isNull()).alias("created"), F.count("_has").alias("skipped"))


def present(pages: DataFrame, records: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Label records of the pages asked for, and the pages that have none (to be warned of and skipped)."""
    return records.join(pages.select(*by).distinct(), by, "left_semi"), pages.join(records.select(*by).distinct(), by, "left_anti")


def rows(pages: DataFrame, by: list[str]) -> DataFrame:
    """One row for each polygon of the documents ``doc_1`` to ``doc_n``; other documents aren't read."""
    key = F.explode(F.transform(F.sequence(F.lit(1), F.col("num_documents").cast("int")), lambda i: F.concat(F.lit("doc_"), i.cast("string")))).alias("doc_key")
    docs = pages.select(*by, "documents", key).select(*by, "doc_key", F.explode(m.in_type_order(F.col("documents")[F.col("doc_key")])).alias("t"))
    return docs.select(*by, "doc_key", "t.info_type", F.posexplode("t.polygons").alias("poly_idx", "polygon"))


def manifest(label_rows: DataFrame, by: list[str]) -> DataFrame:
    """Artifacts of each document that has any polygon of three points: one for each type, blank or not, and two more."""
    docs = label_rows.where(F.size("polygon") >= 3).select(*by, "doc_key").distinct()
    names = F.array(*[F.lit(x) for x in [*m.INFO_TYPES, *ARTIFACT_EXTRA]])
    return docs.select(*by, "doc_key", F.explode(names).alias("artifact"))


def export(label_rows: DataFrame, by: list[str]) -> DataFrame:
    """Polygons of each document as one map from info type to list."""
    types = label_rows.groupBy(*by, "doc_key", "info_type").agg(F.array_sort(F.collect_list(F.struct("poly_idx", "polygon"))).alias("at"))
    return types.groupBy(*by, "doc_key").agg(F.map_from_entries(F.collect_list(F.struct("info_type", F.col("at.polygon")))).alias("polygons"))


def on_load(documents: Column) -> Column:
    return F.transform_values(documents, lambda _, r: m.with_all_types(m.with_new_names(r)))


def on_save(documents: Column, n: Column) -> Column:
    return m.without_surplus(documents, n)


def current_document(current: Column, n: Column) -> Column:
    k = F.nullif(F.regexp_extract(current, r"^doc_([1-9]\d*)$", 1), F.lit("")).try_cast("int")
    return F.when(k <= n, current).otherwise(F.lit("doc_1"))


def type_of_key(n: Column) -> Column:
    """Info type of a number key, from 1; null beyond the list."""
    return F.when((n >= 1) & (n <= len(m.INFO_TYPES)), F.get(F.array(*[F.lit(t) for t in m.INFO_TYPES]), n - 1))


def closed(vertices: Column) -> Column:
    """A drawn polygon, rounded, once it has three corners; null before."""
    return F.when(F.size(vertices) >= 3, F.transform(vertices, lambda q: g.point(F.bround(q["x"]), F.bround(q["y"]))))


def without_polygon(polygons: Column, index: Column) -> Column:
    return F.filter(polygons, lambda _, i: i != index)


def style(is_active_type: Column, is_selected: Column, color: Column) -> Column:
    """``struct<stipple,outline,width>`` of a polygon by its state."""
    s = F.struct(F.when(is_active_type, "gray50").otherwise("gray25").alias("stipple"), F.when(is_active_type & is_selected, "white").when(is_active_type, color).otherwise("#555555").alias("outline"), F.when(is_active_type & is_selected, 3).when(is_active_type, 2).otherwise(1).alias("width"))
    return s


def hit(label_rows: DataFrame, clicks: DataFrame, by: list[str], radius: int = 7) -> DataFrame:
    """What a click meets: a corner or the body of the selected polygon, else the first polygon of the current type, else
    of the other types in order. ``clicks`` has ``by``, doc_key, x, y, info_type, selected (null: none).
    """
    order = F.create_map(*[F.lit(x) for i, t in enumerate(m.INFO_TYPES) for x in (t, i)])
    both = clicks.withColumnRenamed("info_type", "current").join(label_rows, [*by, "doc_key"])
    mine = F.col("info_type") == F.col("current")
    chosen = F.coalesce(mine & (F.col("poly_idx") == F.col("selected")), F.lit(False))
    corner = g.handle_at(F.col("polygon"), F.col("x"), F.col("y"), radius)
    inside = g.contains(F.col("polygon"), F.col("x"), F.col("y"))
    rank = F.when(chosen & corner.isNotNull(), 1).when(chosen & inside, 2).when(mine & inside & (F.size("polygon") >= 3), 3).when(inside & (F.size("polygon") >= 3), 4)
    hits = both.withColumns({"rank": rank, "corner": F.when(rank == 1, corner), "_o": order[F.col("info_type")]}).where("rank is not null")
    first = F.row_number().over(Window.partitionBy(*by, "doc_key", "x", "y").orderBy("rank", "_o", "poly_idx"))
    best = hits.withColumn("_n", first).where("_n = 1").select(*by, "doc_key", "x", "y", "rank", "info_type", "poly_idx", "corner")
    return clicks.select(*by, "doc_key", "x", "y").join(best, [*by, "doc_key", "x", "y"], "left")
