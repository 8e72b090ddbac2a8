"""Deterministic test views over the tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.functions import maps as m
from vellumry.scale import table

NAMES = ", ".join(f"'{t}'" for t in m.INFO_TYPES)

POLYGONS_SQL = """
polys AS (SELECT doc_id, doc_id % 100 + 1 AS page_number, 5312 - (doc_id % 7) * 50 AS page_width, 6875 - (doc_id % 5) * 25 AS page_height, 150 AS render_dpi,
 list_transform(range(CASE WHEN doc_id % 11 = 0 THEN 2 WHEN doc_id % 4 = 0 THEN 4 ELSE 6 END), lambda i: {'x': CAST((doc_id * 37 + i * 1013) % 6000 - 200 AS DOUBLE) + 0.5::DOUBLE, 'y': CAST((doc_id * 53 + i * 1511) % 7500 - 200 AS DOUBLE) + 0.5::DOUBLE}) AS polygon FROM documents)"""
SCOPES_SQL = """
scopes AS (SELECT doc_id, CAST(doc_id % 50 + 1 AS INT) AS total, CASE WHEN doc_id % 5 <> 0 THEN CAST((doc_id * 7) % 60 - 3 AS INT) END AS s0, CASE WHEN doc_id % 7 <> 0 THEN CAST((doc_id * 11) % 60 - 3 AS INT) END AS e0,
 CASE doc_id % 4 WHEN 0 THEN [] WHEN 1 THEN [CAST(doc_id % 9 AS INT), CAST(doc_id % 17 AS INT), CAST(doc_id % 9 AS INT)] WHEN 2 THEN [1000] ELSE [5, 3, -1] END AS targets FROM documents)"""
LABELS_SQL = f"""
lab AS (SELECT doc_id, 1 + doc_id % 3 AS num_documents, d AS doc_idx, t AS type_idx, ([{NAMES}])[t + 1] AS info_type, row_number() OVER (PARTITION BY doc_id, d, t ORDER BY p) - 1 AS poly_idx,
 list_transform(range((doc_id + d + t + p) % 5 + 1), lambda k: {{'x': CAST((doc_id * 7 + t * 311 + k * 523) % 5000 AS DOUBLE), 'y': CAST((doc_id * 11 + p * 97 + k * k * 401) % 6000 AS DOUBLE) + 0.25::DOUBLE}}) AS polygon
 FROM documents, range(1, 5) a(d), range(8) b(t), range(2) c(p) WHERE (doc_id * 5 + d * 3 + t * 7 + p * 11) % 6 = 0)"""
IMAGES_SQL = "img AS (SELECT DISTINCT vec_id AS image_id, list_transform(embedding, lambda e: CAST(greatest(0, least(255, floor((CAST(e AS DOUBLE) + 0.6::DOUBLE) * 212))) AS INT)) AS image FROM embeddings)"


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id")
    n = F.when(F.col("doc_id") % 11 == 0, 2).when(F.col("doc_id") % 4 == 0, 4).otherwise(6)
    p = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((((F.col("doc_id") * 37 + i * 1013) % 6000 - 200).cast("double") + 0.5).alias("x"), (((F.col("doc_id") * 53 + i * 1511) % 7500 - 200).cast("double") + 0.5).alias("y")))
    return d.select("doc_id", (F.col("doc_id") % 100 + 1).alias("page_number"), (5312 - (F.col("doc_id") % 7) * 50).alias("page_width"), (6875 - (F.col("doc_id") % 5) * 25).alias("page_height"), F.lit(150).alias("render_dpi"), p.alias("polygon"))


def scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("doc_id")
    i = lambda x: x.cast("int")
    targets = F.when(c % 4 == 0, F.array().cast("array<int>")).when(c % 4 == 1, F.array(i(c % 9), i(c % 17), i(c % 9))).when(c % 4 == 2, F.array(F.lit(1000))).otherwise(F.array(F.lit(5), F.lit(3), F.lit(-1)))
    return table(spark, sf_dir, "documents").select("doc_id", i(c % 50 + 1).alias("total"), F.when(c % 5 != 0, i((c * 7) % 60 - 3)).alias("s0"), F.when(c % 7 != 0, i((c * 11) % 60 - 3)).alias("e0"), targets.alias("targets"))


def label_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, num_documents, documents``; a type without polygons has no key."""
    c, d, t, p = F.col("doc_id"), F.col("d"), F.col("t"), F.col("p")
    r = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("d")).select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("t")).select("*", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("p")).where((c * 5 + d * 3 + t * 7 + p * 11) % 6 == 0)
    n = ((c + d + t + p) % 5).cast("int")
    points = F.transform(F.sequence(F.lit(0), n), lambda k: F.struct(((c * 7 + t * 311 + k * 523) % 5000).cast("double").alias("x"), (((c * 11 + p * 97 + k * k * 401) % 6000).cast("double") + 0.25).alias("y")))
    name = F.element_at(F.array(*[F.lit(x) for x in m.INFO_TYPES]), t + 1)
    by_type = r.groupBy("doc_id", "d", name.alias("info_type")).agg(F.array_sort(F.collect_list(F.struct("p", points.alias("polygon")))).alias("at"))
    by_doc = by_type.groupBy("doc_id", "d").agg(F.map_from_entries(F.collect_list(F.struct("info_type", F.col("at.polygon")))).alias("r"))
    return by_doc.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("doc_"), F.col("d").cast("string")), "r"))).alias("documents")).withColumn("num_documents", 1 + c % 3)


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixel = lambda e: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((e.cast("double") + 0.6) * 212))).cast("int")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.transform("embedding", pixel).alias("image")).distinct()


def corners(df: DataFrame, by: list[str], polygon: str = "polygon") -> DataFrame:
    return df.select(*by, F.posexplode(polygon).alias("i", "q")).select(*by, F.col("i").cast("long").alias("i"), "q.x", "q.y")
