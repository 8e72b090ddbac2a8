"""Queries on files, page scopes, polygons, labels and images, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.functions import geometry as g
from vellumry.functions import maps as m
from vellumry.functions import text
from vellumry.operators import compact, labels, pages, polygons, raster
from vellumry.plans import views as v
from vellumry.scale import table

Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _Q[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_P = "WITH " + v.POLYGONS_SQL
_CORNERS = "SELECT doc_id, i - 1 AS i, polygon[i].x AS x, polygon[i].y AS y FROM (SELECT *, unnest(range(1, len(polygon) + 1)) AS i FROM {0})"
_CLAMP_X = "greatest(0, least(page_width - 1, {0}))"
_CLAMP_Y = "greatest(0, least(page_height - 1, {0}))"


@query(
    "page_sizes",
    r"""WITH v AS (SELECT file_id, written_at, body FROM page_size_files WHERE json_valid(body)),
r AS (SELECT file_id, written_at, unnest(CASE WHEN json_type(body) = 'ARRAY' THEN CAST(body AS JSON[]) ELSE [CAST(body AS JSON)] END) AS r FROM v),
k AS (SELECT file_id, written_at, r, nullif(lower(regexp_replace(regexp_extract(trim(r ->> '$.source_pdf'), '([^/\\]*)$', 1), '\.[^.]*$', '')), '') AS source_document, TRY_CAST(trim(r ->> '$.page_number') AS DOUBLE) AS n FROM r),
b AS (SELECT source_document, CAST(n AS BIGINT) AS page_number, max_by(r, struct_pack(w := written_at, f := file_id)) AS r FROM k WHERE source_document IS NOT NULL AND n = floor(n) GROUP BY 1, 2),
p AS (SELECT source_document, page_number, TRY_CAST(r ->> '$.width_points' AS DOUBLE) AS w, TRY_CAST(r ->> '$.height_points' AS DOUBLE) AS h FROM b)
SELECT source_document, page_number, CAST(round_even(w / 72 * 150, 0) AS INT) AS width_px, CAST(round_even(h / 72 * 150, 0) AS INT) AS height_px, round_even(w / 72, 4) AS width_in, round_even(h / 72, 4) AS height_in FROM p""",
)
def page_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = compact.keep_latest(compact.read_records(table(spark, sf_dir, "page_size_files")))
    w, h = (F.get_json_object("record", f"$.{k}_points").try_cast("double") for k in ("width", "height"))
    return kept.select("source_document", "page_number", g.points_to_pixels(w).alias("width_px"), g.points_to_pixels(h).alias("height_px"), g.points_to_inches(w).alias("width_in"), g.points_to_inches(h).alias("height_in"))


@query(
    "default_polygon",
    _P
    + """, d AS (SELECT doc_id, 'fixed' AS notch, [{'x': 172.0::DOUBLE, 'y': 234.0::DOUBLE}, {'x': 4916, 'y': 208}, {'x': 4952, 'y': 5556}, {'x': 2669, 'y': 5540}, {'x': 2679, 'y': 6653}, {'x': 182, 'y': 6622}] AS polygon FROM polys UNION ALL
SELECT doc_id, 'relative', [{'x': 0, 'y': 0}, {'x': w, 'y': 0}, {'x': w, 'y': t}, {'x': l, 'y': t}, {'x': l, 'y': h}, {'x': 0, 'y': h}] FROM (SELECT doc_id, page_width - 1.0::DOUBLE AS w, page_height - 1.0::DOUBLE AS h,
 least(page_width - 1, greatest(0, page_width - greatest(1, floor(page_width / 2.5::DOUBLE)))) AS l, least(page_height - 1, greatest(0, page_height - greatest(1, floor(page_height / 8.0::DOUBLE)))) AS t FROM polys))
SELECT doc_id, notch, i - 1 AS i, CAST(polygon[i].x AS DOUBLE) AS x, CAST(polygon[i].y AS DOUBLE) AS y FROM (SELECT *, unnest(range(1, 7)) AS i FROM d)""",
)
def default_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.polygons(spark, sf_dir)
    fixed = p.select("doc_id", F.lit("fixed").alias("notch"), g.default_polygon().alias("polygon"))
    relative = p.select("doc_id", F.lit("relative").alias("notch"), g.default_polygon(F.col("page_width"), F.col("page_height"), "relative").alias("polygon"))
    return v.corners(fixed.unionByName(relative), ["doc_id", "notch"])


@query("scale_polygon", _P + ", d AS (SELECT doc_id, list_transform(polygon, lambda q: {'x': round_even(q.x * ((page_width + 531) / page_width), 0), 'y': round_even(q.y * ((page_height + 689) / page_height), 0)}) AS polygon FROM polys) " + _CORNERS.format("d"))
def scale_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.polygons(spark, sf_dir)
    w, h = F.col("page_width"), F.col("page_height")
    return v.corners(p.select("doc_id", g.rescale(F.col("polygon"), w, h, w + 531, h + 689).alias("polygon")), ["doc_id"])


_VALID = (
    _P
    + f""", k AS (SELECT *, list_transform(polygon, lambda q: {{'x': {_CLAMP_X.format("trunc(q.x)")}, 'y': {_CLAMP_Y.format("trunc(q.y)")}}}) AS kept FROM polys),
d AS (SELECT doc_id, page_width, page_height, CASE WHEN len(polygon) < 3 THEN 'Polygon must contain at least 3 points' WHEN len(list_distinct(kept)) < 3 THEN 'Polygon must contain at least 3 unique points' END AS error, kept FROM k)"""
)


@query("validate_polygon", _VALID + " SELECT doc_id, error, CASE WHEN error IS NULL THEN list_sum(list_transform(kept, lambda q: q.x)) END AS sum_x, CASE WHEN error IS NULL THEN list_sum(list_transform(kept, lambda q: q.y)) END AS sum_y FROM d")
def validate_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.polygons(spark, sf_dir).select("doc_id", g.validated(F.col("polygon"), F.col("page_width"), F.col("page_height")).alias("r"))
    total = lambda k: F.aggregate(F.transform("r.polygon", lambda q: q[k]), F.lit(0.0), lambda a, b: a + b)
    return p.select("doc_id", "r.error", total("x").alias("sum_x"), total("y").alias("sum_y"))


@query("bounding_rect", _VALID + """ SELECT doc_id, greatest(0, list_min(list_transform(kept, lambda q: q.x))) AS "left", greatest(0, list_min(list_transform(kept, lambda q: q.y))) AS top,
 least(page_width, list_max(list_transform(kept, lambda q: q.x)) + 1) AS "right", least(page_height, list_max(list_transform(kept, lambda q: q.y)) + 1) AS bottom FROM d WHERE error IS NULL""")
def bounding_rect(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.polygons(spark, sf_dir).select("*", g.validated(F.col("polygon"), F.col("page_width"), F.col("page_height")).alias("r")).where("r.error is null")
    return p.select("doc_id", g.bounding_rectangle(F.col("r.polygon"), F.col("page_width"), F.col("page_height")).alias("b")).select("doc_id", "b.*")


@query("point_in_polygon", _P + """, e AS (SELECT doc_id, CAST((doc_id * 97) % 6000 AS DOUBLE) AS x, CAST((doc_id * 61) % 7500 AS DOUBLE) AS y, polygon, unnest(range(1, len(polygon) + 1)) AS i FROM polys),
c AS (SELECT doc_id, x, y, polygon[CASE WHEN i = 1 THEN len(polygon) ELSE i - 1 END] AS a, polygon[i] AS b FROM e)
SELECT doc_id, count(*) FILTER (WHERE ((a.y > y) <> (b.y > y)) AND x < (b.x - a.x) * (y - a.y) / (b.y - a.y + 1e-9::DOUBLE) + a.x) % 2 = 1 AS inside FROM c GROUP BY 1""")
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda k, n: ((F.col("doc_id") * k) % n).cast("double")
    return v.polygons(spark, sf_dir).select("doc_id", g.contains(F.col("polygon"), at(97, 6000), at(61, 7500)).alias("inside"))


@query("upgrade_polygon", _P + """, d AS (SELECT doc_id, CASE WHEN len(polygon) = 4 THEN flatten(list_transform(range(1, 5), lambda i: [polygon[i], {'x': (polygon[i].x + polygon[i % 4 + 1].x) / 2, 'y': (polygon[i].y + polygon[i % 4 + 1].y) / 2}])) ELSE polygon END AS polygon FROM polys) """ + _CORNERS.format("d"))
def upgrade_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.corners(v.polygons(spark, sf_dir).select("doc_id", g.eight_points(F.col("polygon")).alias("polygon")), ["doc_id"])


@query("normalize_polygon", _P + f""", b AS (SELECT *, list_min(list_transform(polygon, lambda q: q.x)) AS lx, list_max(list_transform(polygon, lambda q: q.x)) AS hx, list_min(list_transform(polygon, lambda q: q.y)) AS ly, list_max(list_transform(polygon, lambda q: q.y)) AS hy FROM polys),
s AS (SELECT *, CASE WHEN lx < 0 THEN -lx WHEN hx > page_width - 1 THEN page_width - 1 - hx ELSE 0 END AS dx, CASE WHEN ly < 0 THEN -ly WHEN hy > page_height - 1 THEN page_height - 1 - hy ELSE 0 END AS dy FROM b),
d AS (SELECT doc_id, list_transform(polygon, lambda q: {{'x': {_CLAMP_X.format("q.x + dx")}, 'y': {_CLAMP_Y.format("q.y + dy")}}}) AS polygon FROM s) """ + _CORNERS.format("d"))
def normalize_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.corners(v.polygons(spark, sf_dir).select("doc_id", g.back_on_page(F.col("polygon"), F.col("page_width"), F.col("page_height")).alias("polygon")), ["doc_id"])


_FIT = (
    _P
    + """, c AS (SELECT *, 800 + doc_id % 900 AS cw, 10 + doc_id % 1000 AS ch FROM polys),
s AS (SELECT *, least(greatest(1, cw - 16) / page_width, greatest(1, ch - 16) / page_height) AS scale FROM c),
r AS (SELECT *, greatest(1, CAST(round_even(page_width * scale, 0) AS INT)) AS rendered_w, greatest(1, CAST(round_even(page_height * scale, 0) AS INT)) AS rendered_h FROM s),
fit AS (SELECT *, greatest(0, floor((cw - rendered_w) / 2)) AS offset_x, greatest(0, floor((ch - rendered_h) / 2)) AS offset_y FROM r)"""
)


def _fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("doc_id")
    return v.polygons(spark, sf_dir).withColumn("fit", g.fit_canvas(F.col("page_width"), F.col("page_height"), 800 + c % 900, 10 + c % 1000))


@query("fit_canvas", _FIT + " SELECT doc_id, scale, rendered_w, rendered_h, CAST(offset_x AS BIGINT) AS offset_x, CAST(offset_y AS BIGINT) AS offset_y FROM fit")
def fit_canvas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir).select("doc_id", "fit.*")


@query("canvas_polygon", _FIT + """, d AS (SELECT doc_id, list_transform(polygon, lambda q: {'x': q.x * scale + offset_x, 'y': q.y * scale + offset_y}) AS polygon FROM fit) """ + _CORNERS.format("d"))
def canvas_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.corners(_fitted(spark, sf_dir).select("doc_id", g.to_canvas(F.col("polygon"), F.col("fit")).alias("polygon")), ["doc_id"])


@query("flat_polygon", _P + " SELECT doc_id, i - 1 AS i, CASE WHEN i % 2 = 1 THEN polygon[CAST((i + 1) / 2 AS INT)].x ELSE polygon[CAST(i / 2 AS INT)].y END AS v FROM (SELECT *, unnest(range(1, 2 * len(polygon) + 1)) AS i FROM polys)")
def flat_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.polygons(spark, sf_dir).select("doc_id", F.posexplode(g.to_flat(F.col("polygon"))).alias("i", "v")).select("doc_id", F.col("i").cast("long").alias("i"), "v")


@query("handle_hit", _P + " SELECT doc_id, CAST(nullif(list_position(list_transform(polygon, lambda q: abs(q.x - (polygon[2].x + doc_id % 30)) <= 12 AND abs(q.y - (polygon[2].y - 5)) <= 12), true), 0) - 1 AS BIGINT) AS corner FROM polys")
def handle_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.get("polygon", F.lit(1))
    return v.polygons(spark, sf_dir).select("doc_id", g.handle_at(F.col("polygon"), q["x"] + F.col("doc_id") % 30, q["y"] - 5).alias("corner"))


@query("drag_polygon", _P + f""", d AS (SELECT doc_id, list_transform(polygon, lambda q: {{'x': {_CLAMP_X.format("q.x + doc_id % 300 - 100")}, 'y': {_CLAMP_Y.format("q.y + 40.0::DOUBLE")}}}) AS polygon FROM polys) """ + _CORNERS.format("d"))
def drag_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.corners(v.polygons(spark, sf_dir).select("doc_id", g.translated(F.col("polygon"), F.col("doc_id") % 300 - 100, F.lit(40.0), F.col("page_width"), F.col("page_height")).alias("polygon")), ["doc_id"])


@query("drag_corner", _P + f""", d AS (SELECT doc_id, list_transform(polygon, lambda q, i: CASE WHEN i - 1 = doc_id % 3 THEN {{'x': {_CLAMP_X.format("q.x + 25.0::DOUBLE")}, 'y': {_CLAMP_Y.format("q.y - 35.0::DOUBLE")}}} ELSE q END) AS polygon FROM polys) """ + _CORNERS.format("d"))
def drag_corner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.corners(v.polygons(spark, sf_dir).select("doc_id", g.corner_moved(F.col("polygon"), F.col("doc_id") % 3, F.lit(25.0), F.lit(-35.0), F.col("page_width"), F.col("page_height")).alias("polygon")), ["doc_id"])


@query("polygon_save", _P + f""", d AS (SELECT doc_id, list_transform(polygon, lambda q: {{'x': round_even({_CLAMP_X.format("q.x")}, 0), 'y': round_even({_CLAMP_Y.format("q.y")}, 0)}}) AS polygon FROM polys) """ + _CORNERS.format("d"))
def polygon_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.corners(polygons.save(v.polygons(spark, sf_dir)), ["doc_id"])


@query("polygon_patch", _P + f""", d AS (SELECT doc_id, CASE WHEN page_number >= 61 THEN [{", ".join(f"{{'x': {x}.0::DOUBLE, 'y': {y}.0::DOUBLE}}" for x, y in polygons.PATCH)}] ELSE polygon END AS polygon FROM polys) """ + _CORNERS.format("d"))
def polygon_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.corners(polygons.patch(v.polygons(spark, sf_dir)), ["doc_id"])


@query("polygon_upsert", _P + f""", ex AS (SELECT doc_id, CAST(page_width * CASE WHEN doc_id % 3 = 2 THEN 1.1::DOUBLE ELSE 1 END AS BIGINT) AS ow, page_height AS oh, polygon AS op FROM polys WHERE doc_id % 3 <> 0),
pg AS (SELECT doc_id, page_width, page_height FROM polys WHERE doc_id % 10 <> 1),
d AS (SELECT pg.doc_id, CASE WHEN ow IS NULL THEN 'inserted' WHEN ow = page_width AND oh = page_height THEN 'kept' ELSE 'rescaled' END AS action, CASE WHEN ow IS NULL THEN [{", ".join(f"{{'x': {x}.0::DOUBLE, 'y': {y}.0::DOUBLE}}" for x, y in g.DEFAULT_POLYGON)}]
 WHEN ow = page_width AND oh = page_height THEN op ELSE list_transform(op, lambda q: {{'x': round_even(q.x * (page_width / greatest(1, ow)), 0), 'y': round_even(q.y * (page_height / greatest(1, oh)), 0)}}) END AS polygon FROM pg LEFT JOIN ex USING (doc_id)
 UNION ALL SELECT doc_id, 'untouched', op FROM ex WHERE doc_id % 10 = 1)
SELECT doc_id, action, i - 1 AS i, polygon[i].x AS x, polygon[i].y AS y FROM (SELECT *, unnest(range(1, len(polygon) + 1)) AS i FROM d)""")
def polygon_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.polygons(spark, sf_dir).drop("page_number")
    wider = F.bround(F.col("page_width") * F.when(F.col("doc_id") % 3 == 2, F.lit(1.1)).otherwise(F.lit(1.0))).cast("long")
    existing = p.where("doc_id % 3 <> 0").withColumn("page_width", wider)
    return v.corners(polygons.upsert(p.where("doc_id % 10 <> 1").drop("polygon"), existing, ["doc_id"]), ["doc_id", "action"])


# Files and pages

_F = "WITH files AS (SELECT DISTINCT coalesce(source, 'none') || '_' || doc_id || ['.pdf', '.PDF', '.docx'][doc_id % 3 + 1] AS name, coalesce(source, 'none') AS folder FROM documents)"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.get(F.array(F.lit(".pdf"), F.lit(".PDF"), F.lit(".docx")), (F.col("doc_id") % 3).cast("int"))
    return table(spark, sf_dir, "documents").select(F.concat(F.coalesce("source", F.lit("none")), F.lit("_"), F.col("doc_id").cast("string"), suffix).alias("name"), F.coalesce("source", F.lit("none")).alias("folder")).distinct()


_EXCLUDE = ["quillmere_letters_3.pdf", "lumcombe_letters_948.pdf"]
_WANTED = [("lumcombe_letters_948.pdf", 1), ("veldstow_testimony_156.pdf", 2), ("nowhere.pdf", 3), ("pellgarth_notebooks_731.PDF", 4)]
_WANTED_SQL = "(VALUES " + ", ".join(f"('{n}', {i})" for n, i in _WANTED) + ") w(name, ordinal)"


@query("select_files", _F + " SELECT name FROM files WHERE lower(name) LIKE '%.pdf' AND name NOT IN (" + ", ".join(f"'{x}'" for x in _EXCLUDE) + ")")
def select_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.select_files(_files(spark, sf_dir), exclude=_EXCLUDE).select("name")


@query("select_files_ordered", _F + f" SELECT w.ordinal, w.name FROM files JOIN {_WANTED_SQL} USING (name) WHERE lower(name) LIKE '%.pdf'")
def select_files_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.select_files_ordered(_files(spark, sf_dir), spark.createDataFrame(_WANTED, "name string, ordinal int"))


@query("missing_files", _F + f" SELECT w.name, w.ordinal FROM {_WANTED_SQL} WHERE name NOT IN (SELECT name FROM files)")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.missing_files(_files(spark, sf_dir), spark.createDataFrame(_WANTED, "name string, ordinal int"))


@query("discover_pages", r"SELECT DISTINCT file_path AS path, regexp_extract(file_path, '([^/]+)/([^/]+)/[^/]+$', 1) AS document, regexp_extract(file_path, '([^/]+)/([^/]+)/[^/]+$', 2) AS page_folder, CAST(regexp_extract(file_path, '/page-(\d+)/[^/]+$', 1) AS BIGINT) AS page_number FROM ocr_reads WHERE regexp_matches(file_path, '/page-\d+/[^/]+$') AND NOT regexp_extract(file_path, '([^/]+)/([^/]+)/[^/]+$', 1) LIKE '\_analysis%' ESCAPE '\'")
def discover_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.documents_of(table(spark, sf_dir, "ocr_reads").select(F.col("file_path").alias("path"))).distinct()


@query("pages_with_pdf", "SELECT DISTINCT source_document, page_number FROM ocr_words w WHERE EXISTS (SELECT 1 FROM error_entries e WHERE e.source_document = w.source_document AND e.page_number = w.page_number)")
def pages_with_pdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    has = table(spark, sf_dir, "error_entries").select("source_document", "page_number").distinct()
    return table(spark, sf_dir, "ocr_words").select("source_document", "page_number").distinct().join(has, ["source_document", "page_number"], "left_semi")


@query("page_counts", r"""WITH f AS (SELECT DISTINCT regexp_extract(file_path, '^([^/]+)/', 1) AS folder, TRY_CAST(regexp_extract(file_path, 'page_(\d+)\.json$', 1) AS INT) AS n FROM page_size_files WHERE file_path IS NOT NULL)
SELECT folder, count(n) AS pages, max(n) AS last_page FROM f GROUP BY 1""")
def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "page_size_files").where("file_path is not null").select(F.regexp_extract("file_path", "^([^/]+)/", 1).alias("folder"), text.page_of_file(F.col("file_path")).alias("n")).distinct()
    return f.groupBy("folder").agg(F.count("n").alias("pages"), F.max("n").alias("last_page"))


_S = "WITH " + v.SCOPES_SQL + ", r AS (SELECT *, coalesce(s0, 1) AS s, coalesce(e0, total) AS e FROM scopes)"
_COLLAPSED = _S + ", c AS (SELECT *, greatest(1, least(s, e)) AS lo FROM r), k AS (SELECT *, least(total, greatest(lo, e)) AS hi FROM c)"


@query("target_pages", _S + " SELECT DISTINCT doc_id, unnest(CASE WHEN len(targets) = 0 THEN range(1, total + 1) ELSE list_filter(targets, lambda p: p >= 1 AND p <= total) END) AS page FROM r")
def target_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.scopes(spark, sf_dir).select("doc_id", F.explode(pages.target_pages(F.col("total"), F.col("targets"))).alias("page"))


@query("page_scope_swap", _S + " SELECT doc_id, unnest(range(greatest(1, least(s, e)), least(total, greatest(s, e)) + 1)) AS page FROM r")
def page_scope_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.scopes(spark, sf_dir).select("doc_id", F.explode(pages.scope_swapped(F.col("total"), F.col("s0"), F.col("e0"))).alias("page"))


@query("page_scope_collapse", _COLLAPSED + " SELECT doc_id, unnest(range(lo, hi + 1)) AS page FROM k")
def page_scope_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.scopes(spark, sf_dir).select("doc_id", F.explode(pages.scope_collapsed(F.col("total"), F.col("s0"), F.col("e0"))).alias("page"))


@query("pages_to_process", _COLLAPSED + ", t AS (SELECT *, list_filter(targets, lambda p: p >= 1 AND p <= total) AS valid FROM k), u AS (SELECT doc_id, unnest(range(lo, hi + 1)) AS page, valid FROM t) SELECT doc_id, page FROM u WHERE len(valid) = 0 OR list_contains(valid, page)")
def pages_to_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.scopes(spark, sf_dir).select("doc_id", F.explode(pages.pages_to_process(F.col("total"), F.col("s0"), F.col("e0"), F.col("targets"))).alias("page"))


@query("page_chunks", "WITH " + v.SCOPES_SQL + """, p AS (SELECT doc_id, unnest(range(1, total + 1)) AS page FROM scopes), q AS (SELECT * FROM p WHERE (page * 7 + doc_id) % 5 <> 0),
i AS (SELECT *, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS island FROM q), j AS (SELECT *, floor((row_number() OVER (PARTITION BY doc_id, island ORDER BY page) - 1) / 3) AS part FROM i)
SELECT doc_id, page, dense_rank() OVER (PARTITION BY doc_id ORDER BY island, part) - 1 AS chunk FROM j""")
def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.scopes(spark, sf_dir).select("doc_id", F.explode(F.sequence(F.lit(1), F.col("total"))).alias("page")).where((F.col("page") * 7 + F.col("doc_id")) % 5 != 0)
    return pages.chunks(p, ["doc_id"], size=3).select("doc_id", "page", F.col("chunk").cast("long").alias("chunk"))


def _planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = v.scopes(spark, sf_dir).withColumns({"scope": pages.scope_swapped(F.col("total"), F.col("s0"), F.col("e0")), "aim": pages.target_pages(F.col("total"), F.col("targets"))})
    p = s.select("doc_id", "scope", "aim", F.explode(F.sequence(F.lit(1), F.col("total"))).alias("page"))
    c = F.col("page") * 7 + F.col("doc_id")
    return pages.plan(p.select("doc_id", "page", F.array_contains("aim", F.col("page")).alias("is_target"), F.array_contains("scope", F.col("page")).alias("in_scope"), (c % 5 != 0).alias("exists"), (c % 31 == 0).alias("failed"), (c % 37 == 0).alias("failed_chunk")))


_PLAN = (
    _S
    + """, p AS (SELECT *, unnest(range(1, total + 1)) AS page FROM r),
q AS (SELECT doc_id, page, (len(targets) = 0 OR list_contains(targets, page)) AS is_target, page BETWEEN greatest(1, least(s, e)) AND least(total, greatest(s, e)) AS in_scope, (page * 7 + doc_id) % 5 <> 0 AS has, (page * 7 + doc_id) % 31 = 0 OR (page * 7 + doc_id) % 37 = 0 AS lost FROM p),
pl AS (SELECT *, CASE WHEN in_scope AND (is_target OR NOT has) THEN 'render' WHEN has THEN 'reuse' ELSE 'missing' END AS action FROM q),
per AS (SELECT doc_id, count(*) FILTER (WHERE action = 'reuse' OR (action = 'render' AND NOT lost)) AS done, count(*) FILTER (WHERE action = 'missing' OR (action = 'render' AND lost)) AS missing,
 list_sort(list(page) FILTER (WHERE action = 'missing' OR (action = 'render' AND lost)))[1:12] AS first FROM pl GROUP BY 1),
gate AS (SELECT doc_id, done, missing, CASE WHEN done = 0 THEN 'failed' WHEN missing > 0 THEN 'not_merged' ELSE 'merged' END AS status, coalesce(array_to_string(first, ', '), '') || CASE WHEN missing > 12 THEN ' ...' ELSE '' END AS missing_pages FROM per)"""
)


@query("page_plan", _PLAN + " SELECT doc_id, page, action FROM pl")
def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _planned(spark, sf_dir).select("doc_id", "page", "action")


@query("merge_gate", _PLAN + " SELECT * FROM gate")
def merge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.merge_gate(_planned(spark, sf_dir), "doc_id")


@query("run_summary", _PLAN + " SELECT count(*) AS processed, count(*) FILTER (WHERE status <> 'failed') AS succeeded, count(*) FILTER (WHERE status = 'failed') AS failed FROM gate")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.run_summary(pages.merge_gate(_planned(spark, sf_dir), "doc_id"))


# Labels

_L = "WITH " + v.LABELS_SQL
_DECLARED = _L + ", dec AS (SELECT * FROM lab WHERE doc_idx <= num_documents)"
_BY = ["doc_id"]


def _label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.rows(v.label_pages(spark, sf_dir), _BY)


@query("label_rows", _DECLARED + " SELECT doc_id, 'doc_' || doc_idx AS doc_key, info_type, poly_idx, len(polygon) AS corners, list_sum(list_transform(polygon, lambda q: q.x + q.y)) AS total FROM dec")
def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.aggregate(F.transform("polygon", lambda q: q["x"] + q["y"]), F.lit(0.0), lambda a, b: a + b)
    return _label_rows(spark, sf_dir).select(*_BY, "doc_key", "info_type", F.col("poly_idx").cast("long").alias("poly_idx"), F.size("polygon").alias("corners"), total.alias("total"))


@query("label_counts", _DECLARED + " SELECT doc_id, 'doc_' || doc_idx AS doc_key, info_type, count(*) AS polygons FROM dec GROUP BY ALL")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_rows(spark, sf_dir).groupBy(*_BY, "doc_key", "info_type").agg(F.count("*").alias("polygons"))


_ARTIFACTS = ", ".join(f"('{x}')" for x in [*m.INFO_TYPES, *labels.ARTIFACT_EXTRA])


@query("label_manifest", _DECLARED + f", k AS (SELECT DISTINCT doc_id, doc_idx FROM dec WHERE len(polygon) >= 3) SELECT doc_id, 'doc_' || doc_idx AS doc_key, artifact FROM k, (VALUES {_ARTIFACTS}) a(artifact)")
def label_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.manifest(_label_rows(spark, sf_dir), _BY)


@query("label_page_summary", _DECLARED + ", k AS (SELECT doc_id, count(DISTINCT doc_idx) AS written FROM dec WHERE len(polygon) >= 3 GROUP BY 1), a AS (SELECT DISTINCT doc_id, num_documents FROM lab) SELECT doc_id, num_documents, coalesce(written, 0) AS written FROM a LEFT JOIN k USING (doc_id)")
def label_page_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.label_pages(spark, sf_dir)
    written = labels.rows(p, _BY).where(F.size("polygon") >= 3).groupBy("doc_id").agg(F.countDistinct("doc_key").alias("written"))
    return p.select("doc_id", "num_documents").join(written, "doc_id", "left").select("doc_id", "num_documents", F.coalesce("written", F.lit(0)).alias("written"))


@query("label_export", _DECLARED + " SELECT doc_id, 'doc_' || doc_idx AS doc_key, info_type, count(*) AS polygons, CAST(sum(len(polygon)) AS BIGINT) AS corners FROM dec GROUP BY ALL")
def label_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = labels.export(_label_rows(spark, sf_dir), _BY).select("doc_id", "doc_key", F.explode("polygons").alias("info_type", "p"))
    return e.select("doc_id", "doc_key", "info_type", F.size("p").cast("long").alias("polygons"), F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + F.size(x)).alias("corners"))


@query("label_unified", _DECLARED + " SELECT doc_id, 'doc_' || doc_idx AS doc_key, count(*) AS polygons FROM dec WHERE len(polygon) >= 3 GROUP BY ALL")
def label_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_rows(spark, sf_dir).where(F.size("polygon") >= 3).groupBy(*_BY, "doc_key").agg(F.count("*").alias("polygons"))


_OLD = {new: old for old, new in m.LEGACY.items()}


def _renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label pages of even number with the old names of types."""
    old = F.create_map(*[F.lit(x) for kv in _OLD.items() for x in kv])
    return v.label_pages(spark, sf_dir).withColumn("documents", F.when(F.col("doc_id") % 2 == 0, F.transform_values("documents", lambda _, r: F.transform_keys(r, lambda k, _: F.coalesce(old[k], k)))).otherwise(F.col("documents")))


@query(
    "label_legacy",
    _L + f""", n AS (SELECT doc_id, doc_idx, info_type, count(*) AS n FROM lab GROUP BY ALL), d AS (SELECT DISTINCT doc_id, doc_idx FROM lab),
allt AS (SELECT d.doc_id, d.doc_idx, t.info_type, coalesce(n.n, 0) AS polygons FROM d CROSS JOIN (SELECT unnest([{v.NAMES}]) AS info_type) t LEFT JOIN n USING (doc_id, doc_idx, info_type)),
old AS (SELECT doc_id, doc_idx, MAP {{{", ".join(f"'{new}': '{o}'" for new, o in _OLD.items())}}}[info_type] AS info_type, n AS polygons FROM n WHERE doc_id % 2 = 0)
SELECT doc_id, 'doc_' || doc_idx AS doc_key, info_type, polygons FROM (SELECT * FROM allt UNION ALL SELECT * FROM old WHERE info_type IS NOT NULL)""",
)
def label_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _renamed(spark, sf_dir).select("doc_id", F.explode(labels.on_load(F.col("documents"))).alias("doc_key", "r"))
    return loaded.select("doc_id", "doc_key", F.explode("r").alias("info_type", "p")).select("doc_id", "doc_key", "info_type", F.size("p").cast("long").alias("polygons"))


@query("label_prune", _L + " SELECT DISTINCT doc_id, 'doc_' || doc_idx AS doc_key FROM lab WHERE doc_idx <= CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN num_documents ELSE 20 END")
def label_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = F.get(F.array(F.lit("0"), F.lit(" 2 "), F.lit("two"), F.lit("99")), (F.col("doc_id") % 4).cast("int"))
    n = m.number_of_documents(typed, F.col("num_documents").cast("int"))
    return v.label_pages(spark, sf_dir).select("doc_id", F.explode(F.map_keys(labels.on_save(F.col("documents"), n))).alias("doc_key"))


@query("label_fill", _L + ", d AS (SELECT DISTINCT doc_id, doc_idx FROM lab UNION SELECT DISTINCT doc_id, unnest(range(1, 6)) FROM lab) SELECT doc_id, 'doc_' || doc_idx AS doc_key FROM d")
def label_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.label_pages(spark, sf_dir).select("doc_id", F.explode(F.map_keys(m.with_all_documents(F.col("documents"), F.lit(5)))).alias("doc_key"))


@query("label_seed", _P + """, d AS (SELECT doc_id, CASE WHEN doc_id % 4 <> 1 THEN page_width END AS page_width, CASE WHEN doc_id % 5 <> 2 AND len(polygon) >= 3 THEN polygon END AS polygon FROM polys WHERE doc_id % 3 <> 0)
SELECT doc_id, page_width, 1 AS num_documents, CASE WHEN polygon IS NULL THEN 0 ELSE 1 END AS seeded, list_sum(list_transform(polygon, lambda q: trunc(q.x))) AS sum_x FROM d""")
def label_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.polygons(spark, sf_dir)
    made = labels.seed(p.select("doc_id"), p.where("doc_id % 3 = 0").select("doc_id"), p.where("doc_id % 5 <> 2"), p.where("doc_id % 4 <> 1"), _BY)
    first = F.col("documents")["doc_1"]["src_content"]
    return made.select("doc_id", "page_width", "num_documents", F.size(first).alias("seeded"), F.aggregate(F.transform(F.get(first, F.lit(0)), lambda q: q["x"]), F.lit(0.0), lambda a, b: a + b).alias("sum_x"))


@query("label_current", _L + ", d AS (SELECT DISTINCT doc_id, num_documents FROM lab) SELECT doc_id, CASE WHEN doc_id % 5 BETWEEN 1 AND num_documents THEN 'doc_' || doc_id % 5 ELSE 'doc_1' END AS doc_key, " + f"CASE WHEN doc_id % 11 BETWEEN 1 AND 8 THEN ([{v.NAMES}])[doc_id % 11] END AS info_type FROM d")
def label_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("doc_id")
    return v.label_pages(spark, sf_dir).select("doc_id", labels.current_document(F.concat(F.lit("doc_"), (c % 5).cast("string")), F.col("num_documents")).alias("doc_key"), labels.type_of_key((c % 11).cast("int")).alias("info_type"))


_COLORS = "MAP {" + ", ".join(f"'{k}': '{c}'" for k, c in m.COLORS.items()) + "}"


@query("label_style", _DECLARED + f""" SELECT doc_id, 'doc_' || doc_idx AS doc_key, info_type, poly_idx, replace(info_type, '_', ' ') AS shown, CASE WHEN type_idx = doc_id % 8 THEN 'gray50' ELSE 'gray25' END AS stipple,
 CASE WHEN type_idx = doc_id % 8 AND poly_idx = 0 THEN 'white' WHEN type_idx = doc_id % 8 THEN {_COLORS}[info_type] ELSE '#555555' END AS outline, CASE WHEN type_idx = doc_id % 8 AND poly_idx = 0 THEN 3 WHEN type_idx = doc_id % 8 THEN 2 ELSE 1 END AS width FROM dec WHERE len(polygon) >= 3""")
def label_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = F.col("info_type") == F.get(F.array(*[F.lit(t) for t in m.INFO_TYPES]), (F.col("doc_id") % 8).cast("int"))
    r = _label_rows(spark, sf_dir).where(F.size("polygon") >= 3)
    return r.select("doc_id", "doc_key", "info_type", F.col("poly_idx").cast("long").alias("poly_idx"), text.display(F.col("info_type")).alias("shown"), labels.style(active, F.col("poly_idx") == 0, m.color(F.col("info_type"))).alias("s")).select("doc_id", "doc_key", "info_type", "poly_idx", "shown", "s.*")


@query("label_edit", _DECLARED + " SELECT doc_id, 'doc_' || doc_idx AS doc_key, info_type, count(*) - count(*) FILTER (WHERE poly_idx = 0) AS after_delete, count(*) + max(CASE WHEN len(polygon) >= 3 AND poly_idx = 0 THEN 1 ELSE 0 END) AS after_close FROM dec GROUP BY ALL")
def label_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of polygons after the first is deleted, and after one like it is drawn and closed."""
    p = v.label_pages(spark, sf_dir)
    docs = labels.rows(p, _BY).groupBy(*_BY, "doc_key", "info_type").agg(F.array_sort(F.collect_list(F.struct("poly_idx", "polygon"))).alias("at")).withColumn("p", F.col("at.polygon"))
    drawn = labels.closed(F.get("p", F.lit(0)))
    added = F.when(drawn.isNotNull(), F.array_append("p", drawn)).otherwise(F.col("p"))
    return docs.select(*_BY, "doc_key", "info_type", F.size(labels.without_polygon(F.col("p"), F.lit(0))).cast("long").alias("after_delete"), F.size(added).cast("long").alias("after_close"))


_HIT = _DECLARED + """, k AS (SELECT doc_id, doc_idx, min(info_type) AS cur, arg_min(polygon, {'t': info_type, 'p': poly_idx}) AS p FROM dec WHERE len(polygon) >= 3 GROUP BY 1, 2),
c AS (SELECT doc_id, doc_idx, cur, list_sum(list_transform(p, lambda q: q.x)) / len(p) AS x, list_sum(list_transform(p, lambda q: q.y)) / len(p) AS y, CASE WHEN doc_id % 2 = 0 THEN 0 END AS selected FROM k),
b AS (SELECT c.*, info_type, type_idx, poly_idx, len(polygon) AS n, info_type = cur AS mine, coalesce(info_type = cur AND poly_idx = selected, false) AS chosen,
 list_position(list_transform(polygon, lambda q: abs(q.x - x) <= 14 AND abs(q.y - y) <= 14), true) AS pos,
 len(list_filter(range(1, len(polygon) + 1), lambda i: ((polygon[CASE WHEN i = 1 THEN len(polygon) ELSE i - 1 END].y > y) <> (polygon[i].y > y))
  AND x < (polygon[i].x - polygon[CASE WHEN i = 1 THEN len(polygon) ELSE i - 1 END].x) * (y - polygon[CASE WHEN i = 1 THEN len(polygon) ELSE i - 1 END].y)
   / (polygon[i].y - polygon[CASE WHEN i = 1 THEN len(polygon) ELSE i - 1 END].y + 1e-9::DOUBLE) + polygon[CASE WHEN i = 1 THEN len(polygon) ELSE i - 1 END].x)) % 2 = 1 AS inside
 FROM c JOIN dec USING (doc_id, doc_idx)),
r AS (SELECT *, CASE WHEN chosen AND pos > 0 THEN 1 WHEN chosen AND inside THEN 2 WHEN mine AND inside AND n >= 3 THEN 3 WHEN inside AND n >= 3 THEN 4 END AS "rank" FROM b),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, doc_idx ORDER BY "rank", type_idx, poly_idx) AS k FROM r WHERE "rank" IS NOT NULL)
SELECT c.doc_id, 'doc_' || c.doc_idx AS doc_key, c.x, c.y, CAST("rank" AS BIGINT) AS "rank", info_type, poly_idx, CAST(CASE WHEN "rank" = 1 THEN pos - 1 END AS BIGINT) AS corner
 FROM c LEFT JOIN best ON c.doc_id = best.doc_id AND c.doc_idx = best.doc_idx AND best.k = 1"""


@query("label_hit", _HIT)
def label_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _label_rows(spark, sf_dir)
    first = rows.where(F.size("polygon") >= 3).groupBy("doc_id", "doc_key").agg(F.min_by("polygon", F.struct("info_type", "poly_idx")).alias("p"), F.min("info_type").alias("info_type"))
    mean = lambda k: F.aggregate(F.transform("p", lambda q: q[k]), F.lit(0.0), lambda a, b: a + b) / F.size("p")
    clicks = first.select("doc_id", "doc_key", mean("x").alias("x"), mean("y").alias("y"), "info_type", F.when(F.col("doc_id") % 2 == 0, F.lit(0)).alias("selected"))
    return labels.hit(rows, clicks, _BY)


# Images

_I = "WITH " + v.IMAGES_SQL
_PIXELS = "SELECT image_id, i - 1 AS i, image[i] AS v FROM (SELECT *, unnest(range(1, len(image) + 1)) AS i FROM {0})"


def _pixels(df: DataFrame) -> DataFrame:
    return df.select("image_id", F.posexplode("image").alias("i", "v")).select("image_id", F.col("i").cast("long").alias("i"), "v")


@query("img_gray", _I + ", d AS (SELECT image_id, list_transform(image, lambda p, k: CAST(round_even(p * 0.114::DOUBLE + image[k % 64 + 1] * 0.587::DOUBLE + image[(k + 1) % 64 + 1] * 0.299::DOUBLE, 0) AS INT)) AS image FROM img) " + _PIXELS.format("d"))
def img_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = lambda n: F.concat(F.slice("image", n + 1, 64 - n), F.slice("image", 1, n))
    return _pixels(v.images(spark, sf_dir).select("image_id", raster.gray(F.col("image"), turned(1), turned(2)).alias("image")))


@query("img_median3", _I + """, p AS (SELECT image_id, image, unnest(range(64)) AS i FROM img), q AS (SELECT image_id, i, list_sort(list_transform(range(9), lambda k: image[least(7, greatest(0, CAST(floor(i / 8) AS INT) + CAST(floor(k / 3) AS INT) - 1)) * 8 + least(7, greatest(0, i % 8 + k % 3 - 1)) + 1]))[5] AS v FROM p) SELECT image_id, i, v FROM q""")
def img_median3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(raster.median3(v.images(spark, sf_dir), "image_id", 8, 8))


@query("img_contrast", _I + ", d AS (SELECT image_id, list_transform(image, lambda p: CAST(least(255, round_even(abs(p * 1.5::DOUBLE - 100), 0)) AS INT)) AS image FROM img) " + _PIXELS.format("d"))
def img_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(v.images(spark, sf_dir).select("image_id", raster.contrast(F.col("image")).alias("image")))


@query("img_crop", _I + ", d AS (SELECT image_id, flatten(list_transform(range(2, 6), lambda y: image[y * 8 + 2:y * 8 + 5])) AS image FROM img) " + _PIXELS.format("d"))
def img_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(v.images(spark, sf_dir).select("image_id", raster.cropped(F.col("image"), 8, F.lit(1), F.lit(2), F.lit(5), F.lit(6)).alias("image")))


_KERNEL = "[" + ", ".join(f"{k!r}::DOUBLE" for k in raster.gaussian(raster.BLOCK).tolist()) + "]"
_AT = "least(7, greatest(0, {0} + j - 15))"


@query("img_threshold", _I + f""", p AS (SELECT image_id, image, unnest(range(64)) AS i FROM img),
h AS (SELECT image_id, i, image[i + 1] AS v, list_sum(list_transform(range(31), lambda j: ({_KERNEL})[j + 1] * image[CAST(floor(i / 8) AS INT) * 8 + {_AT.format("i % 8")} + 1])) AS m FROM p),
r AS (SELECT image_id, list(m ORDER BY i) AS m FROM h GROUP BY 1),
s AS (SELECT h.image_id, i, v, list_sum(list_transform(range(31), lambda j: ({_KERNEL})[j + 1] * r.m[{_AT.format("CAST(floor(i / 8) AS INT)")} * 8 + i % 8 + 1])) AS mean FROM h JOIN r ON h.image_id = r.image_id)
SELECT image_id, i, CASE WHEN v > round_even(mean, 0) - 10 THEN 255 ELSE 0 END AS v FROM s""")
def img_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(raster.binarise(v.images(spark, sf_dir), "image_id", 8, 8))


@query("img_clean")
def img_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain on colour images, deskew included."""
    colour = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.array(*[F.get("image", (i + k) % 64) for k in range(3)])))
    return _pixels(raster.clean(v.images(spark, sf_dir).select("image_id", colour.alias("image")), "image_id", 8, 8, turn=True))


@query("mask_composite", _I + """, p AS (SELECT image_id, image, unnest(range(64)) AS i FROM img)
SELECT image_id, i, CASE WHEN (i % 8 BETWEEN 1 AND 5 AND floor(i / 8) BETWEEN 2 AND 6) OR (i % 8 >= 6 AND floor(i / 8) <= 1) THEN image[i + 1] ELSE 255 END AS v FROM p""")
def mask_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = [(1.9, 2.0, 5.0, 2.5, 5.9, 6.0, 1.0, 6.0), (6.0, 0.0, 7.0, 0.0, 7.0, 1.0, 6.0, 1.0), (0.0, 0.0, 3.0, 3.0)]
    polygons = F.array(*[F.array(*map(F.lit, b)) for b in boxes])
    return _pixels(raster.mask(v.images(spark, sf_dir).withColumn("polygons", polygons), "image_id", 8, 8))


@query("label_created", """WITH p AS (SELECT doc_id % 20 AS document, doc_id, doc_id % 3 = 0 AS has FROM documents)
SELECT document, count(*) FILTER (WHERE NOT has) AS created, count(*) FILTER (WHERE has) AS skipped FROM p GROUP BY 1""")
def label_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label pages made and left alone, for each document."""
    p = table(spark, sf_dir, "documents").select((F.col("doc_id") % 20).alias("document"), "doc_id")
    return labels.created(p, p.where("doc_id % 3 = 0"), ["doc_id"], "document")


@query("polygon_load", """SELECT doc_id, doc_id % 3 <> 0 AS found, CASE WHEN doc_id % 3 = 0 THEN 'no polygon record' END AS failure FROM documents""")
def polygon_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their polygon record; one without a record fails alone."""
    p = v.polygons(spark, sf_dir)
    return polygons.load(p.select("doc_id"), p.where("doc_id % 3 <> 0"), ["doc_id"]).select("doc_id", "found", "failure")


@query("deskew_decision", "WITH d AS (SELECT doc_id, (doc_id * 131) % 3000 AS n, CAST((doc_id * 7) % 900 AS DOUBLE) / 10 - 90 AS a FROM documents), t AS (SELECT *, CASE WHEN a < -45 THEN -(a + 90) ELSE -a END AS angle FROM d) SELECT doc_id, CASE WHEN n < 1000 THEN 'sparse' WHEN abs(angle) > 15 THEN 'too_steep' WHEN abs(angle) < 1 THEN 'straight' ELSE 'rotate' END AS decision, angle FROM t")
def deskew_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", raster.deskew_decision((c * 131) % 3000, ((c * 7) % 900).cast("double") / 10 - 90).alias("d")).select("doc_id", "d.*")
