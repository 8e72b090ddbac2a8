"""Queries on words, lines, errors and corrections, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumry.functions import geometry as g
from vellumry.functions import text
from vellumry.operators import corrections as co
from vellumry.operators import errors as er
from vellumry.operators import lines as ln
from vellumry.operators import shred
from vellumry.sources import sinks
from vellumry.scale import table

_WORDS = """
w AS (SELECT *, row_number() OVER (PARTITION BY source_document, page_number ORDER BY line_number, word_number) - 1 AS seq FROM (
 SELECT DISTINCT source_document, page_number, line_number, word_number, content, confidence, span_offset, span_length, x0, y0, x1, y1 FROM ocr_words
 WHERE source_document IS NOT NULL AND page_number IS NOT NULL AND line_number IS NOT NULL AND word_number IS NOT NULL AND x0 IS NOT NULL AND y0 IS NOT NULL AND x1 IS NOT NULL AND y1 IS NOT NULL))"""
_LINED = (
    _WORDS
    + """,
s AS (SELECT source_document, page_number, seq, (y0 + y1) / 2 AS yc, row_number() OVER (PARTITION BY source_document, page_number ORDER BY (y0 + y1) / 2, (x0 + x1) / 2, seq) AS rn FROM w),
f AS (SELECT source_document, page_number, seq, rn, yc AS mean, CAST(1 AS BIGINT) AS n, CAST(1 AS BIGINT) AS line FROM s WHERE rn = 1 UNION ALL
 SELECT s.source_document, s.page_number, s.seq, s.rn, CASE WHEN abs(s.yc - f.mean) <= CAST(0.12 AS DOUBLE) THEN (f.mean * f.n + s.yc) / (f.n + 1) ELSE s.yc END,
 CASE WHEN abs(s.yc - f.mean) <= CAST(0.12 AS DOUBLE) THEN f.n + 1 ELSE 1 END, CASE WHEN abs(s.yc - f.mean) <= CAST(0.12 AS DOUBLE) THEN f.line ELSE f.line + 1 END
 FROM f JOIN s ON s.source_document = f.source_document AND s.page_number = f.page_number AND s.rn = f.rn + 1),
lined AS (SELECT w.*, f.line, row_number() OVER (PARTITION BY w.source_document, w.page_number, f.line ORDER BY (x0 + x1) / 2, (y0 + y1) / 2, w.seq) AS pos FROM w JOIN f USING (source_document, page_number, seq)),
ctx AS (SELECT source_document, page_number, line, string_agg(content, ' ' ORDER BY pos) AS line_text, min(x0) AS ctx_x0, min(y0) AS ctx_y0, max(x1) AS ctx_x1, max(y1) AS ctx_y1, count(*) AS words FROM lined GROUP BY 1, 2, 3)"""
)
_HOT = "MAP {" + ", ".join(f"'{k.replace(chr(39), chr(39) * 2)}': '{v}'" for k, v in er.HOTWORDS.items()) + "}"
_HOTS = ", ".join(f"'{k.lower().replace(chr(39), chr(39) * 2)}'" for k in er.HOTWORDS)
_RULES = (
    _LINED
    + f""",
med AS (SELECT source_document, page_number, list_sort(list(y1 - y0))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median_height FROM w GROUP BY 1, 2),
r AS (SELECT lined.*, median_height, unnest([{{'rank': 0, 'kind': CASE WHEN confidence < CAST(0.9 AS DOUBLE) THEN 'low_confidence' END}},
 {{'rank': 1, 'kind': CASE WHEN content LIKE '%-' AND length(content) >= 2 THEN 'hyphenated_word' END}},
 {{'rank': 2, 'kind': CASE WHEN (y1 - y0) < CAST(0.65 AS DOUBLE) * median_height THEN 'small_token' END}},
 {{'rank': 3, 'kind': CASE WHEN lower(content) IN ({_HOTS}) THEN 'hotword_' || coalesce({_HOT}[content], {_HOT}[upper(content)], {_HOT}[lower(content)], 'general') END}}]) AS hit
 FROM lined JOIN med USING (source_document, page_number)),
flagged AS (SELECT *, hit['rank'] AS rule_rank, hit['kind'] AS error_type FROM r WHERE hit['kind'] IS NOT NULL),
bases AS (SELECT *, coalesce(sum(length(line_text) + 1) OVER (PARTITION BY source_document, page_number ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM ctx),
pats AS (SELECT * FROM (VALUES (4, 'ellipsis_3', '...'), (5, 'ellipsis_2', '..'), (6, 'quote_straight', '"'), (7, 'equals_sign', '=')) t(rule_rank, error_type, error)),
parts AS (SELECT bases.*, pats.rule_rank, pats.error_type, pats.error, string_split(line_text, pats.error) AS p FROM bases, pats WHERE contains(line_text, pats.error)),
found AS (SELECT *, unnest(range(1, len(p))) AS i FROM parts),
matches AS (SELECT *, base + list_sum(list_transform(p[1:i], lambda x: length(x))) + (i - 1) * length(error) AS character_number FROM found)"""
)
_ERRORS = (
    "WITH RECURSIVE "
    + _RULES
    + """,
e AS (SELECT error_type, source_document, page_number, line AS line_number, pos AS word_number, span_offset AS character_number, line_text, content AS error, ctx_x0, ctx_y0, ctx_x1, ctx_y1, x0 AS err_x0, y0 AS err_y0, x1 AS err_x1, y1 AS err_y1, rule_rank, seq AS in_rule
 FROM flagged JOIN ctx USING (source_document, page_number, line) UNION ALL
 SELECT error_type, source_document, page_number, line, -1, character_number, line_text, error, ctx_x0, ctx_y0, ctx_x1, ctx_y1, ctx_x0, ctx_y0, ctx_x1, ctx_y1, rule_rank, character_number FROM matches)
"""
)


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.distinct_words(table(spark, sf_dir, "ocr_words"))


def _lined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.group_lines(table(spark, sf_dir, "ocr_words"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lined(spark, sf_dir).select(*ln.PAGE, "seq", "line", "pos", "content")


def line_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.line_context(_lined(spark, sf_dir))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = ln.line_context(_lined(spark, sf_dir))
    return ctx.groupBy(*ln.PAGE).agg(text.join_ordered(F.collect_list(F.struct("line", "line_text")), "line_text", "\n").alias("page_text"))


def _flag(rank: int) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        hits = er.flag_words(er.line_hits(_lined(spark, sf_dir), [r for r in er.word_rules() if r.rank == rank]))
        return hits.select("error_type", *ln.PAGE, F.col("line").alias("line_number"), F.col("pos").alias("word_number"), F.col("span_offset").alias("character_number"), "line_text", F.col("content").alias("error"), "ctx_x0", "ctx_y0", "ctx_x1", "ctx_y1")

    return run


def flag_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.flag_patterns(ln.line_context(_lined(spark, sf_dir))).select("error_type", *ln.PAGE, F.col("line").alias("line_number"), "character_number", "error", "line_text")


def errors_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.errors_all(table(spark, sf_dir, "ocr_words"))


def errors_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.error_rows(table(spark, sf_dir, "ocr_words")).groupBy("source_document").agg(F.count("*").alias("errors"))


def errors_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.error_rows(table(spark, sf_dir, "ocr_words")).groupBy("error_type").agg(F.count("*").alias("errors"))


def errors_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The errors of each page as a JSON list; ``sinks.write_error_file`` puts the lists of a document or of all into one file."""
    return sinks.error_pieces(er.error_rows(table(spark, sf_dir, "ocr_words")), ["error_type", "page_number", "line_number", "word_number", "character_number", "error"], ["rule_rank", "in_rule"])


def confidence_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.confidence_tiers(_words(spark, sf_dir))


def error_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.error_clusters(_words(spark, sf_dir))


def small_token_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.upper_median_height(table(spark, sf_dir, "ocr_words"))


def geometry_of_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes, centres, heights and crop windows of words from their polygons."""
    w = _words(spark, sf_dir).withColumn("poly", g.bbox_to_flat(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).withColumn("b", g.flat_bbox(F.col("poly")))
    c = g.crop_window(F.col("b.x0"), F.col("b.y0"), F.col("b.x1"), F.col("b.y1"))
    return w.select(*ln.PAGE, F.col("seq").cast("long").alias("seq"), "b.*", g.center(F.col("b.x0"), F.col("b.x1")).alias("xc"), g.center(F.col("b.y0"), F.col("b.y1")).alias("yc"), (F.col("b.y1") - F.col("b.y0")).alias("height"), c["left"].alias("left"), c["top"].alias("top"), c["right"].alias("right"), c["bottom"].alias("bottom"))


def image_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two crops of each error record, with relative paths."""
    return co.records_of(table(spark, sf_dir, "error_entries")).select("error_id", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.concat(F.lit("images/error_"), F.col("error_id").cast("string"), F.lit(f"/{k}.png")).alias("path")) for k in ("context", "error")])).alias("i")).select("error_id", "i.*")


def word_to_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co.placed_words(table(spark, sf_dir, "ocr_reads")).select("read_id", "page_index", F.col("seq").cast("long").alias("seq"), "line_number", "word_number")


def low_confidence_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co.low_confidence_export(table(spark, sf_dir, "ocr_reads"))


def apply_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co.apply(table(spark, sf_dir, "corrections"), table(spark, sf_dir, "error_entries"))


def unmatched_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co.unmatched(table(spark, sf_dir, "corrections"), table(spark, sf_dir, "error_entries"))


def last_record_at_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co.last_at_location(co.records_of(table(spark, sf_dir, "error_entries")))


def read_pages_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout of one page for each file: the first page, words in order, confidence as read."""
    reads = shred.latest(table(spark, sf_dir, "ocr_reads")).dropDuplicates(["read_id"])
    p = reads.select("read_id", F.get("pages", F.lit(0)).alias("p"))
    return p.select("read_id", F.posexplode("p.words").alias("seq", "w")).select("read_id", F.col("seq").cast("long").alias("seq"), "w.content", F.col("w.confidence").alias("confidence"), F.col("w.span.offset").alias("word_offset"))


def read_pages_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that hold exactly one page; the others are rejected with their number of pages."""
    reads = shred.latest(table(spark, sf_dir, "ocr_reads")).dropDuplicates(["read_id"])
    n = F.size(F.coalesce("pages", F.array().cast(reads.schema["pages"].dataType)))
    return reads.select("read_id", n.cast("long").alias("pages"), F.when(n == 1, "kept").otherwise("rejected").alias("status"))


def first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads cut to their first page."""
    reads = shred.latest(table(spark, sf_dir, "ocr_reads")).dropDuplicates(["read_id"])
    return reads.select("read_id", F.size(F.slice(F.coalesce("pages", F.array().cast(reads.schema["pages"].dataType)), 1, 1)).cast("long").alias("pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "flag_low_confidence": _flag(0), "flag_hyphenated": _flag(1), "flag_small_token": _flag(2), "flag_hotword": _flag(3), "flag_patterns": flag_patterns,
        "lines": lines, "line_context": line_context, "page_text": page_text, "errors_all": errors_all, "errors_by_document": errors_by_document, "errors_by_type": errors_by_type, "errors_export": errors_export,
        "confidence_tiers": confidence_tiers, "error_clusters": error_clusters, "small_token_median": small_token_median, "geometry_of_words": geometry_of_words, "image_paths": image_paths,
        "word_to_line": word_to_line, "low_confidence_export": low_confidence_export, "apply_corrections": apply_corrections, "unmatched_corrections": unmatched_corrections,
        "last_record_at_location": last_record_at_location, "read_pages_first": read_pages_first, "read_pages_single": read_pages_single, "first_pages": first_pages,
    }


_READS = """WITH latest AS (SELECT DISTINCT r.read_id, r.source_document, r.pages FROM ocr_reads r JOIN (SELECT read_id, max(received_at) AS m FROM ocr_reads GROUP BY 1) x ON r.read_id = x.read_id AND r.received_at = x.m)"""
_PLACED = (
    _READS
    + """, pg AS (SELECT read_id, source_document, unnest(range(len(pages))) AS page_index, unnest(pages) AS page FROM latest),
w AS (SELECT read_id, source_document, page_index, unnest(range(len(page.words))) AS seq, unnest(page.words) AS w FROM pg),
l AS (SELECT read_id, page_index, unnest(range(len(page.lines))) AS line_index, unnest(page.lines) AS l FROM pg),
met AS (SELECT w.*, l.line_index, l.l.content AS line_text, row_number() OVER (PARTITION BY w.read_id, w.page_index, l.line_index ORDER BY w.w.span."offset", seq) AS word_number,
 row_number() OVER (PARTITION BY w.read_id, w.page_index, seq ORDER BY l.line_index DESC) AS k
 FROM w JOIN l ON w.read_id = l.read_id AND w.page_index = l.page_index AND w.w.span."offset" >= l.l.spans[1]."offset" AND w.w.span."offset" < l.l.spans[1]."offset" + l.l.spans[1].length),
placed AS (SELECT * FROM met WHERE k = 1)"""
)
_RECORDS = """rec AS (SELECT error_id, source_document, page_number, line_number, word_number, error, context.line_text AS line_text FROM (SELECT *, row_number() OVER (PARTITION BY error_id ORDER BY exported_at DESC) AS k FROM error_entries) WHERE k = 1),
last AS (SELECT source_document, page_number, line_number, word_number, max(error_id) AS error_id FROM rec WHERE source_document IS NOT NULL AND page_number IS NOT NULL AND line_number IS NOT NULL AND word_number IS NOT NULL GROUP BY 1, 2, 3, 4)"""


def _flag_sql(rank: int) -> str:
    return "WITH RECURSIVE " + _RULES + f" SELECT error_type, source_document, page_number, line AS line_number, pos AS word_number, span_offset AS character_number, line_text, content AS error, ctx_x0, ctx_y0, ctx_x1, ctx_y1 FROM flagged JOIN ctx USING (source_document, page_number, line) WHERE rule_rank = {rank}"


def oracle_sql() -> dict[str, str]:
    rec = "WITH RECURSIVE "
    return {
        "flag_low_confidence": _flag_sql(0), "flag_hyphenated": _flag_sql(1), "flag_small_token": _flag_sql(2), "flag_hotword": _flag_sql(3),
        "flag_patterns": rec + _RULES + " SELECT error_type, source_document, page_number, line AS line_number, CAST(character_number AS BIGINT) AS character_number, error, line_text FROM matches",
        "lines": rec + _LINED + " SELECT source_document, page_number, seq, line, pos, content FROM lined",
        "line_context": rec + _LINED + " SELECT * FROM ctx",
        "page_text": rec + _LINED + " SELECT source_document, page_number, string_agg(line_text, chr(10) ORDER BY line) AS page_text FROM ctx GROUP BY 1, 2",
        "errors_all": _ERRORS + "SELECT row_number() OVER (ORDER BY source_document, 'page-' || page_number, rule_rank, in_rule) - 1 AS error_id, error_type, source_document, page_number, line_number, word_number, CAST(character_number AS BIGINT) AS character_number, line_text, error, ctx_x0, ctx_y0, ctx_x1, ctx_y1, err_x0, err_y0, err_x1, err_y1 FROM e",
        "errors_by_document": _ERRORS + "SELECT source_document, count(*) AS errors FROM e GROUP BY 1",
        "errors_by_type": _ERRORS + "SELECT error_type, count(*) AS errors FROM e GROUP BY 1",
        "errors_export": _ERRORS + """SELECT source_document, page_number, count(*) AS errors, '[' || string_agg(CAST(to_json({'error_type': error_type, 'page_number': page_number, 'line_number': line_number,
 'word_number': word_number, 'character_number': CAST(character_number AS BIGINT), 'error': error}) AS VARCHAR), ',' ORDER BY rule_rank, in_rule) || ']' AS body FROM e GROUP BY 1, 2""",
        "confidence_tiers": "WITH " + _WORDS + " SELECT source_document, count(*) AS words, count(*) FILTER (WHERE coalesce(confidence, 1) < CAST(0.85 AS DOUBLE)) AS below_85, count(*) FILTER (WHERE coalesce(confidence, 1) < CAST(0.95 AS DOUBLE)) AS below_95 FROM w GROUP BY 1",
        "error_clusters": "WITH " + _WORDS + " SELECT lower(content) AS word, count(*) AS errors, avg(confidence) AS mean_confidence, count(DISTINCT source_document) AS documents, min(content) AS sample FROM w WHERE confidence < CAST(0.9 AS DOUBLE) GROUP BY 1",
        "small_token_median": "WITH " + _WORDS + " SELECT source_document, page_number, list_sort(list(y1 - y0))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median_height FROM w GROUP BY 1, 2",
        "geometry_of_words": "WITH " + _WORDS + """ SELECT source_document, page_number, seq, x0, y0, x1, y1, (x0 + x1) / 2 AS xc, (y0 + y1) / 2 AS yc, y1 - y0 AS height, CAST(trunc(greatest(0.0::DOUBLE, x0 - 0.08::DOUBLE) * 300) AS INT) AS "left",
 CAST(trunc(greatest(0.0::DOUBLE, y0 - 0.08::DOUBLE) * 300) AS INT) AS top, CAST(trunc((x1 + 0.08::DOUBLE) * 300) AS INT) AS "right", CAST(trunc((y1 + 0.08::DOUBLE) * 300) AS INT) AS bottom FROM w""",
        "image_paths": "SELECT DISTINCT error_id, kind, 'images/error_' || error_id || '/' || kind || '.png' AS path FROM error_entries, (VALUES ('context'), ('error')) k(kind)",
        "word_to_line": _PLACED + " SELECT read_id, page_index, seq, line_index + 1 AS line_number, word_number FROM placed",
        "low_confidence_export": _PLACED
        + """, low AS (SELECT *, row_number() OVER (PARTITION BY read_id, page_index ORDER BY seq) AS n FROM placed WHERE coalesce(w.confidence, 1) < CAST(0.85 AS DOUBLE)),
top AS (SELECT *, row_number() OVER (ORDER BY source_document, read_id, page_index, seq) - 1 AS id FROM low WHERE n <= 5)
SELECT CAST('1' || id AS BIGINT) AS error_id, 'low_confidence' AS error_type, source_document, read_id, page_index + 1 AS page_number, line_index + 1 AS line_number, word_number, w.content AS error, line_text,
 list_min(w.polygon[1:8:2]) AS err_x0, list_min(w.polygon[2:8:2]) AS err_y0, list_max(w.polygon[1:8:2]) AS err_x1, list_max(w.polygon[2:8:2]) AS err_y1 FROM top""",
        "apply_corrections": "WITH " + _RECORDS + """, c AS (SELECT DISTINCT correction_id, source_document, page_number, line_number, word_number, corrected, submitted_at FROM corrections WHERE corrected IS NOT NULL),
fixes AS (SELECT last.error_id, list(corrected ORDER BY submitted_at, correction_id) AS f FROM c JOIN last USING (source_document, page_number, line_number, word_number) GROUP BY 1)
SELECT rec.error_id, line_text, CASE WHEN f IS NULL OR line_text IS NULL OR error IS NULL THEN line_text ELSE list_reduce(list_prepend(line_text, f), lambda l, c: CASE WHEN error = '' THEN c || l WHEN instr(l, error) = 0 THEN l
 ELSE substr(l, 1, instr(l, error) - 1) || c || substr(l, instr(l, error) + length(error)) END) END AS corrected_text, coalesce(len(f), 0) AS corrections FROM rec LEFT JOIN fixes USING (error_id)""",
        "unmatched_corrections": "SELECT DISTINCT correction_id, source_document, page_number, line_number, word_number FROM corrections c WHERE NOT EXISTS (SELECT 1 FROM error_entries e WHERE e.source_document = c.source_document AND e.page_number = c.page_number AND e.line_number = c.line_number AND e.word_number = c.word_number)",
        "last_record_at_location": "WITH " + _RECORDS + " SELECT * FROM last",
        "read_pages_first": _READS + ', w AS (SELECT read_id, unnest(range(len(pages[1].words))) AS seq, unnest(pages[1].words) AS w FROM latest) SELECT read_id, seq, w.content AS content, w.confidence AS confidence, w.span."offset" AS word_offset FROM w',
        "read_pages_single": _READS + " SELECT read_id, coalesce(len(pages), 0) AS pages, CASE WHEN coalesce(len(pages), 0) = 1 THEN 'kept' ELSE 'rejected' END AS status FROM latest",
        "first_pages": _READS + " SELECT read_id, least(1, coalesce(len(pages), 0)) AS pages FROM latest",
    }
