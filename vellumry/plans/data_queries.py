"""Queries on drift, nesting, small files and orphans, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.operators import compact, drift, orphans, shred
from vellumry.scale import materialise, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.changes(drift.ingest(table(spark, sf_dir, "error_files")))


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent table of all records; what is replayed follows from the renames found."""
    records = materialise(drift.ingest(table(spark, sf_dir, "error_files")), "records")
    approved = drift.approvals(drift.drift_links(drift.comparisons(records)))
    return drift.promote(records, approved).drop("observed")


def p1_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.statuses(table(spark, sf_dir, "error_files"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.words_to_lines(table(spark, sf_dir, "ocr_reads"))


def _p2(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: shred.read_table(table(spark, sf_dir, "ocr_reads"), name)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = compact.compact(table(spark, sf_dir, "page_size_files"))
    return kept.select("source_document", "page_number", "file_id")


def p3_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = compact.compact(table(spark, sf_dir, "page_size_files"))
    return compact.bin_sizes(kept)


def _orphan_state(spark: SparkSession, sf_dir: str) -> orphans.OrphanState:
    return orphans.replay(table(spark, sf_dir, "corrections"), table(spark, sf_dir, "error_entries"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphan_state(spark, sf_dir).orphans().select("correction_id", "reason").distinct()


def p6_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_counts(_orphan_state(spark, sf_dir).orphans(), "corrections")


def p6_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.open_by_month(_orphan_state(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found, "p1_records": p1_records, "p1_files": p1_files, "p2_found": p2_found, **{f"p2_{n}": _p2(n) for n in ("pages", "words", "lines", "spans", "points")},
        "p3_found": p3_found, "p3_bins": p3_bins, "p6_found": p6_found, "p6_counts": p6_counts, "p6_open": p6_open,
    }


_DOC = r"regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(source_document, '^\s+|\s+$', '', 'g')), '\.pdf$', ''), '[-_\s]', '', 'g'), '^$', '')"
_ORPHANS = f"""
WITH c AS (SELECT DISTINCT correction_id, submitted_at, {_DOC} AS d, page_number AS p, line_number AS l, word_number AS w FROM corrections),
e AS (SELECT DISTINCT {_DOC} AS d, page_number AS p, line_number AS l, word_number AS w, exported_at, withdrawn_at FROM error_entries),
r AS (SELECT correction_id, submitted_at, CASE
 WHEN d IS NULL OR p IS NULL OR l IS NULL OR w IS NULL THEN 'incomplete'
 WHEN d NOT IN (SELECT d FROM e WHERE d IS NOT NULL) THEN 'document'
 WHEN NOT EXISTS (SELECT 1 FROM e WHERE e.d = c.d AND e.p = c.p) THEN 'page'
 WHEN NOT EXISTS (SELECT 1 FROM e WHERE e.d = c.d AND e.p = c.p AND e.l = c.l) THEN 'line'
 WHEN NOT EXISTS (SELECT 1 FROM e WHERE e.d = c.d AND e.p = c.p AND e.l = c.l AND e.w = c.w) THEN 'word'
 WHEN NOT EXISTS (SELECT 1 FROM e WHERE e.d = c.d AND e.p = c.p AND e.l = c.l AND e.w = c.w AND e.exported_at <= c.submitted_at) THEN 'late'
 WHEN NOT EXISTS (SELECT 1 FROM e WHERE e.d = c.d AND e.p = c.p AND e.l = c.l AND e.w = c.w AND e.exported_at <= c.submitted_at AND (e.withdrawn_at IS NULL OR e.withdrawn_at > c.submitted_at)) THEN 'withdrawn'
 END AS reason FROM c)
"""
_PAGES = """
WITH latest AS (SELECT DISTINCT r.read_id, r.pages FROM ocr_reads r JOIN (SELECT read_id, max(received_at) AS m FROM ocr_reads GROUP BY 1) x ON r.read_id = x.read_id AND r.received_at = x.m),
pg AS (SELECT read_id, unnest(range(len(pages))) AS page_index, unnest(pages) AS page FROM latest)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p6_found": _ORPHANS + "SELECT DISTINCT correction_id, reason FROM r WHERE reason IS NOT NULL",
        "p6_counts": _ORPHANS + "SELECT 'corrections' AS table_name, strftime(submitted_at, '%Y-%m') AS \"month\", reason, count(*) AS orphans FROM (SELECT DISTINCT * FROM r WHERE reason IS NOT NULL) GROUP BY ALL",
        "p6_open": _ORPHANS
        + """, k AS (SELECT DISTINCT c.* FROM c WHERE d IS NOT NULL AND p IS NOT NULL AND l IS NOT NULL AND w IS NOT NULL AND submitted_at IS NOT NULL),
f AS (SELECT * FROM e WHERE d IS NOT NULL AND p IS NOT NULL AND l IS NOT NULL AND w IS NOT NULL AND exported_at IS NOT NULL),
m AS (SELECT DISTINCT date_trunc('month', t) + INTERVAL 1 MONTH AS t FROM (SELECT submitted_at AS t FROM k UNION ALL SELECT exported_at FROM f UNION ALL SELECT withdrawn_at FROM f WHERE withdrawn_at > exported_at)),
s AS (SELECT DISTINCT m.t, k.correction_id, k.submitted_at, k.d, k.p, k.l, k.w FROM m JOIN k ON k.submitted_at < m.t JOIN f ON f.d = k.d AND f.p = k.p AND f.l = k.l AND f.w = k.w AND f.exported_at < m.t AND (f.withdrawn_at IS NULL OR f.withdrawn_at >= m.t)),
n AS (SELECT m.t, count(k.correction_id) AS n FROM m LEFT JOIN k ON k.submitted_at < m.t GROUP BY 1), h AS (SELECT t, count(*) AS n FROM s GROUP BY 1)
SELECT strftime(n.t - INTERVAL 1 MONTH, '%Y-%m') AS "month", n.n - coalesce(h.n, 0) AS open_references FROM n LEFT JOIN h ON n.t = h.t""",
        "p2_spans": _PAGES
        + """, w AS (SELECT read_id, page_index, unnest(range(len(page.words))) AS i, unnest(page.words).span AS s FROM pg), l AS (SELECT read_id, page_index, unnest(range(len(page.lines))) AS i, unnest(page.lines).spans AS s FROM pg),
x AS (SELECT read_id, page_index, i, unnest(range(len(s))) AS k, unnest(s) AS s FROM l)
SELECT read_id, page_index, 'word' AS owner, i AS owner_index, 0 AS span_index, s."offset" AS "offset", s.length AS length FROM w WHERE s."offset" IS NOT NULL OR s.length IS NOT NULL
UNION ALL SELECT read_id, page_index, 'line', i, k, s."offset", s.length FROM x""",
        "p2_points": _PAGES
        + """, w AS (SELECT read_id, page_index, unnest(range(len(page.words))) AS i, unnest(page.words).polygon AS p, 'word' AS owner FROM pg UNION ALL SELECT read_id, page_index, unnest(range(len(page.lines))), unnest(page.lines).polygon, 'line' FROM pg),
x AS (SELECT read_id, page_index, owner, i, p, unnest(range(CAST(ceil(len(p) / 2) AS BIGINT))) AS k FROM w)
SELECT read_id, page_index, owner, i AS owner_index, k AS point_index, p[2 * k + 1] AS x, p[2 * k + 2] AS y FROM x""",
        "p2_pages": _PAGES + "SELECT read_id, page_index, page.pagenumber AS pagenumber FROM pg",
        "p2_words": _PAGES + "SELECT read_id, page_index, word_index, w.content AS content, w.confidence AS confidence FROM (SELECT read_id, page_index, unnest(range(len(page.words))) AS word_index, unnest(page.words) AS w FROM pg)",
        "p2_lines": _PAGES + "SELECT read_id, page_index, line_index, l.content AS content FROM (SELECT read_id, page_index, unnest(range(len(page.lines))) AS line_index, unnest(page.lines) AS l FROM pg)",
        "p2_found": _PAGES
        + """, w AS (SELECT read_id, page_index, unnest(range(len(page.words))) AS word_index, unnest(page.words).span."offset" AS o FROM pg),
l AS (SELECT read_id, page_index, unnest(range(len(page.lines))) AS line_index, unnest(page.lines).spans AS spans FROM pg),
s AS (SELECT read_id, page_index, line_index, unnest(spans) AS s FROM l)
SELECT w.read_id, w.page_index, w.word_index, coalesce(max(s.line_index), -1) AS line_index FROM w LEFT JOIN s
 ON w.read_id = s.read_id AND w.page_index = s.page_index AND w.o >= s.s."offset" AND w.o < s.s."offset" + s.s.length GROUP BY ALL""",
        "p3_found": r"""
WITH v AS (SELECT file_id, written_at, body FROM page_size_files WHERE json_valid(body)),
r AS (SELECT file_id, written_at, unnest(CASE WHEN json_type(body) = 'ARRAY' THEN CAST(body AS JSON[]) ELSE [CAST(body AS JSON)] END) AS r FROM v),
k AS (SELECT file_id, written_at, nullif(lower(regexp_replace(regexp_extract(trim(r ->> '$.source_pdf'), '([^/\\]*)$', 1), '\.[^.]*$', '')), '') AS source_document,
 TRY_CAST(trim(r ->> '$.page_number') AS DOUBLE) AS n FROM r)
SELECT source_document, CAST(n AS BIGINT) AS page_number, max_by(file_id, struct_pack(w := written_at, f := file_id)) AS file_id
FROM k WHERE source_document IS NOT NULL AND n IS NOT NULL AND n = floor(n) GROUP BY 1, 2""",
    }
