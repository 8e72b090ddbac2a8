"""Queries of this subpackage: ``queries()`` and ``oracle_sql()`` as in the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.llm import levels, packing, repeats, scans, tokens
from vellumry.scale import materialise, table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.faults(table(spark, sf_dir, "ocr_words"))


def p5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.paragraphs(table(spark, sf_dir, "ocr_words"))


def p5_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.contexts(table(spark, sf_dir, "error_entries"), table(spark, sf_dir, "ocr_words"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"), "text", ["doc_id"])


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_sizes(spark, sf_dir), "doc_id", "n_tokens")


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"), "text", ["doc_id"], "n_tokens", count_only=True)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the containers are filled, by each of the two plans."""
    sizes = materialise(_sizes(spark, sf_dir), "sizes")
    plans = {"sweeps": packing.pack_sweeps, "runs": packing.pack_runs}
    reports = [packing.fill_report(plan(sizes, "doc_id", "n_tokens")).select(F.lit(name).alias("plan"), "*") for name, plan in plans.items()]
    return reports[0].unionByName(reports[1])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_lines(table(spark, sf_dir, "ocr_lines"))


def p4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "ocr_lines"))


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "graded_passages"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir).select("doc_id", "band")


def p9_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.profile(_levels(spark, sf_dir))


def p9_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.word_difficulty(table(spark, sf_dir, "documents"), table(spark, sf_dir, "graded_passages"))


#: All pairs of texts of a source, by brute force.
P4_SQL = r"""
WITH l AS (SELECT DISTINCT source_document AS s, page_number AS p, line_number AS n, lower(regexp_replace(content, '[^\p{L}]', '', 'g')) AS f FROM ocr_lines
 WHERE source_document IS NOT NULL AND page_number IS NOT NULL),
f AS (SELECT DISTINCT s, f, p FROM l WHERE f <> ''), u AS (SELECT DISTINCT s, f FROM f),
d AS (SELECT x.s, x.f AS x, y.f AS y FROM u x JOIN u y ON x.s = y.s AND abs(length(x.f) - length(y.f)) <= 2 AND levenshtein(x.f, y.f) <= 2),
c AS (SELECT d.s, d.x FROM d JOIN f ON f.s = d.s AND f.f = d.y GROUP BY 1, 2 HAVING count(DISTINCT f.p) >= 6),
k AS (SELECT DISTINCT d.s, d.y FROM d JOIN c ON c.s = d.s AND c.x = d.x)
SELECT DISTINCT l.s AS source_document, l.p AS page_number, l.n AS line_number FROM l JOIN k ON k.s = l.s AND k.y = l.f"""

#: Lines that stay, page by page.
P4_PAGES_SQL = (
    P4_SQL.replace("SELECT DISTINCT l.s AS source_document", ", gone AS (SELECT DISTINCT l.s AS source_document")
    + """), o AS (SELECT DISTINCT source_document, page_number, line_number, content FROM ocr_lines)
SELECT source_document, page_number, CAST(count(*) AS INT) AS lines, string_agg(content, chr(10) ORDER BY line_number, content) AS text FROM o
WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.source_document = o.source_document AND gone.page_number = o.page_number AND gone.line_number IS NOT DISTINCT FROM o.line_number) GROUP BY 1, 2"""
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p4_found": p4_found, "p4_pages": p4_pages, "p5_found": p5_found, "p5_paragraphs": p5_paragraphs, "p5_contexts": p5_contexts, "p7_ids": p7_ids, "p8_containers": p8_containers, "p8_fill": p8_fill, "p9_found": p9_found, "p9_profile": p9_profile, "p9_words": p9_words}


def oracle_sql() -> dict[str, str]:
    return {"p4_found": P4_SQL, "p4_pages": P4_PAGES_SQL}
