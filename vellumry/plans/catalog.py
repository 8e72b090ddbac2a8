"""All queries of the core, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellumry.plans import data_queries, page_queries, word_queries

MODULES = [word_queries, page_queries, data_queries]


#: Queries whose whole numbers are given as bigint, as SQL gives them.
LONG = {
    "flag_low_confidence", "flag_hyphenated", "flag_small_token", "flag_hotword", "flag_patterns", "lines", "line_context", "apply_corrections",
    "target_pages", "page_scope_swap", "page_scope_collapse", "pages_to_process", "page_chunks", "page_plan", "label_rows", "label_hit",
}


def _long(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(spark, sf_dir)
        return df.select(*[df[c].cast("long").alias(c) if kind == "int" else df[c] for c, kind in df.dtypes])

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _long(f) if name in LONG else f for m in MODULES for name, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for m in MODULES for name, q in m.oracle_sql().items()}
