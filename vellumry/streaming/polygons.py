"""Polygon records kept up to date from a stream of pages: each batch is merged into the table and swapped in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from vellumry.operators.polygons import upsert
from vellumry.sources.sinks import read_table, replace_table


def merger(path: str, by: list[str]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``. A batch that is given again changes nothing: its pages are there with the same size."""

    def merge(batch: DataFrame, _: int) -> None:
        existing = read_table(batch.sparkSession, path)
        merged = upsert(batch.dropDuplicates(by), existing, by).drop("action")
        replace_table(merged.select(*existing.columns), path)

    return merge
