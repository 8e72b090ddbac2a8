"""Pending orphans over streams: each batch is an increment of the kept state.

The state goes by event time and drops copies, so batches may come late, in any order and more than once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.operators.orphans import OrphanState, parents_of, references_of

KEYS = ["source_document", "page_number", "line_number", "word_number"]


def events(references: DataFrame, entries: DataFrame, ref_id: str = "correction_id", at: str = "submitted_at") -> DataFrame:
    """One stream of both: ``kind`` (reference or entry), the key, ``id``, ``at`` and ``withdrawn_at``."""
    refs = references.select(F.lit("reference").alias("kind"), *KEYS, F.col(ref_id).alias("id"), F.col(at).alias("at"), F.lit(None).cast(entries.schema["withdrawn_at"].dataType).alias("withdrawn_at"))
    came = entries.select(F.lit("entry").alias("kind"), *KEYS, F.col("error_id").alias("id"), F.col("exported_at").alias("at"), "withdrawn_at")
    return refs.unionByName(came)


def tracker(state: OrphanState) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: takes a batch of ``events`` into the state."""

    def take(batch: DataFrame, _: int) -> None:
        refs = references_of(batch.where("kind = 'reference'"), "id", "at")
        came = batch.where("kind = 'entry'").withColumnsRenamed({"id": "error_id", "at": "exported_at"})
        state.advance(refs, parents_of(came))

    return take
