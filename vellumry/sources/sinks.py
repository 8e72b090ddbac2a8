"""Results as files: error lists, page records, and overwriting by versions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.functions.text import page_file
from vellumry.scale import materialise
from vellumry.sources import versions


def write_errors(errors: DataFrame, path: str) -> None:
    """The error records as JSON lines, in files of Spark's making."""
    errors.write.mode("overwrite").json(path)


def write_errors_by_document(errors: DataFrame, path: str) -> None:
    """The same in a folder for each document."""
    errors.write.mode("overwrite").partitionBy("source_document").json(path)


def error_pieces(errors: DataFrame, fields: list[str], order: list[str]) -> DataFrame:
    """``source_document, page_number, errors, body``: the records of each page as a JSON list in the order given.

    A page bounds what is gathered, whatever the size of its document. Null fields are written as null.
    """
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    at = F.array_sort(F.collect_list(F.struct(*order, record.alias("r"))))
    body = F.concat(F.lit("["), F.array_join(F.transform(at, lambda s: s["r"]), ","), F.lit("]"))
    return errors.groupBy("source_document", "page_number").agg(F.count("*").alias("errors"), body.alias("body"))


def write_error_file(pieces: DataFrame, path: str) -> int:
    """One file ``{"errors": [...]}`` of all pieces, documents and pages in order; the number of records.

    Pieces are sorted by Spark and pass through the driver one partition after the other, never all at once.
    """
    spark = pieces.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    total = 0
    try:
        out.write(bytearray(b'{"errors":['))
        for row in pieces.orderBy("source_document", "page_number").toLocalIterator():
            inner = row["body"][1:-1]
            if inner:
                out.write(bytearray(((b"," if total else b"") + inner.encode())))
                total += row["errors"]
        out.write(bytearray(b"]}"))
    finally:
        out.close()
    return total


def write_bodies(bodies: DataFrame, root: str) -> DataFrame:
    """Write each row's ``body`` (text or bytes) to ``root/path``; gives ``path, n_bytes``. A file that exists is replaced whole.

    Tasks write on their own with pyarrow, to a name of their own first, so that a lost task leaves no half file.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        for pdf in batches:
            sizes = []
            for path, body in zip(pdf["path"], pdf["body"]):
                data = body.encode() if isinstance(body, str) else bytes(body)
                to = f"{base}/{path}"
                system.create_dir(to.rsplit("/", 1)[0], recursive=True)
                part = f"{to}.part-{uuid.uuid4().hex}"
                with system.open_output_stream(part) as f:
                    f.write(data)
                system.move(part, to)
                sizes.append(len(data))
            yield pd.DataFrame({"path": pdf["path"], "n_bytes": sizes}).astype({"path": "object", "n_bytes": "int64"})

    return bodies.select("path", "body").where("body is not null").mapInPandas(run, "path string, n_bytes long")


def page_bodies(records: DataFrame, document: str = "document", page: str = "page_number") -> DataFrame:
    """``path, body`` of page records: ``<document>/page_<n>.json``."""
    body = F.to_json(F.struct(*[c for c in records.columns if c != document]))
    return records.select(F.concat(F.col(document), F.lit("/"), page_file(F.col(page))).alias("path"), body.alias("body"))


def document_bodies(recognised: DataFrame) -> DataFrame:
    """``path, body`` of what the OCR service gave: ``<name>.json``; documents whose call failed have none."""
    return recognised.where("body is not null").select(F.concat("name", F.lit(".json")).alias("path"), "body")


def insert_only(df: DataFrame, path: str, by: list[str]) -> int:
    """Add the rows of ``df`` whose key the table at ``path`` doesn't hold yet; the others stay as they are. How many were added."""
    held = versions.read(df.sparkSession, path, "table")
    new = df.dropDuplicates(by)
    new = materialise(new if held is None else new.join(held.select(*by).distinct(), by, "left_anti").select(*df.columns), "new")
    added = new.count()
    if added or held is None:
        replace_table(new if held is None else held.select(*df.columns).unionByName(new), path)
    return added


def replace_table(df: DataFrame, path: str) -> str:
    """Overwrite the table at ``path`` safely though ``df`` may read it: a new version counts once it is complete."""
    versions.commit(df.sparkSession, path, {"table": df})
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The last version of a table of ``replace_table``, or the plain Parquet files at ``path`` before its first version."""
    held = versions.read(spark, path, "table")
    return spark.read.parquet(path) if held is None else held
