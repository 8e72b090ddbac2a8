"""Consolidation of very many small files into few well-sized ones, without losing or doubling records.

Steps: freeze a manifest of what is listed (number, time, size and checksum of each file; no bodies); read the bodies and check
that they are those of the manifest; choose the record to keep for each key; bin-pack the files that hold kept records by
size, first-fit decreasing; rewrite each bin as one file of a new version; read that back and compare counts and checksums of
every bin; set the version's marker. Until the marker stands readers see the version before, or none.

Sizes are bytes as written: text sizes times the ratio that the kept records, once written, are found to have.

Defined results: null, empty, blank and cut-off bodies, records that aren't objects, and records without a usable page
number (whole, also as text or decimal) or document name are listed in the manifest and kept out of the result. Repeated
deliveries of a file count once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from vellumry.scale import materialise, new_path, salt
from vellumry.sources import versions

TARGET_BYTES = 32 << 20
CHUNK_BINS, CHUNK_FILES = 64, 1_000_000
#: Files in one folder of a compacted table.
FOLDER_BINS = 1024


def list_files(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """``file_id, file_path, written_at, n_bytes, body`` of the files under a folder; the number is a hash of the path."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    body = F.col("content").cast("string")
    return df.select(F.xxhash64("path").alias("file_id"), F.col("path").alias("file_path"), F.col("modificationTime").alias("written_at"), F.col("length").alias("n_bytes"), body.alias("body"))


def document_name(path: Column) -> Column:
    """File name without folders (of either slash) and ending, in lower case; null where nothing is left."""
    name = F.regexp_extract(F.trim(path), r"([^/\\]*)$", 1)
    return F.nullif(F.lower(F.regexp_replace(name, r"\.[^.]*$", "")), F.lit(""))


def whole_number(text: Column) -> Column:
    """A bigint from ``7``, ``"007"`` or ``7.0``; null from anything else."""
    n = F.trim(text).try_cast("decimal(38,6)")
    return F.when(n == F.floor(n), n.try_cast("bigint"))


def read_records(files: DataFrame) -> DataFrame:
    """``file_id, written_at, source_document, page_number, record`` of all readable records with both keys.

    The body is parsed once, strictly: a cut-off text gives nothing at all.
    """
    parsed = files.select("file_id", "written_at", F.try_parse_json("body").alias("v"))
    listed = F.when(F.col("v").isNull(), None).when(F.schema_of_variant("v").startswith("ARRAY"), F.col("v").cast("array<variant>")).otherwise(F.array("v"))
    each = parsed.select("file_id", "written_at", F.explode(listed).alias("r"))
    got = lambda k: F.try_variant_get("r", f"$.{k}", "string")
    keyed = each.select("file_id", "written_at", document_name(got("source_pdf")).alias("source_document"), whole_number(got("page_number")).alias("page_number"), F.to_json("r").alias("record"))
    return keyed.where("source_document is not null and page_number is not null")


def keep_latest(records: DataFrame) -> DataFrame:
    """For each document and page the record written last, then the one of the largest file number."""
    order = F.struct(F.col("written_at"), F.col("file_id"), F.col("record"))
    return records.groupBy("source_document", "page_number").agg(F.max(order).alias("m")).select("source_document", "page_number", "m.file_id", "m.written_at", "m.record")


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size, in input order. A size above the capacity gets a bin of its own."""
    bins: list[int] = []
    out = [0] * len(sizes)
    smallest = min(sizes, default=0)
    start = 0  # bins before it have no room for even the smallest
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        while start < len(bins) and bins[start] < smallest:
            start += 1
        at = next((b for b in range(start, len(bins)) if bins[b] >= sizes[i]), None)
        if at is None:
            at = len(bins)
            bins.append(max(0, capacity))
        bins[at] -= sizes[i]
        out[i] = at
    return out


def pack_files(weights: DataFrame, target_bytes: int) -> DataFrame:
    """``file_id, bin`` from ``file_id, bytes``; bins are numbered from 0 without gaps.

    The manifest is cut by hash into chunks of a bounded number of bins and files, each packed on its own; that costs at
    most one part-filled bin for each chunk. Two sums reach the driver.
    """
    total = weights.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    chunks = max(1, -(-int(total["b"]) // (CHUNK_BINS * target_bytes)), -(-total["n"] // CHUNK_FILES))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("file_id")
        return pd.DataFrame({"file_id": pdf["file_id"], "chunk": pdf["chunk"], "local": first_fit_decreasing([int(x) for x in pdf["bytes"]], target_bytes)})

    packed = weights.withColumn("chunk", salt(chunks, "file_id")).groupBy("chunk").applyInPandas(run, "file_id long, chunk int, local long")
    packed = materialise(packed, "packed")
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row for each chunk
    shift = packed.groupBy("chunk").agg((F.max("local") + 1).alias("n")).select("chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return packed.join(shift, "chunk").select("file_id", (F.col("shift") + F.col("local")).cast("long").alias("bin"))


def sums_of(df: DataFrame, *by: str) -> DataFrame:
    content = F.xxhash64("source_document", "page_number", "file_id", "record").cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(content).alias("checksum"))


def _total(df: DataFrame) -> list[Column]:
    content = F.xxhash64("file_id", "written_at", "body").cast("decimal(38,0)")
    return [F.count("*").alias("files"), F.sum(content).alias("checksum")]


def _written_bytes(spark: SparkSession, path: str) -> int:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def compact(files: DataFrame, destination: str | None = None, target_bytes: int = TARGET_BYTES) -> tuple[DataFrame, str]:
    """The consolidated records, read from the committed version, and the folder of all versions (``destination``).

    ``files`` has ``file_id, written_at, body``. Without a destination the result goes to the session's scratch folder.
    """
    spark = files.sparkSession
    destination = destination or new_path(spark, "compact")
    listed = files.select("file_id", "written_at", "body")
    manifest = materialise(listed.select("file_id", "written_at", F.octet_length("body").alias("bytes"), F.xxhash64("file_id", "written_at", "body").alias("body_sum")), "manifest")
    frozen = manifest.agg(F.count("*").alias("files"), F.sum(F.col("body_sum").cast("decimal(38,0)")).alias("checksum")).first()
    seen = Observation("bodies")
    kept_at = new_path(spark, "kept")
    keep_latest(read_records(listed.observe(seen, *_total(listed)))).write.parquet(kept_at)
    if (seen.get["files"], seen.get["checksum"]) != (frozen["files"], frozen["checksum"]):
        raise RuntimeError("the files aren't those of the manifest any more")
    kept = spark.read.parquet(kept_at)
    text = kept.agg(F.coalesce(F.sum(F.octet_length("record") + 1), F.lit(0)).alias("b")).first()["b"]
    ratio = _written_bytes(spark, kept_at) / text if text else 1.0
    weights = kept.groupBy("file_id").agg(F.ceil(F.sum(F.octet_length("record") + 1) * F.lit(ratio)).cast("long").alias("bytes"))
    binned = materialise(kept.join(pack_files(weights, target_bytes), "file_id"), "binned")
    bins = (binned.agg(F.max("bin").alias("n")).first()["n"] or 0) + 1
    version = versions.current(spark, destination) + 1
    target = f"{destination}/v{version}/records"
    one_file = binned.withColumn("folder", F.floor(F.col("bin") / FOLDER_BINS).cast("int")).repartitionById(bins, F.col("bin").cast("int"))
    one_file.write.mode("overwrite").partitionBy("folder").parquet(target)
    back = spark.read.schema(one_file.schema).parquet(target).select(*binned.columns)
    twice = sums_of(back, "bin").withColumnsRenamed({"rows": "rows2", "checksum": "checksum2"})
    apart = sums_of(binned, "bin").join(twice, "bin", "full").where("not (rows <=> rows2 and checksum <=> checksum2)").count()
    whole, again = sums_of(kept).first(), sums_of(back).first()
    if whole != again or apart:
        raise RuntimeError(f"rewritten bins don't agree with what was kept: {whole} {again}, {apart} bins")
    versions.mark(spark, destination, version)
    return back, destination


def bin_sizes(compacted: DataFrame) -> DataFrame:
    """``bin, records, bytes`` of a compacted table."""
    return compacted.groupBy("bin").agg(F.count("*").alias("records"), F.sum(F.octet_length("record") + 1).alias("bytes"))


