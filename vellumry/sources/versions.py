"""Tables kept in versions: a version is written beside the others and counts once its marker stands.

``<path>/v<k>/<name>`` holds the tables of version k and ``<path>/_committed/<k>`` is its marker, created without
overwriting: readers see a whole version or the one before, on object stores too, and of two writers of one version the
second fails. A crash before the marker leaves the last version as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def current(spark: SparkSession, path: str) -> int:
    """The number of the last committed version; 0 if there is none."""
    fs, at = _fs(spark, f"{path}/_committed")
    if not fs.exists(at):
        return 0
    return max((int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit()), default=0)


def commit(spark: SparkSession, path: str, tables: dict[str, DataFrame], keep: int = 2) -> int:
    """Write ``tables`` as the next version and make it count; older versions than the last ``keep`` are removed.

    The tables may be computed from the version before.
    """
    version = current(spark, path) + 1
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/v{version}/{name}")
    mark(spark, path, version)
    for old in range(max(1, version - keep - 8), version - keep + 1):
        fs, at = _fs(spark, f"{path}/v{old}")
        fs.delete(at, True)
    return version


def mark(spark: SparkSession, path: str, version: int) -> None:
    fs, at = _fs(spark, f"{path}/_committed/{version}")
    fs.create(at, False).close()


def read(spark: SparkSession, path: str, name: str, version: int | None = None) -> DataFrame | None:
    """A table of the last version, or None if there is no version."""
    version = current(spark, path) if version is None else version
    return spark.read.parquet(f"{path}/v{version}/{name}") if version else None
