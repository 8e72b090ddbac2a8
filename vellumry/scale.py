"""Shared plumbing for jobs that must survive large data and lost executors.

Nothing here collects rows: the only values that reach the driver are numbers of partitions or bounded
histograms, and the docstrings say which.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset, on one machine, a temporary folder is made and set for the session.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="vellumry-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{session_dir(spark)}/{label}-{uuid.uuid4().hex}"


def session_dir(spark: SparkSession) -> str:
    """The session's own part of the shared folder."""
    return f"{shared_dir(spark)}/vellumry/{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Remove all tables that this session wrote to the shared folder; results that read them are then void."""
    path = spark._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and every later use sees the same rows.

    A written table rather than an RDD checkpoint, so later reads keep column pruning and pushed filters.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salt(n: int, *by: str | Column) -> Column:
    """A stable number from 0 to ``n - 1`` out of the given columns."""
    return F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")


def rank_in_groups(df: DataFrame, group: list[str], order: list[str], out: str, salts: int = 64) -> DataFrame:
    """Number the rows of each group from 0 without gathering a hot group in one task.

    Each group is cut into ``salts`` parts by a hash of ``order``; parts are numbered on their own and shifted by the
    sizes of the parts before them. The numbering is a bijection, not an order by value. Rows that agree in ``group``
    and ``order`` are told apart only by their position, so callers pass a unique ``order``.
    """
    at = df.withColumn("_salt", salt(salts, *order))
    sizes = at.groupBy(*group, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(*group, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = Window.partitionBy(*group, "_salt").orderBy(*order)
    keys = [*group, "_salt"]
    left = at.withColumn("_rn", F.row_number().over(own)).alias("l")
    on = None
    for k in keys:
        c = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        on = c if on is None else on & c
    return left.join(shift.alias("r"), on).select("l.*", "r._shift").withColumn(out, F.col("_shift") + F.col("_rn") - 1).drop("_shift", "_rn", "_salt")


def dense_id(df: DataFrame, order: list[str | Column], out: str, start: int = 0) -> DataFrame:
    """A global dense number in the order given, by range partitions and their sizes (two phases).

    The rows are range-partitioned and written once, so that the second pass numbers the same partitions; only one
    count for each partition reaches the driver. Ties fall where the range partitioner puts them: pass a total order.
    """
    spark = df.sparkSession
    keyed = df.select("*", *[c.alias(f"_o{i}") if isinstance(c, Column) else F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    names = [f"_o{i}" for i in range(len(order))]
    parts = materialise(keyed.repartitionByRange(*names).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = sorted((r["_part"], r["n"]) for r in parts.groupBy("_part").agg(F.count("*").alias("n")).collect())
    shift, total = [], start
    for part, n in sizes:
        shift.append((part, total))
        total += n
    shifts = spark.createDataFrame(shift, "_part int, _shift long")
    own = Window.partitionBy("_part").orderBy(*names)
    return parts.withColumn("_rn", F.row_number().over(own)).join(shifts, "_part").withColumn(out, F.col("_shift") + F.col("_rn") - 1).drop("_part", "_shift", "_rn", *names)


def lag_in_groups(df: DataFrame, group: str, at: str, order: list[str], values: list[str], bucket: Column) -> DataFrame:
    """Values of the row before, within ``group`` in the order ``at, *order``, as ``prev_*`` columns.

    Two levels instead of one window over the group: rows are compared within a bucket (a coarsening of ``at``), and the
    first row of a bucket gets the last row of the nearest earlier bucket that has one. A group that holds a third of
    all rows is thus sorted by many tasks; the second level sees one row for each bucket.
    """
    own = Window.partitionBy(group, "_bucket").orderBy(at, *order)
    rows = df.withColumn("_bucket", bucket).withColumns({"_rn": F.row_number().over(own), **{f"_in_{v}": F.lag(v).over(own) for v in values}})
    key = F.struct(at, *order)
    last = rows.groupBy(group, "_bucket").agg(*[F.max_by(v, key).alias(f"_last_{v}") for v in values])
    over = Window.partitionBy(group).orderBy("_bucket")
    carried = last.select(F.col(group).alias("_g"), F.col("_bucket").alias("_b"), *[F.lag(f"_last_{v}").over(over).alias(f"_out_{v}") for v in values])
    joined = rows.join(carried, F.col(group).eqNullSafe(F.col("_g")) & F.col("_bucket").eqNullSafe(F.col("_b")))
    return joined.withColumns({f"prev_{v}": F.when(F.col("_rn") == 1, F.col(f"_out_{v}")).otherwise(F.col(f"_in_{v}")) for v in values}).drop("_g", "_b", "_bucket", "_rn", *[f"_in_{v}" for v in values], *[f"_out_{v}" for v in values])


def carry_in_groups(df: DataFrame, group: str, at: str, value: str, bucket: Column) -> DataFrame:
    """``df`` with ``before_<value>``: the last ``value`` that isn't null in an earlier row of the group, by ``at``.

    In two levels like ``lag_in_groups``: within a bucket (a coarsening of ``at``), then over one row for each bucket.
    """
    out = f"before_{value}"
    own = Window.partitionBy(group, "_bucket").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_bucket", bucket).withColumn("_own", F.last(value, ignorenulls=True).over(own))
    last = rows.where(F.col(value).isNotNull()).groupBy(group, "_bucket").agg(F.max_by(value, at).alias("_last"))
    spans = rows.select(group, "_bucket").distinct().join(last, [group, "_bucket"], "left")
    over = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(F.col(group).alias("_g"), F.col("_bucket").alias("_b"), F.last("_last", ignorenulls=True).over(over).alias("_carried"))
    joined = rows.join(carried, F.col(group).eqNullSafe(F.col("_g")) & F.col("_bucket").eqNullSafe(F.col("_b")))
    return joined.withColumn(out, F.coalesce("_own", "_carried")).drop("_g", "_b", "_bucket", "_own", "_carried")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
