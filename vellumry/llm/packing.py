"""Best-fit-decreasing filling of fixed-capacity containers, by one of two plans with the same rules.

Sweeps (``pack_sweeps``), for any capacity and what ``pack`` does. Bulk-synchronous rounds over classes of size, from the largest down. In each round
items and gaps are range-sorted together by value; every range is swept from the top, each item takes the smallest gap seen
that holds it (its successor), larger items first where several want one gap (rank), and what is left of the gap goes on
with the sweep. Items whose range has no gap for them go into the next round, whose ranges are cut elsewhere; what finds
none in ``SWEEPS`` rounds opens containers, which the same sweep goes on filling. Gaps are updated between rounds as tables.
A range holds the size of at least ``RANGE`` containers, so what ranges lose against one sweep over everything stays small.

Runs (``pack_runs``), only for a capacity up to ``RUN_SIZES``, to compare with. Items of one size can't be told apart by a
best-fit rule, nor can containers of one gap, so the rounds shrink to one loop over runs, (size, range of ranks) for items and
(gap, range of container numbers) for containers. The loop reads the histogram of sizes on the driver; the data take part in
that histogram, one salted ranking and one join. It gives the number of containers of best-fit decreasing item by item.

Defined results: items of size 0 or null take no room and get a null container; a negative size is an error; an item
above the capacity is cut into full pieces and one rest; repeated (key, size) rows count once.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumry.scale import dense_id, materialise, rank_in_groups

CAPACITY = 2048
#: The most sizes for which the histogram goes to the driver.
RUN_SIZES = 1 << 16
#: Containers' worth of items in a range, at least.
RANGE = 1024
#: Rounds that look for gaps before containers are opened, and the classes of size (shares of the capacity, from the top).
SWEEPS = 2
CLASSES = [1 / 2, 1 / 4, 1 / 16, 0.0]


def plan_runs(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Segments ``(size, first_rank, items, items_per_container, first_container)`` and the number of containers."""
    if any(s <= 0 or s > capacity for s in histogram):
        raise ValueError("sizes must lie between 1 and the capacity")
    gaps: list[int] = []  # sorted values that have runs
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first container, containers)]
    segments: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def add(gap: int, first: int, n: int) -> None:
        if n <= 0 or gap <= 0:
            return
        if gap not in runs:
            bisect.insort(gaps, gap)
            runs[gap] = []
        runs[gap].append((first, n))

    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        while left:
            i = bisect.bisect_left(gaps, size)
            if i < len(gaps):
                gap = gaps[i]
                first, n = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap]
                    gaps.pop(i)
            else:
                gap, first = capacity, opened
                n = -(-left // (capacity // size))
                opened += n
            each = gap // size
            take = min(left, each * n)
            full, rest = divmod(take, each)
            segments.append((size, rank, take, each, first))
            add(gap - each * size, first, full)
            used = full
            if rest:
                add(gap - rest * size, first + full, 1)
                used += 1
            add(gap, first + used, n - used)
            rank += take
            left -= take
    return segments, opened


def pieces(df: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """``key, piece, first, size``: items above the capacity in full pieces and a rest, all others whole."""
    items = df.select(F.col(key).alias("key"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("whole")).distinct()
    n = F.greatest(F.lit(1), F.ceil(F.col("whole") / capacity)).cast("long")
    at = items.select("key", "whole", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("piece"))
    return at.select("key", "piece", (F.col("piece") * capacity).alias("first"), F.least(F.lit(capacity).cast("long"), F.col("whole") - F.col("piece") * capacity).alias("size"))


def pack(df: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """``container, key, piece, first, size``: every item once (or its pieces), with the container that holds it."""
    return pack_sweeps(df, key, size, capacity)


def sweep(ranged: DataFrame, capacity: int, label: str, opening: bool) -> DataFrame:
    """One round over ``key, piece, first, value, container`` (items have no container, gaps no piece), a range in each partition.

    Gives ``what`` (placed, left or gap) with the same columns; ``value`` is then the item's size or the gap that is left.
    """
    schema = T.StructType([*ranged.schema.fields, T.StructField("what", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, opened = TaskContext.get().partitionId(), 0
        gaps: list[tuple[int, str]] = []
        kinds = None
        for batch in batches:
            where, what = [], []
            key, piece, first, values, held = batch.columns
            kinds = [c.type for c in batch.columns]
            for value, container, gap_row in zip(values.to_pylist(), held.to_pylist(), piece.is_null().to_pylist()):
                if gap_row:
                    bisect.insort(gaps, (value, container))
                    continue
                i = bisect.bisect_left(gaps, (value, ""))
                if i < len(gaps):
                    gap, container = gaps.pop(i)
                elif opening:
                    gap, container, opened = capacity, f"{label}-{part}-{opened}", opened + 1
                else:
                    gap, container = 0, None
                if gap > value:
                    bisect.insort(gaps, (gap - value, container))
                where.append(container)
                what.append("placed" if container else "left")
            items = [c.filter(piece.is_valid()) for c in (key, piece, first, values)]
            yield pa.RecordBatch.from_arrays([*items, pa.array(where, pa.string()), pa.array(what, pa.string())], schema.names)
        if gaps:
            none = [pa.nulls(len(gaps), kind) for kind in kinds[:3]]
            left, where = zip(*gaps)
            yield pa.RecordBatch.from_arrays([*none, pa.array(left, pa.int64()), pa.array(where, pa.string()), pa.array(["gap"] * len(gaps))], schema.names)

    return ranged.mapInArrow(run, schema)


def pack_sweeps(df: DataFrame, key: str, size: str, capacity: int = CAPACITY, parts: int | None = None) -> DataFrame:
    """As ``pack``, in distributed rounds; the sum of sizes, and for each round whether anything is left, reach the driver."""
    spark = df.sparkSession
    every = materialise(pieces(df, key, size, capacity), "pieces")
    if parts is None:
        total = every.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()["s"]
        parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, total // (capacity * RANGE)))
    items = every.where("size <> 0").select("key", "piece", "first", F.col("size").alias("value"), F.lit(None).cast("string").alias("container"))
    gaps, placed, above = items.where("false"), [], capacity + 1
    for c, share in enumerate(CLASSES):
        least = int(capacity * share) + 1
        left, above = items.where((F.col("value") >= least) & (F.col("value") < above)), least
        for r in range(SWEEPS + 1):
            # ranges are cut at other places in each round; a salt splits what has one value
            cut = max(1, parts - r * (parts // (SWEEPS + 1)))
            both = left.unionByName(gaps).withColumn("_salt", F.pmod(F.xxhash64("key", "piece", "container"), F.lit(parts)))
            order = [F.col("value").desc(), F.col("piece").isNotNull(), F.col("_salt")]
            ranged = both.repartitionByRange(cut, F.col("value").desc(), F.col("_salt")).sortWithinPartitions(*order).drop("_salt")
            done = materialise(sweep(ranged, capacity, f"{c}.{r}", r == SWEEPS), "sweep")
            placed.append(done.where("what = 'placed'").drop("what"))
            left, gaps = done.where("what = 'left'").drop("what"), done.where("what = 'gap'").drop("what")
            if left.isEmpty():
                break
    held = materialise(reduce(DataFrame.unionByName, placed), "placed")
    numbers = dense_id(held.select("container").distinct(), ["container"], "number").select("container", "number")
    full = held.join(numbers, "container").select(F.col("number").cast("long").alias("container"), "key", "piece", "first", F.col("value").alias("size"))
    return full.unionByName(_without_size(every)).withColumnRenamed("key", key)


def _without_size(every: DataFrame) -> DataFrame:
    return every.where("size = 0").select(F.lit(None).cast("long").alias("container"), "key", "piece", "first", "size")


def pack_runs(df: DataFrame, key: str, size: str, capacity: int = CAPACITY, salts: int = 64) -> DataFrame:
    """As ``pack``, planned on runs."""
    if capacity > RUN_SIZES:
        raise ValueError(f"runs are for capacities up to {RUN_SIZES}")
    spark = df.sparkSession
    every = materialise(pieces(df, key, size, capacity), "pieces")
    histogram = {r["size"]: r["n"] for r in every.where("size <> 0").groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    segments, _ = plan_runs(histogram, capacity)
    runs = spark.createDataFrame(segments or [(0, 0, 0, 1, 0)], "r_size long, r_rank long, r_items long, r_each long, r_first long")
    ranked = rank_in_groups(every.where("size <> 0"), ["size"], ["key", "piece"], "rank", salts)
    fit = (F.col("size") == F.col("r_size")) & (F.col("rank") >= F.col("r_rank")) & (F.col("rank") < F.col("r_rank") + F.col("r_items"))
    placed = ranked.join(runs, fit).select((F.col("r_first") + F.floor((F.col("rank") - F.col("r_rank")) / F.col("r_each"))).cast("long").alias("container"), "key", "piece", "first", "size")
    return placed.unionByName(_without_size(every)).withColumnRenamed("key", key)


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, items, size and free space in all, and the share of the room that is used."""
    held = packed.where("container is not null").groupBy("container").agg(F.count("*").alias("n"), F.sum("size").alias("used"))
    total = held.agg(F.count("*").alias("containers"), F.coalesce(F.sum("n"), F.lit(0)).alias("items"), F.coalesce(F.sum("used"), F.lit(0)).alias("used"), F.coalesce(F.max("used"), F.lit(0)).alias("fullest"))
    return total.select("*", (F.col("containers") * capacity - F.col("used")).alias("free"), (F.col("used") / F.nullif(F.col("containers") * capacity, F.lit(0))).alias("fill"))
