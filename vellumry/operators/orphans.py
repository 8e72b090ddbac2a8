"""References to records that don't exist: keyed pending-orphan state, maintained increment by increment.

A reference names a location; parents at that location are exported and may be withdrawn. ``OrphanState`` keeps the parent
index and every reference with its verdict as a versioned table. An increment of references and parents changes it so:
new references probe the parent index; an arriving parent (or a parent that comes again as withdrawn) has only those
references judged anew that it can touch, which are the ones that miss a level it fills and the ones at its location.
Verdicts go by event time, so rows that come late, in another order or twice give the state that a single run over
everything gives.

The state of a location at a moment is (parents exported so far, parents that stand, references so far); an arriving parent
resolves the references that wait there, a withdrawal of the last standing one reopens them. It is carried from day to day
as sums, so a location with a third of all rows is worked on by as many tasks as it has days, and its parents and references
are summed before any shuffle.

Defined results: a null in any of the four keys is ``incomplete``; a null time of submission sees no parent as exported
(``late``); a null time of export never comes; a withdrawal at or before the export leaves no moment at which the parent
stands; repeated rows count once; empty tables give empty results or, without parents, ``document`` for every complete
reference.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumry.scale import materialise, new_path
from vellumry.sources import versions

LEVELS = ["document", "page", "line", "word"]
KEY_COLUMNS = ["source_document", "page_number", "line_number", "word_number"]
LONG_AGO = "0001-01-01 00:00:00"


def document_key(name: Column) -> Column:
    """Names are equal apart from letter case, outer spaces, an ending ``.pdf``, and ``-``, ``_`` and spaces."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(name, r"^\s+|\s+$", "")), r"\.pdf$", "")
    return F.regexp_replace(bare, r"[-_\s]", "")


def located(df: DataFrame, *more: str) -> DataFrame:
    return df.select(document_key(F.col("source_document")).alias("document"), F.col("page_number").alias("page"), F.col("line_number").alias("line"), F.col("word_number").alias("word"), *more)


def deepest_level(keys: DataFrame, parents: DataFrame) -> DataFrame:
    """``keys`` with ``missing``: the first level at which no parent is found, null if a parent has the whole key.

    Only distinct prefixes are probed, each level joined to the one above it, so a document with a third of all references
    counts once at its level.
    """
    above = None
    for depth, level in enumerate(LEVELS, 1):
        on = LEVELS[:depth]
        index = parents.select(*on).dropna().distinct().withColumn("_has", F.lit(True))
        met = keys.select(*on).distinct().join(index, on, "left")
        if above is not None:
            met = met.join(above.withColumnRenamed("missing", "_above"), on[:-1], "left")
        first = F.lit(None).cast("string") if above is None else F.col("_above")
        above = met.select(*on, F.coalesce(first, F.when(F.col("_has").isNull(), level)).alias("missing"))
    return above


def location_events(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """One row for each location, moment and kind: changes of (exported, standing, references)."""
    stands = F.col("withdrawn_at").isNull() | (F.col("withdrawn_at") > F.col("exported_at"))
    own = parents.where(F.col("exported_at").isNotNull()).distinct().withColumn("stands", stands)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    came = own.select(*LEVELS, F.col("exported_at").alias("at"), one.alias("exported"), F.col("stands").cast("long").alias("standing"), zero.alias("refs"))
    went = own.where("stands and withdrawn_at is not null").select(*LEVELS, F.col("withdrawn_at").alias("at"), zero.alias("exported"), (-one).alias("standing"), zero.alias("refs"))
    asked = refs.select(*LEVELS, "at", zero.alias("exported"), zero.alias("standing"), F.col("n").cast("long").alias("refs"))
    return came.unionByName(went).unionByName(asked).groupBy(*LEVELS, "at").agg(F.sum("exported").alias("exported"), F.sum("standing").alias("standing"), F.sum("refs").alias("refs"))


def advance(events: DataFrame) -> DataFrame:
    """``events`` with the state of their location after them (``*_now``) and before them (``*_was``).

    A parent's change counts from its own moment on, so all changes of one moment are taken together.
    """
    state = ["exported", "standing", "refs"]
    day = F.to_date("at")
    by_day = events.groupBy(*LEVELS, day.alias("day")).agg(*[F.sum(c).alias(f"_d_{c}") for c in state])
    before = Window.partitionBy(*LEVELS).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_day.select(*LEVELS, "day", *[F.coalesce(F.sum(f"_d_{c}").over(before), F.lit(0)).alias(f"_c_{c}") for c in state])
    within = Window.partitionBy(*LEVELS, "day").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = events.withColumn("day", day).withColumns({f"_r_{c}": F.sum(c).over(within) for c in state})
    out = run.join(carried, [*LEVELS, "day"])
    return out.select(*LEVELS, "at", *state, *[(F.col(f"_c_{c}") + F.col(f"_r_{c}")).alias(f"{c}_now") for c in state], *[(F.col(f"_c_{c}") + F.col(f"_r_{c}") - F.col(c)).alias(f"{c}_was") for c in state])


def parents_of(entries: DataFrame) -> DataFrame:
    return located(entries, "error_id", "exported_at", "withdrawn_at")


def references_of(references: DataFrame, ref_id: str = "correction_id", at: str = "submitted_at") -> DataFrame:
    """Distinct references with their location, ``_id``, ``_given`` (the time as given) and ``at`` (never null)."""
    refs = located(references, F.col(ref_id).alias("_id"), F.col(at).alias("_given")).distinct()
    return refs.withColumn("at", F.coalesce("_given", F.lit(LONG_AGO).cast(references.schema[at].dataType)))


def judge(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """``refs`` with ``reason``, null where a parent stands."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in LEVELS])
    # three short plans rather than one long one: what the driver keeps of a plan grows with its square
    asked = materialise(refs.where(whole).groupBy(*LEVELS, "at").agg(F.count("*").alias("n")), "asked")
    places = asked.select(*LEVELS).distinct()
    placed = materialise(deepest_level(places, parents), "placed")
    here = parents.dropna(subset=LEVELS).join(places, LEVELS, "left_semi")
    states = advance(location_events(asked, here)).where("refs > 0")
    reason = F.when(F.col("missing").isNotNull(), F.col("missing")).when(F.col("exported_now") == 0, "late").when(F.col("standing_now") == 0, "withdrawn")
    verdict = materialise(states.join(placed, LEVELS).select(*LEVELS, "at", reason.alias("reason")).where("reason is not null"), "verdict")
    given = refs.drop("reason").join(verdict, [*LEVELS, "at"], "left")
    return given.select(*LEVELS, "_id", "_given", "at", F.when(~whole, "incomplete").otherwise(F.col("reason")).alias("reason"))


class OrphanState:
    """Parents and judged references under ``path``, as tables in versions."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, "orphans")

    def references(self) -> DataFrame:
        return versions.read(self.spark, self.path, "references")

    def parents(self) -> DataFrame:
        """All parents taken in so far: each increment adds its own part."""
        return self.spark.read.parquet(*[f"{self.path}/parents/v{i}" for i in range(1, self.version + 1)])

    def advance(self, refs: DataFrame, parents: DataFrame) -> int:
        """Take in an increment (``references_of``, ``parents_of``) and commit; rows that are already held change nothing."""
        version, parents = self.version, parents.distinct()
        asked = refs.distinct().withColumn("reason", F.lit(None).cast("string")).select(*LEVELS, "_id", "_given", "at", "reason")
        part = f"{self.path}/parents/v{version + 1}"
        (_not_in(parents, self.parents()) if version else parents).write.mode("overwrite").parquet(part)
        fresh = self.spark.read.parquet(part)
        if not version:
            return versions.commit(self.spark, self.path, {"references": judge(materialise(asked, "asked"), fresh)})
        held = self.references()
        filled = fresh.select(F.explode(F.array(*[_prefix(depth) for depth in range(1, 5)])).alias("_at")).distinct().withColumn("_hit", F.lit(True))
        depth = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, LEVELS)), F.col("reason")), F.lit(0)), F.lit(4))
        wanted = reduce(lambda rest, d: F.when(depth == d, _prefix(d)).otherwise(rest), range(1, 4), _prefix(4))
        marked = materialise(held.withColumn("_at", wanted).join(filled, "_at", "left").drop("_at"), "marked")
        new = _not_in(asked.drop("reason"), held.drop("reason")).withColumn("reason", F.lit(None).cast("string"))
        again = materialise(new.unionByName(marked.where("_hit").drop("_hit")), "touched")
        done = judge(again, self.parents().unionByName(fresh))
        return versions.commit(self.spark, self.path, {"references": marked.where("_hit is null").drop("_hit").unionByName(done)})

    @property
    def version(self) -> int:
        return versions.current(self.spark, self.path)

    def orphans(self, ref_id: str = "correction_id", at: str = "submitted_at") -> DataFrame:
        """``ref_id, at, reason`` of the references that wait or can't be met."""
        return self.references().where("reason is not null").select(F.col("_id").alias(ref_id), F.col("_given").alias(at), "reason").distinct()


def _prefix(depth: int) -> Column:
    """A number for the first ``depth`` parts of a key. Two that agree by chance have a reference judged anew in vain."""
    return F.xxhash64(F.lit(depth), *LEVELS[:depth])


def _not_in(rows: DataFrame, held: DataFrame) -> DataFrame:
    """``rows`` that aren't among ``held``, nulls being equal: copies are told by all they say."""
    key = lambda df: df.withColumn("_row", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in rows.columns]))
    on = F.col("l._row") == F.col("r._row")
    for c in rows.columns:
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return key(rows).alias("l").join(key(held).alias("r"), on, "left_anti").drop("_row")


#: In how many increments a whole history is taken in.
INCREMENTS = 2


def replay(references: DataFrame, entries: DataFrame, increments: int = INCREMENTS, path: str | None = None) -> OrphanState:
    """The state after a whole history, taken in by spans of time: each increment is what was submitted or exported in it."""
    spark = references.sparkSession
    refs, parents = references_of(references), parents_of(entries)
    state = OrphanState(spark, path)
    ends = refs.select(F.col("_given").alias("t")).union(parents.select("exported_at")).agg(F.unix_micros(F.min("t").cast("timestamp")).alias("a"), F.unix_micros(F.max("t").cast("timestamp")).alias("b")).first()
    low, high = ends["a"] or 0, ends["b"] or 0
    n = increments if high > low else 1
    span = lambda c: F.least(F.lit(n - 1), F.coalesce(F.floor((F.unix_micros(F.col(c).cast("timestamp")) - low) * n / F.lit(max(1, high - low))), F.lit(0)))
    for i in range(n):
        state.advance(refs.where(span("_given") == i), parents.where(span("exported_at") == i))
    return state


def orphans(references: DataFrame, entries: DataFrame, ref_id: str = "correction_id", at: str = "submitted_at") -> DataFrame:
    """``ref_id, at, reason`` for every reference that isn't met, judged in one run; what ``OrphanState`` must agree with."""
    found = judge(references_of(references, ref_id, at), parents_of(entries).distinct()).where("reason is not null")
    return found.select(F.col("_id").alias(ref_id), F.col("_given").alias(at), "reason").distinct()


def orphan_counts(found: DataFrame, table_name: str, at: str = "submitted_at") -> DataFrame:
    """Counts for each table, month and reason."""
    month = F.date_format(F.col(at), "yyyy-MM").alias("month")
    return found.groupBy(F.lit(table_name).alias("table_name"), month, "reason").agg(F.count("*").alias("orphans"))


def open_by_month(state: OrphanState) -> DataFrame:
    """Snapshots: at the end of each month with any change, the references that then wait for a parent.

    Complete references only; each change of a location's state adds to or takes from the number that waits.
    """
    refs = state.references().dropna(subset=[*LEVELS, "_given"]).groupBy(*LEVELS, "at").agg(F.count("*").alias("n"))
    states = advance(location_events(refs, state.parents().dropna(subset=LEVELS)))
    waits = F.when(F.col("standing_now") == 0, F.col("refs_now")).otherwise(0) - F.when(F.col("standing_was") == 0, F.col("refs_was")).otherwise(0)
    monthly = states.groupBy(F.date_format("at", "yyyy-MM").alias("month")).agg(F.sum(waits).alias("change"))
    return monthly.select("month", F.sum("change").over(Window.orderBy("month")).alias("open_references"))
