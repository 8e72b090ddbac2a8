"""Rescue-column ingestion of files whose schema drifts, and the report of every change.

``ingest`` parses each file once and gives one row for each record: the target columns, typed; ``rescued``, a JSON object
of every unknown field and every value that its column can't take; ``observed``, a JSON object of each field's type and
facts as written. ``changes`` orders the files of a series, compares neighbours and reports fields added, removed, renamed
and retyped. ``approvals`` follows the renames of that report from the fields of the default schema (``DEFAULT``) to all names
that their facts have gone by, and ``promote`` replays the rescued values of approved fields into typed columns. No list of
other names is kept anywhere.

A file is an object with a list ``errors``, a bare list, or one object on each line. Files that are null, blank, cut off
or hold no record give no rows; ``statuses`` has a row for each file. Repeated deliveries of a file count once. Values that
are missing and values that are null differ in ``observed`` only. A dot within a name is written ``\\.`` in ``rescued``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumry.scale import lag_in_groups, materialise

TARGET = T.StructType(
    [
        T.StructField("error_id", T.LongType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("source_document", T.StringType()),
        T.StructField("page_number", T.LongType()),
        T.StructField("line_number", T.LongType()),
        T.StructField("word_number", T.LongType()),
        T.StructField("character_number", T.LongType()),
        T.StructField("context", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("image_context", T.StringType()),
        T.StructField("image_error", T.StringType()),
    ]
)
#: Where the columns that aren't named like a field stand in the default schema.
DEFAULT = {"context.line_text": "context", "images.context": "image_context", "images.error": "image_error"}
#: Between the names of a path; a name may hold a dot.
_SEP = "\x1e"
#: Names of types as reported.
KINDS = {str: "text", bool: "true/false", int: "whole number", float: "decimal number", list: "list", dict: "object"}
RENAME_SHARE = 0.9
_PARTS = re.compile(r"[\s;,|]+")


def parse_records(body: str | None) -> list[dict] | None:
    """The records of a file; None if it doesn't parse."""
    if body is None or not body.strip():
        return None
    try:
        value = json.loads(body)
    except RecursionError:
        return None
    except ValueError:
        try:
            value = [json.loads(line) for line in body.splitlines() if line.strip()]
        except (ValueError, RecursionError):
            return None
    if isinstance(value, dict):
        listed = value.get("errors", value)
        value = listed if isinstance(listed, list) else [] if listed is None else [value]
    return [r for r in value if isinstance(r, dict)] if isinstance(value, list) else None


def status_of(body: str | None) -> tuple[str, int]:
    if body is None:
        return "null", 0
    if not body.strip():
        return "blank", 0
    records = parse_records(body)
    return ("unreadable", 0) if records is None else ("read", len(records)) if records else ("no records", 0)


def leaves(value) -> Iterator[str]:
    if isinstance(value, dict):
        for v in value.values():
            yield from leaves(v)
    elif isinstance(value, list):
        for v in value:
            yield from leaves(v)
    elif value is not None:
        yield str(value).lower() if isinstance(value, bool) else str(value)


def facts(value) -> str | None:
    """What a value says, whatever its type: its words in order of value, numbers in one form. Null says nothing."""
    words = []
    for leaf in leaves(value):
        for w in _PARTS.split(leaf):
            if w:
                if not (w[0].isdigit() or w[0] in "+-."):
                    words.append(w)
                    continue
                try:
                    n = float(w)
                    w = str(int(n)) if n == int(n) else repr(n)
                except (ValueError, OverflowError):
                    pass
                words.append(w)
    return "\x1f".join(sorted(words)) or None


def observe(record: dict, prefix: str = "") -> dict[str, list]:
    """``{path: [type or null, facts or null]}`` of a record; a path is the names down to a member."""
    out: dict[str, list] = {}
    for name, value in record.items():
        out[prefix + name] = [KINDS.get(type(value)), facts(value)]
        if isinstance(value, dict):
            out |= observe(value, f"{prefix}{name}{_SEP}")
    return out


def as_type(value, kind: T.DataType):
    """The value in the type of its column, or None if that would change what it says."""
    if isinstance(kind, T.LongType):
        if isinstance(value, bool):
            return None
        if isinstance(value, str):
            value = value.strip()
            if not re.fullmatch(r"[+-]?\d+(\.0*)?", value):
                return None
            value = int(value.split(".")[0])
        if isinstance(value, float):
            if value != value or value in (float("inf"), float("-inf")) or value != int(value):
                return None
            value = int(value)
        return value if isinstance(value, int) and -(1 << 63) <= value < 1 << 63 else None
    if isinstance(value, list) and value and all(isinstance(x, str) for x in value):
        return None
    return value if isinstance(value, str) else None


def flatten(record: dict, prefix: str = "") -> Iterator[tuple[str, object]]:
    for name, value in record.items():
        path = prefix + name.replace(".", "\\.")
        if isinstance(value, dict) and value:
            yield from flatten(value, f"{path}.")
        else:
            yield path, value


def enforce(record: dict, target: T.StructType) -> tuple[list, str | None]:
    """The typed columns of a record, and the rest as JSON (None if there is none)."""
    types = {f.name: f.dataType for f in target.fields}
    typed = dict.fromkeys(types)
    rescued = {}
    for path, value in flatten(record):
        if path in types and value is not None:
            typed[path] = as_type(value, types[path])
            if typed[path] is None:
                rescued[path] = value
        elif path not in types:
            rescued[path] = value
    return list(typed.values()), json.dumps(rescued, ensure_ascii=False, sort_keys=True) if rescued else None


META = "file_id long, series string, exported_at timestamp_ntz, record_no long"


def ingest(files: DataFrame, target: T.StructType = TARGET) -> DataFrame:
    """One row for each record of each readable file."""
    narrow = files.select("file_id", "series", F.col("exported_at").cast("timestamp_ntz").alias("exported_at"), "body").distinct()
    fields = [f.name for f in target.fields]
    schema = T.StructType([*T._parse_datatype_string(META).fields, *target.fields, T.StructField("rescued", T.StringType()), T.StructField("observed", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for file_id, series, exported_at, body in zip(pdf["file_id"], pdf["series"], pdf["exported_at"], pdf["body"]):
                for i, record in enumerate(parse_records(body) or []):
                    typed, rescued = enforce(record, target)
                    rows.append([file_id, series, exported_at, i, *typed, rescued, json.dumps(observe(record), ensure_ascii=False)])
            out = pd.DataFrame(rows, columns=["file_id", "series", "exported_at", "record_no", *fields, "rescued", "observed"])
            for f in schema.fields:
                if isinstance(f.dataType, T.LongType):
                    out[f.name] = out[f.name].astype("Int64")
            out["exported_at"] = pd.to_datetime(out["exported_at"])
            yield out

    return narrow.mapInPandas(run, schema)


def statuses(files: DataFrame) -> DataFrame:
    """``file_id, status, records`` of every file: null, blank, unreadable, no records or read."""
    narrow = files.select("file_id", "series", F.col("exported_at").cast("timestamp_ntz").alias("exported_at"), "body").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [status_of(body) for body in pdf["body"]]
            yield pd.DataFrame({"file_id": pdf["file_id"], "status": pd.Series([s for s, _ in got], dtype="object"), "records": pd.Series([n for _, n in got], dtype="int64")})

    return narrow.mapInPandas(run, "file_id long, status string, records long").distinct()


def approvals(links: DataFrame, target: T.StructType = TARGET, default: dict[str, str] = DEFAULT) -> dict[str, str]:
    """``{path: column}`` of all names that the fields of the default schema have gone by, from the renames of ``drift_links``.

    A name that leads to two columns is approved for neither. The distinct renames reach the driver, two for each name of
    the schema at most as many as it has had names.
    """
    next_to: dict[str, set[str]] = {}
    for r in links.select("field", "new_field").distinct().collect():
        next_to.setdefault(r["field"], set()).add(r["new_field"])
        next_to.setdefault(r["new_field"], set()).add(r["field"])
    sources = {**{f.name: f.name for f in target.fields}, **default}
    reached: dict[str, set[str]] = {}
    for source, column in sources.items():
        todo, seen = [source], {source}
        while todo:
            for name in next_to.get(todo.pop(), set()) - seen:
                if name not in sources:
                    seen.add(name)
                    todo.append(name)
        for name in seen:
            reached.setdefault(name, set()).add(column)
    return {name: next(iter(columns)) for name, columns in sorted(reached.items()) if len(columns) == 1}


def promote(records: DataFrame, approved: dict[str, str] = DEFAULT, target: T.StructType = TARGET) -> DataFrame:
    """``records`` with rescued values of approved fields in their typed columns, and taken out of ``rescued``.

    A column that has a value keeps it. Lists of text are joined by spaces; a value that the column can't take stays rescued.
    """
    types = {f.name: f.dataType for f in target.fields}
    moves = {**{name: name for name in types}, **approved}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            columns = {name: pdf[name].astype("object").where(pdf[name].notna(), None).tolist() for name in types}
            left = []
            for i, text in enumerate(pdf["rescued"]):
                rescued = json.loads(text) if isinstance(text, str) else {}
                for path in [p for p in rescued if p in moves]:
                    to, value = moves[path], rescued[path]
                    if isinstance(value, list) and value and all(isinstance(x, str) for x in value):
                        value = " ".join(value)
                    made = as_type(value, types[to])
                    if value is None or (made is not None and columns[to][i] is None):
                        if made is not None:
                            columns[to][i] = made
                        del rescued[path]
                left.append(json.dumps(rescued, ensure_ascii=False, sort_keys=True) if rescued else None)
            out = pdf.assign(rescued=left)
            for name, values in columns.items():
                out[name] = pd.Series(values, index=pdf.index, dtype="Int64" if isinstance(types[name], T.LongType) else "object")
            yield out

    return records.mapInPandas(run, records.schema)


def compare(before: list[tuple[object, dict]], after: list[tuple[object, dict]]) -> list[tuple[str, str, str | None]]:
    """``(field, change, new name)`` between two files, each a list of (record key, ``{path: [type, facts]}``).

    ``moved`` stands for a member of a renamed parent, or for the only text in an object that becomes text: the same facts
    under another path, without a change of the field's own.
    """

    def profile(records):
        kinds: dict[str, set] = {}
        by_key: dict[object, dict] = {}
        for key, seen in records:
            for path, (kind, _) in seen.items():
                kinds.setdefault(path, set()).update([kind] if kind else [])
            if key is not None:
                by_key.setdefault(key, seen)
        return kinds, by_key

    kinds1, facts1 = profile(before)
    kinds2, facts2 = profile(after)
    shared = [k for k in facts1 if k in facts2]
    out: list[tuple[str, str, str | None]] = []
    shown = lambda path: path.replace(_SEP, ".")
    dotted = lambda path: path.replace(".", "\\.").replace(_SEP, ".")

    def members(kinds, parent):
        return sorted(p for p in kinds if p.startswith(parent) and _SEP not in p[len(parent) :])

    def kind(kinds):
        return "decimal number" if kinds == {"whole number", "decimal number"} else "/".join(sorted(kinds))

    columns: dict[tuple[int, str], list] = {}

    def column(side, path):
        """The facts under a path of one file, a value for each shared record."""
        if (side, path) not in columns:
            seen = facts2 if side else facts1
            columns[side, path] = [seen[k][path][1] if path in seen[k] else None for k in shared]
        return columns[side, path]

    def score(a, b):
        both = [x == y for x, y in zip(column(0, a), column(1, b)) if x is not None and y is not None]
        same = sum(both)
        return (same / len(both), same) if both else (0.0, 0)

    def level(parent1, parent2):
        names1, names2 = members(kinds1, parent1), members(kinds2, parent2)
        short1, short2 = {n[len(parent1) :]: n for n in names1}, {n[len(parent2) :]: n for n in names2}
        pairs = [(short1[n], short2[n]) for n in short1 if n in short2]
        gone, new = [short1[n] for n in short1 if n not in short2], [short2[n] for n in short2 if n not in short1]
        ranked = sorted(((score(a, b), a, b) for a in gone for b in new), key=lambda x: (-x[0][0], -x[0][1], x[1], x[2]))
        for (share, same), a, b in ranked:
            if same and share >= RENAME_SHARE and a in gone and b in new:
                gone.remove(a)
                new.remove(b)
                pairs.append((a, b))
                out.append((shown(a), "renamed", dotted(b)))
        out.extend((shown(a), "removed", None) for a in gone)
        out.extend((shown(b), "added", None) for b in new)
        for a, b in pairs:
            k1, k2 = kind(kinds1[a]), kind(kinds2[b])
            if k1 and k2 and k1 != k2:
                out.append((shown(a), "type_changed", None))
            if a != b:
                out.append((dotted(a), "moved", dotted(b)))
            inner1, inner2 = members(kinds1, a + _SEP), members(kinds2, b + _SEP)
            if len(inner1) + len(inner2) == 1:
                out.append((dotted([*inner1, a][0]), "moved", dotted([*inner2, b][0])))
            if "object" in kinds1[a] and "object" in kinds2[b]:
                level(a + _SEP, b + _SEP)

    level("", "")
    return sorted(set(out), key=lambda x: (x[0], x[1], x[2] or ""))


def changes(records: DataFrame, key: str = "error_id") -> DataFrame:
    """``file_id, field, change`` of each file against the readable one before it in its series."""
    return comparisons(records, key).where("change <> 'moved'").select("file_id", "field", "change").distinct()


def drift_links(found: DataFrame) -> DataFrame:
    """``field, new_field``: the paths that comparisons found to hold the same facts."""
    return found.where("change = 'moved'").select("field", "new_field")


def comparisons(records: DataFrame, key: str = "error_id") -> DataFrame:
    """``file_id, field, change, new_field`` between neighbours of a series; ``moved`` is no change but a link of two paths.

    Files of a series are put in order at day level first, so that no task sees a whole series; each comparison gets the
    records of two files.
    """
    records = materialise(records.select("file_id", "series", "exported_at", key, "observed"), "records")  # each file is parsed once
    files = records.select("file_id", "series", "exported_at").distinct()
    order = lag_in_groups(files, "series", "exported_at", ["file_id"], ["file_id"], F.to_date("exported_at"))
    pairs = order.where("prev_file_id is not null").select("file_id", "prev_file_id")
    narrow = records.select("file_id", key, "observed")
    later = narrow.join(pairs, "file_id").select(F.col("file_id").alias("pair"), F.lit(1).alias("late"), F.col(key).alias("record_key"), "observed")
    earlier = narrow.join(pairs.withColumnsRenamed({"file_id": "pair", "prev_file_id": "file_id"}), "file_id").select("pair", F.lit(0).alias("late"), F.col(key).alias("record_key"), "observed")

    pairs_of = later.unionByName(earlier).groupBy("pair").agg(*[F.collect_list(F.when(F.col("late") == side, F.struct("record_key", "observed"))).alias(name) for side, name in enumerate(("before", "after"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs_, before, after = (c.to_pylist() for c in batch.columns)
            rows = []
            for pair, one, two in zip(pairs_, before, after):
                sides = [[(r["record_key"], json.loads(r["observed"])) for r in side] for side in (one, two)]
                rows.extend((pair, *x) for x in compare(*sides))
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.string()) for c in columns[1:]]], ["file_id", "field", "change", "new_field"])

    return pairs_of.mapInArrow(run, "file_id long, field string, change string, new_field string")
