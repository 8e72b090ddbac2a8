"""Shredding of nested records into an adjacency table, and entity tables pivoted out of it.

``shred`` turns each record into nodes ``(node, parent, label, ordinal, scalar)``: array elements are nodes, also null
ones, so that positions are kept; members of a struct are scalar nodes under the element that holds them, with dotted
labels for structs within structs; missing members and null or empty arrays give no node. ``entities`` joins the object
nodes with their scalar children, as one aggregation over the node each row belongs to. A node is named by its path, a
letter for the member (by its place in the schema) and the ordinal of the element: ``a0b12`` is element 12 of the second
member of element 0.

A record is one row of the input, so what is unfolded from it at once is bounded by the row. ``labels`` prunes the
unfolding to the members that are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumry.scale import materialise

NODE = "struct<node:string,parent:string,label:string,ordinal:int,scalar:string>"
#: Spans are looked up in buckets of these widths: a span lies in at most two buckets of the first width not below its length.
WIDTHS = [1 << 6, 1 << 10, 1 << 16, 1 << 24, 1 << 62]


def _node(node: Column, parent: Column, label: str, ordinal: Column, scalar: Column) -> Column:
    return F.struct(node.alias("node"), parent.alias("parent"), F.lit(label).alias("label"), ordinal.cast("int").alias("ordinal"), scalar.cast("string").alias("scalar"))


def _code(i: int) -> str:
    return chr(97 + i) if i < 25 else "z" + _code(i - 25)


def _nodes(value: Column, kind: T.DataType, at: Column, label: str, path: str, code: str, labels: set[str] | None) -> list[Column]:
    """Arrays of nodes for a member ``label`` of the node ``at``."""
    under = lambda p: labels is None or any(x == p or x.startswith(p + ".") or p.startswith(x + ".") for x in labels)
    if not under(path):
        return []
    if isinstance(kind, T.ArrayType):

        def element(x: Column, i: Column) -> Column:
            own = F.concat(at, F.lit(code), i.cast("string"))
            if isinstance(kind.elementType, T.StructType):
                members = enumerate(kind.elementType.fields)
                parts = [p for k, f in members for p in _nodes(x[f.name], f.dataType, own, f.name, f"{path}.{f.name}", _code(k), labels)]
                return F.concat(F.array(_node(own, at, label, i, F.lit(None))), *parts)
            return F.array(_node(own, at, label, i, x))

        return [F.coalesce(F.flatten(F.transform(value, element)), F.array().cast(f"array<{NODE}>"))]
    if isinstance(kind, T.StructType):
        return [p for k, f in enumerate(kind.fields) for p in _nodes(value[f.name], f.dataType, at, f"{label}.{f.name}", f"{path}.{f.name}", code + _code(k), labels)]
    here = F.array(_node(F.concat(at, F.lit(code)), at, label, F.lit(0), value))
    return [F.when(value.isNotNull(), here).otherwise(F.array().cast(f"array<{NODE}>"))]


def shred(df: DataFrame, key: str, columns: list[str], labels: set[str] | None = None) -> DataFrame:
    """``key, node, parent, label, ordinal, scalar``; ``labels`` are the paths of members to unfold (all if None)."""
    root = F.lit("")
    parts = [p for k, c in enumerate(columns) for p in _nodes(F.col(c), df.schema[c].dataType, root, c, c, _code(k), labels)]
    return df.select(F.col(key), F.explode(F.concat(*parts)).alias("n")).select(key, "n.*")


def entities(nodes: DataFrame, key: str, label: str, scalars: dict[str, str]) -> DataFrame:
    """One row for each object node ``label``: ``key, node, parent, ordinal`` and its scalar children ``{name: type}``.

    Scalars are named by their label, dots replaced by underscores.
    """
    mine = nodes.where((F.col("label") == label) | F.col("label").isin(list(scalars)))
    owner = F.when(F.col("label") == label, F.col("node")).otherwise(F.col("parent"))
    picks = [F.max(F.when(F.col("label") == name, F.col("scalar"))).cast(kind).alias(name.replace(".", "_")) for name, kind in scalars.items()]
    own = F.col("label") == label
    out = mine.groupBy(key, owner.alias("_owner")).agg(F.max(F.when(own, F.col("parent"))).alias("parent"), F.max(F.when(own, F.col("ordinal"))).alias("ordinal"), *picks)
    return out.where("ordinal is not null").withColumnRenamed("_owner", "node")


def index_in(node: Column, depth: int) -> Column:
    """The ordinal that a node's name gives for its ancestor (or itself) at a depth, from 1."""
    return F.get(F.split(node, "[a-z]+"), F.lit(depth)).try_cast("long")


def latest(reads: DataFrame, columns: tuple[str, ...] = ("pages",), key: str = "read_id", at: str = "received_at") -> DataFrame:
    """Of deliveries of one read the last, with its key, time and ``columns``; copies with the same time stay and fall together later.

    The older deliveries are found without the nested columns and written; few as they are, Catalyst can broadcast them, and
    the records themselves are never shuffled.
    """
    times = reads.select(key, at).distinct()
    last = times.groupBy(F.col(key).alias("_k")).agg(F.max(at).alias("_at"))
    older = times.join(last, F.col(key).eqNullSafe(F.col("_k"))).where(~F.col(at).eqNullSafe(F.col("_at"))).select(F.col(key).alias("_k"), F.col(at).alias("_at"))
    older = materialise(older, "older")
    return reads.select(key, at, *columns).join(older, F.col(key).eqNullSafe(F.col("_k")) & F.col(at).eqNullSafe(F.col("_at")), "left_anti")


#: The members that each entity table of a read is pivoted from.
TABLES = {
    "pages": {"pages.pagenumber"},
    "words": {"pages.words.content", "pages.words.confidence"},
    "lines": {"pages.lines.content"},
    "spans": {"pages.words.span", "pages.lines.spans"},
    "points": {"pages.words.polygon", "pages.lines.polygon"},
}


def _member(reads: DataFrame, name: str) -> str:
    """The letter of a page's member in the names of nodes."""
    return _code([f.name for f in reads.schema["pages"].dataType.elementType.fields].index(name))


def read_table(reads: DataFrame, name: str, nodes: DataFrame | None = None) -> DataFrame:
    """``pages, words, lines, spans`` or ``points`` with keys to their parents; only the members it needs are unfolded."""
    nodes = shred(latest(reads), "read_id", ["pages"], TABLES[name]) if nodes is None else nodes
    page, second = index_in(F.col("node"), 1).alias("page_index"), index_in(F.col("node"), 2)
    of_word = F.col("node").rlike(f"^a[0-9]+{_member(reads, 'words')}[0-9]")
    if name == "pages":
        return entities(nodes, "read_id", "pages", {"pagenumber": "bigint"}).select("read_id", page, "pagenumber")
    if name == "words":
        return entities(nodes, "read_id", "words", {"content": "string", "confidence": "double"}).select("read_id", page, F.col("ordinal").cast("long").alias("word_index"), "content", "confidence")
    if name == "lines":
        return entities(nodes, "read_id", "lines", {"content": "string"}).select("read_id", page, F.col("ordinal").cast("long").alias("line_index"), "content")
    if name == "spans":
        inline = entities(nodes, "read_id", "words", {"span.offset": "bigint", "span.length": "bigint"}).where("span_offset is not null or span_length is not null")
        own = inline.select("read_id", page, F.lit("word").alias("owner"), F.col("ordinal").cast("long").alias("owner_index"), F.lit(0).cast("long").alias("span_index"), F.col("span_offset").alias("offset"), F.col("span_length").alias("length"))
        listed = entities(nodes, "read_id", "spans", {"offset": "bigint", "length": "bigint"})
        return own.unionByName(listed.select("read_id", page, F.lit("line").alias("owner"), second.alias("owner_index"), F.col("ordinal").cast("long").alias("span_index"), "offset", "length"))
    at = ["read_id", "page_index", "owner", "owner_index", "point_index"]
    owner = F.when(of_word, "word").otherwise("line").alias("owner")
    corner = nodes.where("label = 'polygon'").select("read_id", page, owner, second.alias("owner_index"), F.floor(F.col("ordinal") / 2).cast("long").alias("point_index"), (F.col("ordinal") % 2).alias("axis"), F.col("scalar").cast("double").alias("v"))
    return corner.groupBy(*at).agg(F.max(F.when(F.col("axis") == 0, F.col("v"))).alias("x"), F.max(F.when(F.col("axis") == 1, F.col("v"))).alias("y"))


def read_tables(reads: DataFrame) -> dict[str, DataFrame]:
    """All entity tables, from one adjacency table that is written once."""
    nodes = materialise(shred(latest(reads), "read_id", ["pages"]), "nodes")
    return {name: read_table(reads, name, nodes) for name in TABLES}


def _level(length: Column) -> Column:
    out = F.lit(len(WIDTHS) - 1)
    for i in reversed(range(len(WIDTHS) - 1)):
        out = F.when(length <= WIDTHS[i], F.lit(i)).otherwise(out)
    return out


def _bucket(offset: Column, level: Column) -> Column:
    out = F.floor(offset / F.lit(WIDTHS[-1]))
    for i in reversed(range(len(WIDTHS) - 1)):
        out = F.when(level == i, F.floor(offset / F.lit(WIDTHS[i]))).otherwise(out)
    return out.cast("long")


def covering(words: DataFrame, spans: DataFrame) -> DataFrame:
    """``words`` with the columns ``line_index`` of every span that holds their offset; null where none does.

    ``words`` has read_id, page_index, span_offset; ``spans`` read_id, page_index, line_index, offset, length. A range join
    within the page, by buckets of offsets: a span stands in the one or two buckets that it touches at the width chosen by
    its length, a word looks only into the widths that its page has.
    """
    ends = F.coalesce(F.try_add(F.col("offset"), F.col("length")), F.lit((1 << 63) - 1))
    spans = spans.where("length > 0 and offset is not null").select("read_id", "page_index", "line_index", "offset", ends.alias("end"), _level(F.col("length")).alias("level"))
    at = F.array_distinct(F.array(_bucket(F.col("offset"), F.col("level")), _bucket(F.col("end") - 1, F.col("level"))))
    keyed = spans.select("*", F.explode(at).alias("bucket"))
    levels = spans.groupBy("read_id", "page_index").agg(F.collect_set("level").alias("levels"))
    same_page = F.col("w.read_id").eqNullSafe(F.col("v.read_id")) & (F.col("w.page_index") == F.col("v.page_index"))
    w = words.alias("w").join(levels.alias("v"), same_page, "left").select("w.*", F.explode_outer("v.levels").alias("_level"))
    w = w.withColumn("_bucket", _bucket(F.col("span_offset"), F.col("_level")))
    k = keyed.select(F.col("read_id").alias("k_read"), F.col("page_index").alias("k_page"), F.col("line_index"), F.col("offset").alias("k_offset"), F.col("end").alias("k_end"), F.col("level").alias("k_level"), F.col("bucket").alias("k_bucket"))
    on = F.col("read_id").eqNullSafe(F.col("k_read")) & (F.col("page_index") == F.col("k_page")) & (F.col("_level") == F.col("k_level")) & (F.col("_bucket") == F.col("k_bucket")) & (F.col("span_offset") >= F.col("k_offset")) & (F.col("span_offset") < F.col("k_end"))
    return w.join(k, on, "left").select(*words.columns, "line_index")


def words_to_lines(reads: DataFrame) -> DataFrame:
    """``read_id, page_index, word_index, line_index`` of every word.

    Line -1: the word has no span, or no line's span holds its offset. Of several lines the last in the array wins.
    """
    nodes = materialise(shred(latest(reads), "read_id", ["pages"], {"pages.words.span.offset", "pages.lines.spans.offset", "pages.lines.spans.length"}), "nodes")
    page = index_in(F.col("node"), 1).alias("page_index")
    words = entities(nodes, "read_id", "words", {"span.offset": "bigint"}).select("read_id", page, F.col("ordinal").cast("long").alias("word_index"), "span_offset")
    spans = entities(nodes, "read_id", "spans", {"offset": "bigint", "length": "bigint"}).select("read_id", page, index_in(F.col("node"), 2).alias("line_index"), "offset", "length")
    return covering(words, spans).groupBy("read_id", "page_index", "word_index").agg(F.coalesce(F.max("line_index"), F.lit(-1)).cast("long").alias("line_index"))
