"""Text expressions: joining, literal matches with positions, replacing, names of files and pages. Null in, null out."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_ordered(at: Column, field: str, sep: str) -> Column:
    """Join one field of an array of structs in the order of the structs."""
    return F.array_join(F.transform(F.array_sort(at), lambda s: s[field]), sep)


def match_offsets(text: Column, literal: str) -> Column:
    """0-based starts of all matches of a literal that don't overlap, leftmost first."""
    pieces = F.split(text, re.escape(literal), -1)
    sizes = F.transform(F.slice(pieces, F.lit(1), F.greatest(F.lit(0), F.size(pieces) - 1)), lambda p: F.length(p))
    step = F.lit(len(literal))
    # where piece i ends: the sizes of pieces 0..i, and the matches between them
    return F.transform(sizes, lambda _, i: F.aggregate(F.slice(sizes, F.lit(1), i + 1), F.lit(0), lambda a, n: a + n) + i * step)


def replace_first(text: Column, find: Column, put: Column) -> Column:
    """The first occurrence replaced, literally; without one the text as it is; an empty ``find`` puts in front."""
    at = F.call_function("locate", find, text)
    cut = F.concat(F.substr(text, F.lit(1), at - 1), put, F.substr(text, at + F.length(find)))
    return F.when(find == "", F.concat(put, text)).when(at > 0, cut).otherwise(text)


def wrapped(word: Column) -> Column:
    """Ends in a hyphen and has more than that."""
    return word.endswith("-") & (F.length(word) >= 2)


def category(word: Column, categories: dict[str, str], default: str) -> Column:
    """Category of the word as it is, else in upper case, else in lower case."""
    m = F.create_map(*[F.lit(x) for kv in categories.items() for x in kv])
    return F.coalesce(m[word], m[F.upper(word)], m[F.lower(word)], F.lit(default))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def page_file(n: Column) -> Column:
    return F.format_string("page_%03d.json", n)


def page_of_file(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"page_(\d+)\.json$", 1), F.lit("")).try_cast("int")


def prefixed_id(n: Column) -> Column:
    """``1`` written before the number."""
    return F.concat(F.lit("1"), n.cast("string")).cast("bigint")


def display(name: Column) -> Column:
    return F.translate(name, "_", " ")
