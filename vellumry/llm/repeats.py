"""Lines repeated across one source's pages: notices, share prompts, bylines, in varying and misread form.

Two lines say the same if their letters, in lower case, are at most ``EDITS`` edits apart; case, spacing, punctuation and
digits don't count. A text that stands on at least ``MIN_PAGES`` different pages of its source is dropped from all of
them. Distinct texts are worked on, with the number of pages of each; copies are never paired.

1. Summary. Each source gets a heavy-hitter summary of at most ``TRACKED`` counters. Summaries are built by part of a source
   and merged, so a hot source is summed by many tasks. The ``LEADERS`` heaviest texts of each become its first candidates.
2. Exact second pass. Each leader is compared with the texts it shares a key with; the pages of all texts within two edits
   are counted distinct. A leader with enough pages confirms all of them.
3. The rest. A threshold of six pages is absolute, while the error of a bounded summary grows with the source; so whatever
   the summaries leave out is settled exactly. Sums of pages behind each key bound the pages of a text's variants from
   above; texts whose bound is too low are done with. Every other one is a centre in its own right, however light; one
   whose variants are all confirmed adds nothing, the others are counted in full as in step 2.
4. Removal. The confirmed texts are broadcast if their size, which is measured, is at most ``BROADCAST_BYTES``; else they are
   joined by shuffle.

Keys. Two texts within two edits share one, and nothing depends on where in the text the edits are. Texts of up to 12 letters
have the strings left by taking out up to two letters. Longer ones have what is left of their letters in each of five
classes (an edit touches at most two classes), those of up to 34 letters in each two of six. Lengths overlap by two. What
these few keys leave over is sieved once more with the keys of two classes for texts of every length above 12.

Defined results: null or letterless content, and rows without source or page, are never reported. Texts of one or two letters
are all within two edits of each other, as the definition has it. Repeated rows and several occurrences on one page count once.
"""

from __future__ import annotations

from itertools import combinations
from string import ascii_lowercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumry.scale import materialise, salt

MIN_PAGES = 6
EDITS = 2
#: Counters of a source's summary, and how many of its texts are tried as leaders.
TRACKED, LEADERS = 1024, 32
#: Parts of a source that are summed on their own.
SALTS = 16
BROADCAST_BYTES = 32 << 20
_SHORT, _MIDDLE = 12, 34


def letters(content: Column) -> Column:
    return F.lower(F.regexp_replace(content, r"[^\p{L}]", ""))


def _within(classes: tuple[int, ...], n: int) -> Column:
    """The letters of ``form`` whose code point modulo ``n`` is among ``classes``, in order."""
    others = "".join(ch for ch in ascii_lowercase if ord(ch) % n not in classes)
    any_script = F.array_join(F.filter(F.split("form", ""), lambda ch: (F.ascii(ch) % n).isin(list(classes))), "")
    return F.when(F.octet_length("form") > F.length("form"), any_script).otherwise(F.translate("form", others, ""))


def _without() -> Column:
    """The strings that taking up to two letters out of ``form`` leaves."""
    once = "transform(sequence(1, length(form)), i -> concat(substr(form, 1, i - 1), substr(form, i + 1)))"
    twice = """flatten(transform(sequence(1, length(form) - 1), i -> transform(sequence(i + 1, length(form)), j ->
 concat(substr(form, 1, i - 1), substr(form, i + 1, j - i - 1), substr(form, j + 1)))))"""
    return F.expr(f"concat(array(form), {once}, if(length(form) > 1, {twice}, array()))")


def keys(fine: bool = False) -> Column:
    """The keys of ``form``; ``fine`` ones are more, and shared by fewer texts."""
    key = lambda kind, x: F.xxhash64(F.col("source_document"), F.lit(kind), x)
    n = F.length("form")
    none = F.array().cast("array<bigint>")
    short = F.when(n <= _SHORT, F.transform(_without(), lambda x: key("out", x))).otherwise(none)
    pairs = [key(f"{a}{b}", _within((a, b), 6)) for a, b in combinations(range(6), 2)]
    middle = F.when((n >= _SHORT - 1) & (F.lit(fine) | (n <= _MIDDLE)), F.array(*pairs)).otherwise(none)
    long = F.when(F.lit(not fine) & (n >= _MIDDLE - 1), F.array(*[key(f"{a}", _within((a,), 5)) for a in range(5)])).otherwise(none)
    return F.array_distinct(F.concat(short, middle, long))


def line_forms(lines: DataFrame) -> DataFrame:
    rows = lines.select("source_document", "page_number", "line_number", letters(F.col("content")).alias("form"))
    return rows.where("source_document is not null and page_number is not null and form <> ''")


def summaries(rows: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """``source_document, summary``: a mergeable heavy-hitter summary of bounded size for each source."""
    parts = rows.groupBy("source_document", salt(SALTS, "page_number").alias("part")).agg(F.expr(f"approx_top_k_accumulate(form, {tracked})").alias("summary"))
    return parts.groupBy("source_document").agg(F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary"))


def leaders(rows: DataFrame, tracked: int = TRACKED, most: int = LEADERS) -> DataFrame:
    """``id`` of the heaviest texts of each source by its summary; texts seen once are no leaders."""
    top = summaries(rows, tracked).select("source_document", F.explode(F.expr(f"approx_top_k_estimate(summary, {most})")).alias("t"))
    return top.where("t.count > 1").select(F.xxhash64("source_document", F.col("t.item")).alias("id")).distinct()


def _pairs(centres: DataFrame, others: DataFrame, forms: DataFrame) -> DataFrame:
    """Verified ``c_id, id, pages``: the texts within ``EDITS`` of each centre; both sides come as ``id, key``."""
    met = others.join(centres.withColumnRenamed("id", "c_id"), "key").select("c_id", "id").distinct()
    text = forms.select("id", "source_document", "form", "pages")
    own = text.select(F.col("id").alias("c_id"), F.col("source_document").alias("c_source"), F.col("form").alias("c_form"))
    both = met.join(own, "c_id").join(text, "id").where(F.col("source_document") == F.col("c_source"))
    return both.where(F.levenshtein("form", "c_form", EDITS) >= 0).select("c_id", "id", "pages")


def _confirmed(pairs: DataFrame, rows: DataFrame, min_pages: int) -> DataFrame:
    """``id`` of all texts around centres whose texts stand on ``min_pages`` different pages, counted exactly."""
    heavy = pairs.groupBy("c_id").agg(F.sum("pages").alias("most")).where(F.col("most") >= min_pages).select("c_id")
    members = pairs.join(heavy, "c_id", "left_semi").select("c_id", "id")
    where = rows.select(F.xxhash64("source_document", "form").alias("id"), "page_number")
    counted = members.join(where, "id").select("c_id", "page_number").distinct().groupBy("c_id").agg(F.count("*").alias("n"))
    return members.join(counted.where(F.col("n") >= min_pages), "c_id", "left_semi").select("id").distinct()


def _sieve(forms: DataFrame, min_pages: int, fine: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts that may matter, and ``id, key`` of the possible centres and of the texts that share a key with one.

    A text is a possible centre if the pages behind its keys, itself counted once, reach ``min_pages``.
    """
    keyed = forms.select("id", "pages", F.explode(keys(fine)).alias("key"))
    held = keyed.groupBy("key").agg(F.sum("pages").alias("held"), F.count("*").alias("texts")).where("texts > 1")
    shared = materialise(keyed.join(held, "key").select("id", "key", "pages", "held"), "shared")
    bound = shared.groupBy("id").agg((F.sum(F.col("held") - F.col("pages")) + F.max("pages")).alias("most"))
    links = shared.select("id", "key")
    centres = materialise(links.join(bound.where(F.col("most") >= min_pages).select("id"), "id", "left_semi"), "centres")
    links = materialise(links.join(centres.select("key").distinct(), "key", "left_semi"), "links")
    return materialise(forms.join(links.select("id").distinct(), "id", "left_semi"), "near"), centres, links


def repeated_forms(rows: DataFrame, min_pages: int = MIN_PAGES, tracked: int = TRACKED, most: int = LEADERS) -> DataFrame:
    """``source_document, form`` of every text that stands, itself or misread, on ``min_pages`` pages of its source."""
    on_pages = rows.select("source_document", "form", "page_number").distinct()
    counted = on_pages.groupBy("source_document", "form").agg(F.count("*").alias("pages"))
    forms = materialise(counted.withColumn("id", F.xxhash64("source_document", "form")), "forms")
    first = materialise(leaders(rows, tracked, most), "leaders")
    near, centres, links = forms, None, None
    for fine in (False, True):
        near, centres, links = _sieve(near, min_pages, fine)
    own = forms.where(F.col("pages") >= min_pages).select("id")
    met = materialise(_pairs(centres.join(first, "id", "left_semi"), links, near), "led")
    sure = materialise(own.union(_confirmed(met, rows, min_pages)).distinct(), "confirmed")
    rest = materialise(centres.join(first, "id", "left_anti"), "rest")
    reach = _pairs(rest, links.join(sure, "id", "left_anti"), near).select(F.col("c_id").alias("id")).distinct()
    pairs = materialise(_pairs(rest.join(reach, "id", "left_semi"), links, near), "verified")
    ids = sure.union(_confirmed(pairs, rows, min_pages)).distinct()
    return forms.join(ids, "id", "left_semi").select("source_document", "form")


def checked_broadcast(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, written once, and marked for broadcast if its texts take at most ``most`` bytes; one row reaches the driver."""
    held = materialise(df, "set")
    size = held.agg(F.coalesce(F.sum(F.octet_length("source_document") + F.octet_length("form") + 64), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(held) if size <= most else held


def repeated_lines(lines: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``source_document, page_number, line_number`` of every line to drop."""
    rows = line_forms(lines)
    drop = checked_broadcast(repeated_forms(rows, min_pages))
    return rows.join(drop, ["source_document", "form"], "left_semi").select("source_document", "page_number", "line_number").distinct()


def without_repeats(lines: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """The pages that are left: ``source_document, page_number, lines, text``; a page of notices only isn't left.

    A line number goes with all its contents if one of them is repeated, as in ``repeated_lines``.
    """
    drop = repeated_lines(lines, min_pages)
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"d.{k}")) for k in drop.columns]
    kept = lines.select("source_document", "page_number", "line_number", "content").distinct().alias("l").join(drop.alias("d"), on, "left_anti")
    page = F.sort_array(F.collect_list(F.struct("line_number", "content")))
    return kept.groupBy("source_document", "page_number").agg(page.alias("at")).select("source_document", "page_number", F.size("at").alias("lines"), F.array_join("at.content", "\n").alias("text"))
