"""Rules that flag suspicious words, and the error records they give.

A rule is a name and a condition on a word; a registry keeps their order. All word rules are met in one pass: the names
that hold are put in an array and exploded. Null contents and null confidences meet no rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumry.functions import text
from vellumry.operators import lines as ln
from vellumry.scale import dense_id, materialise

LOW_CONFIDENCE, EXPORT_CONFIDENCE, TIERS, SMALL_RATIO, EXPORT_LIMIT = 0.90, 0.85, (0.85, 0.95), 0.65, 5
#: Words known for trouble with their category, and literal text patterns in order.
HOTWORDS = {
    "O.F.M.": "abbreviations", "O.F.M.Cap.": "abbreviations", "c.i.c.m.": "abbreviations", "O.": "short-words", "O": "short-words",
    "Notarius": "general", "Charles": "general", "O'Donnell": "general", "Ist": "general", "1st": "general", "transcription": "general",
    "NOTEBOOK": "all-caps", "11": "numbers", "1": "numbers",
}
PATTERNS = {"ellipsis_3": "...", "ellipsis_2": "..", "quote_straight": '"', "equals_sign": "="}


@dataclass(frozen=True)
class Rule:
    """``kind`` names the error, ``holds`` is the condition on a word row with ``median_height``."""

    rank: int
    kind: Column
    holds: Column


def word_rules(low: float = LOW_CONFIDENCE, small: float = SMALL_RATIO, hotwords: dict[str, str] | None = None) -> list[Rule]:
    hot = HOTWORDS if hotwords is None else hotwords
    c = F.col("content")
    return [
        Rule(0, F.lit("low_confidence"), F.col("confidence") < F.lit(low)),
        Rule(1, F.lit("hyphenated_word"), text.wrapped(c)),
        Rule(2, F.lit("small_token"), (F.col("y1") - F.col("y0")) < F.lit(small) * F.col("median_height")),
        Rule(3, F.concat(F.lit("hotword_"), text.category(c, hot, "general")), F.lower(c).isin([w.lower() for w in hot])),
    ]


def _hits(rules: list[Rule]) -> Column:
    return F.array_compact(F.array(*[F.when(r.holds, F.struct(F.lit(r.rank).alias("rule_rank"), r.kind.alias("error_type"))) for r in rules]))


WORD = ["pos", "seq", "span_offset", "content", "x0", "y0", "x1", "y1"]


def line_hits(lined: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row for each line: its context (``ln.line_context``) and ``flagged``, its words that meet a rule, with their hits.

    Words are judged before anything is gathered, so the text of a line is built once, not for each of its words.
    """
    judged = lined.withColumn("_hits", _hits(word_rules() if rules is None else rules))
    word = F.when(F.size("_hits") > 0, F.struct(*WORD, F.col("_hits").alias("hits")))
    return ln.line_context(judged, F.collect_list(word).alias("flagged"))


def flag_words(lines: DataFrame) -> DataFrame:
    """Flagged words of ``line_hits``, once for each rule that holds, with ``rule_rank``, ``error_type`` and their line's context."""
    each = lines.select(*ln.PAGE, "line", *ln.CONTEXT, F.explode("flagged").alias("w")).select("*", F.explode("w.hits").alias("h"))
    return each.select(*ln.PAGE, "line", *ln.CONTEXT, *[f"w.{c}" for c in WORD], "h.rule_rank", "h.error_type")


def _matches(patterns: dict[str, str]) -> Column:
    """Every match of a text pattern in ``line_text``, with its offset in the line."""

    def matches(rank: int, kind: str, literal: str) -> Column:
        hit = lambda o: F.struct(F.lit(rank).alias("rule_rank"), F.lit(kind).alias("error_type"), F.lit(literal).alias("error"), o.alias("at"))
        return F.transform(text.match_offsets(F.col("line_text"), literal), hit)

    return F.concat(*[matches(4 + i, kind, literal) for i, (kind, literal) in enumerate(patterns.items())])


def flag_patterns(context: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """Every match of a text pattern, with its line and its offset in the page's text."""
    found = ln.line_bases(context).select("*", F.explode(_matches(patterns or PATTERNS)).alias("m"))
    return found.select("*", "m.*", (F.col("base") + F.col("m.at")).alias("character_number")).drop("m", "at", "base")


RECORD = [
    "error_type", "source_document", "page_number", "line_number", "word_number", "character_number", "line_text", "error",
    "ctx_x0", "ctx_y0", "ctx_x1", "ctx_y1", "err_x0", "err_y0", "err_x1", "err_y1",
]


def error_rows(words: DataFrame) -> DataFrame:
    """All error records, before they are numbered, with what orders them; one pass over the words, by line."""
    lines = ln.line_bases(line_hits(ln.group_lines(words)))
    box = ["x0", "y0", "x1", "y1"]
    by_word = F.flatten(F.transform("flagged", lambda w: F.transform(w["hits"], lambda h: F.struct(
        h["rule_rank"].alias("rule_rank"), h["error_type"].alias("error_type"), w["pos"].cast("long").alias("word_number"), w["span_offset"].alias("character_number"),
        w["content"].alias("error"), *[w[c].alias(f"err_{c}") for c in box], w["seq"].cast("long").alias("in_rule")))))
    at = lambda m: (F.col("base") + m["at"]).cast("long")
    by_text = F.transform(_matches(PATTERNS), lambda m: F.struct(
        m["rule_rank"].alias("rule_rank"), m["error_type"].alias("error_type"), F.lit(-1).cast("long").alias("word_number"), at(m).alias("character_number"),
        m["error"].alias("error"), *[F.col(f"ctx_{c}").alias(f"err_{c}") for c in box], at(m).alias("in_rule")))
    each = lines.select(*ln.PAGE, F.col("line").cast("long").alias("line_number"), *ln.CONTEXT, F.explode(F.concat(by_word, by_text)).alias("e"))
    return each.select(*ln.PAGE, "line_number", *ln.CONTEXT, "e.*")


def errors_all(words: DataFrame) -> DataFrame:
    """Numbered from 0: documents by name, pages by their folder name, rules in order, matches as found."""
    rows = materialise(error_rows(words), "errors")  # the range partitioner reads its input twice
    order = [F.col("source_document"), F.concat(F.lit("page-"), F.col("page_number").cast("string")), F.col("rule_rank"), F.col("in_rule")]
    return dense_id(rows, order, "error_id").select("error_id", *RECORD)


def confidence_tiers(words: DataFrame, tiers: tuple[float, ...] = TIERS) -> DataFrame:
    c = F.coalesce("confidence", F.lit(1.0))
    return words.groupBy("source_document").agg(F.count("*").alias("words"), *[F.count_if(c < F.lit(t)).alias(f"below_{round(t * 100)}") for t in tiers])


def error_clusters(words: DataFrame, threshold: float = LOW_CONFIDENCE) -> DataFrame:
    """Low-confidence words that are alike but for case; our own definition of a cluster."""
    low = words.where(F.col("confidence") < F.lit(threshold))
    return low.groupBy(F.lower("content").alias("word")).agg(F.count("*").alias("errors"), F.avg("confidence").alias("mean_confidence"), F.countDistinct("source_document").alias("documents"), F.min("content").alias("sample"))
