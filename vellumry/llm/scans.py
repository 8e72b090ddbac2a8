"""Repair of text from scanned pages: furniture of the page, words cut at line ends, misread words, paragraphs.

Lines are labelled by the hidden Markov model of ``line_model``, over layout features, confidence and the look of the text.
A page is the unit of work; words stay in Spark, and only line texts and numbers go to Python.

Words are judged by type, in tables of distinct words: the lexicon counts words in the middle of body lines, where no word
is cut. A cut word joins the end of a body line with the start of the next body line, overleaf too. A misread word
differs from a far more frequent one in one place of at most two letters, by a confusion that several words show or that
the recogniser itself was unsure of (``confidence``); marks and digits within a word give it away on their own.

A paragraph opens at a line labelled ``opening``, after a heading, on a document's first page (whatever its number), after
a missing page, and at a page turn where the page before ends a sentence short of its margin and the new page opens one.

Defined results: null or blank content is no word; rows without document, page, line or word number are left out; repeated
rows count once; of several deliveries of one word the last one counts, of several at one time the least by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumry.llm import line_model as lm
from vellumry.scale import carry_in_groups, materialise

#: Marks that a cut word can end with.
CUT_MARKS = "-¬‐­=‑~"
_CUT_END = "[" + "".join("\\" + m if m in "-~" else m for m in CUT_MARKS) + "]$"
_EDGES = r"[.,;:?\"()\[\]“”]"
#: A word read with less confidence than this was unsure.
UNSURE = 0.9
#: How many times as often as in all other words a confusion may occur in one word, and how far above that its count may lie
#: by chance (in standard deviations).
MARGIN, CHANCE = 10.0, 3.0
#: What is more frequent than this share of the word it resembles is a word of its own and isn't counted as a confusion's case.
OWN_WORD = 0.1
#: A confusion seen on so many words counts whatever the confidence; else so large a share of the type's cases must be unsure.
CONFUSION_WORDS, UNSURE_SHARE = 3, 0.5
#: A paragraph that runs over more pages than this comes in several rows.
PART_PAGES = 64

PAGE = ["source_document", "page_number"]
PLACE = [*PAGE, "line_number", "word_number"]


def page_rows(words: DataFrame) -> DataFrame:
    """``source_document, page_number, lines``: each page's lines from the top, with their words; one shuffle of the words.

    A line has ``line_number``, ``words`` (number, content, unsure), ``text`` and the numbers that the line model reads.
    """
    kinds = {f.name for f in words.schema.fields}
    have = lambda c: F.col(c) if c in kinds else F.lit(None).cast("double").alias(c)
    age = -F.unix_micros(F.col("ingested_at").cast("timestamp")) if "ingested_at" in kinds else F.lit(0).cast("long")
    unsure = (have("confidence") < UNSURE).alias("unsure")
    word = F.struct("word_number", F.coalesce(age, F.lit((1 << 63) - 1)).alias("age"), "content", unsure, *[have(c) for c in ("x0", "y0", "x1", "y1")])
    use = words.where(" and ".join(f"{c} is not null" for c in PLACE) + " and trim(content) <> ''")
    lines = use.repartition(*PAGE).groupBy(*PAGE, "line_number").agg(F.sort_array(F.collect_list(word)).alias("all"))
    first = lambda x, i: (i == 0) | (F.get("all", i - 1)["word_number"] != x["word_number"])
    lines = lines.select(*PAGE, "line_number", F.filter("all", first).alias("w"))
    told = F.filter("w.unsure", lambda u: u.isNotNull())
    numbers = {
        "x0": F.array_min("w.x0"), "y0": F.array_min("w.y0"), "x1": F.array_max("w.x1"), "y1": F.array_max("w.y1"),
        "height": F.array_max(F.transform("w", lambda x: x["y1"] - x["y0"])),
        "low": F.size(F.filter("w.unsure", lambda u: u)) / F.nullif(F.size(told), F.lit(0)),
        "first_width": F.get("w", F.lit(0))["x1"] - F.get("w", F.lit(0))["x0"],
    }
    shown = F.transform("w", lambda x: F.struct(x["word_number"].alias("word_number"), x["content"].alias("content"), x["unsure"].alias("unsure")))
    line = F.struct("line_number", shown.alias("words"), F.array_join("w.content", " ").alias("text"), *[v.cast("double").alias(k) for k, v in numbers.items()])
    return lines.groupBy(*PAGE).agg(F.sort_array(F.collect_list(line)).alias("lines"))


def label(words: DataFrame) -> DataFrame:
    """``source_document, page_number, lines`` with the ``state`` of each line and ``right``, the page's right margin."""
    coded = materialise(page_rows(words).withColumn("codes", lm.line_codes(F.col("lines"))), "pages")
    model = lm.fit_pages(coded)
    states = coded.withColumn("states", lm.decode(F.col("codes"), model))
    line = F.transform("lines", lambda x, i: x.withField("state", F.get("states", i)))
    return materialise(states.select(*PAGE, line.alias("lines"), F.array_max("lines.x1").alias("right")), "labelled")


def _is_body(line: Column) -> Column:
    return line["state"].isin(lm.BODY, lm.OPENING)


def core_of(content: Column) -> Column:
    """The word without the punctuation around it."""
    return F.regexp_replace(content, f"^{_EDGES}+|{_EDGES}+$", "")


def tokens_of(labelled: DataFrame) -> DataFrame:
    """One row for each word of a body line, with its ``core``; ``place`` is mid, first, last or only within the line."""
    each = labelled.select(*PAGE, F.explode(F.filter("lines", _is_body)).alias("l")).select(*PAGE, "l.line_number", F.size("l.words").alias("n"), F.posexplode("l.words").alias("k", "w"))
    place = F.when(F.col("n") == 1, "only").when(F.col("k") == 0, "first").when(F.col("k") == F.col("n") - 1, "last").otherwise("mid")
    return each.select(*PAGE, "line_number", "w.word_number", "w.content", core_of(F.col("w.content")).alias("core"), place.alias("place"), "w.unsure")


def lexicon_of(tokens: DataFrame) -> DataFrame:
    """``word, n``: lower-case words in the middle of body lines."""
    return tokens.where("place = 'mid' and core <> ''").groupBy(F.lower("core").alias("word")).agg(F.count("*").alias("n"))


def line_ends(labelled: DataFrame) -> DataFrame:
    """Last word of each body line with the first word of the next one, overleaf too."""
    body = labelled.select(*PAGE, F.filter("lines", _is_body).alias("b")).where("size(b) > 0")
    start = lambda x: F.struct(F.get(x["words"], F.lit(0))["content"].alias("next_word"), x["line_number"].alias("next_line"), F.get(x["words"], F.lit(0))["word_number"].alias("next_word_number"))
    end = F.transform("b", lambda x, i: F.struct(x["line_number"].alias("line_number"), F.element_at(x["words"], -1).alias("w"), F.when(i + 1 < F.size("b"), start(F.get("b", i + 1))).alias("next")))
    ends = body.select(*PAGE, F.explode(end).alias("e")).select(*PAGE, "e.line_number", "e.w.word_number", "e.w.content", "e.next")
    turn = body.select(F.col("source_document").alias("t_doc"), (F.col("page_number") - 1).alias("t_page"), start(F.get("b", F.lit(0))).alias("t_next"))
    over = ends.where("next is null").drop("next").join(turn, (F.col("source_document") == F.col("t_doc")) & (F.col("page_number") == F.col("t_page")))
    within = ends.where("next is not null").withColumn("next_page", F.col("page_number"))
    over = over.select(*PAGE, "line_number", "word_number", "content", F.col("t_next").alias("next"), (F.col("page_number") + 1).alias("next_page"))
    return within.unionByName(over).select(*PLACE, "content", "next.next_word", "next_page", "next.next_line", "next.next_word_number")


def broken_words(labelled: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Line ends whose last word is the first part of a cut one; ``whole`` is the word put together again."""
    ends = line_ends(labelled)
    head = F.regexp_replace("content", _CUT_END, "")
    tail = F.regexp_replace(F.regexp_replace("next_word", r"[.,;:!?\"()\[\]“”]+$", ""), _CUT_END, "")
    e = ends.withColumns({"head": head, "tail": tail, "marked": F.col("content").rlike(_CUT_END)})
    open_ = (F.col("head").rlike(r"[\p{L}\p{N}\p{S}|†@!]$")) & F.col("tail").rlike(r"^[^\s.,;:\-—]")
    e = e.where(open_).withColumns({"joined": F.lower(F.concat("head", "tail")), "compound": F.lower(F.concat_ws("-", "head", "tail")), "l_head": F.lower("head"), "l_tail": F.lower("tail")})
    for k in ("joined", "compound", "l_head", "l_tail"):
        e = e.join(lexicon.select(F.col("word").alias(f"_{k}"), F.col("n").alias(f"n_{k}")), F.col(k) == F.col(f"_{k}"), "left").withColumn(f"n_{k}", F.coalesce(f"n_{k}", F.lit(0))).drop(f"_{k}")
    starts = lexicon.where("word like '%-%' and n >= 3").select(F.regexp_replace("word", "-.*$", "").alias("_start")).distinct().withColumn("starts_compound", F.lit(True))
    e = e.join(starts, F.col("l_head") == F.col("_start"), "left")
    at_hyphen = (F.col("n_compound") > F.col("n_joined")) | (F.col("starts_compound") & (F.col("n_joined") == 0))
    cut = F.when(F.col("marked"), ~F.coalesce(at_hyphen, F.lit(False))).otherwise((F.col("n_joined") >= 3) & (F.least("n_l_head", "n_l_tail") * 20 <= F.col("n_joined")))
    return e.where(cut & (F.length("head") > 0)).withColumn("whole", F.concat("head", "tail"))


def _splits(word: str) -> str:
    """SQL for all ways to leave out up to two letters: ``struct(sig, part, n)``."""
    return f"""flatten(transform(sequence(0, length({word})), i -> transform(sequence(0, least(2, length({word}) - i)), k ->
 struct(xxhash64(substr({word}, 1, i), substr({word}, i + k + 1), i) AS sig, substr({word}, i + 1, k) AS part))))"""


def _held(word: str) -> str:
    """SQL for the distinct stretches of up to two letters of a word, the empty one included."""
    return f"array_distinct(flatten(transform(sequence(0, least(2, length({word}))), k -> transform(sequence(1, length({word}) - k + 1), i -> substr({word}, i, k)))))"


def parts_of(broken: DataFrame) -> DataFrame:
    """Where the parts of cut words stand."""
    return broken.select(*PLACE).union(broken.select("source_document", "next_page", "next_line", "next_word_number")).distinct()


def misread_types(tokens: DataFrame, lexicon: DataFrame, broken: DataFrame) -> DataFrame:
    """``core, word``: types of whole body words that are misread, and what was written (null if only a mark tells).

    A word of a million may well be misread a thousand times in one way, but not a hundred thousand times: then it is a word
    of its own. The limit is a share of the right word's count that doesn't depend on the size of the tables: ``MARGIN``
    times the rate of the confusion, pooled over all other words that could show it. Chance is allowed for on top, so small
    counts pass too. Both counts are taken over the same positions.
    """
    cut = F.col("place").isin("last", "only") & F.col("core").rlike(_CUT_END)
    whole = tokens.where("core <> ''").where(~cut).join(parts_of(broken), PLACE, "left_anti")
    types = materialise(whole.groupBy("core").agg(F.count("*").alias("n"), F.count_if("unsure").alias("unsure")), "cores")
    # within the word: letters before and after, or a digit or mark that no word is written with
    odd = F.col("core").rlike(r"\p{L}") & (F.col("core").rlike(r"[|†@!`ſ~^<>#$%*]") | (F.col("core").rlike(r"\d") & ~F.col("core").rlike(r"^\d[\d,.]*(st|nd|rd|th|s|r|v)?$")))
    inner = F.col("core").rlike(r"\p{Ll}\p{Lu}") | F.col("core").rlike(r"^\p{Lu}{2,}\p{Ll}")
    hyphen = F.regexp_replace("core", r"-\p{Lu}", "-")
    cased = inner & hyphen.rlike(r"\p{Ll}\p{Lu}|^\p{Lu}{2,}\p{Ll}")
    t = types.withColumns({"low": F.lower("core"), "odd": odd, "cased": cased})
    plain = lexicon.where(F.col("word").rlike(r"^\p{L}[\p{L}-]*\p{L}$|^\p{L}$") & ~F.col("word").rlike("[ſ]") & (F.col("n") >= 3))
    lows = t.groupBy("low").agg(F.sum("n").alias("n"), F.sum("unsure").alias("unsure"), F.max("odd").alias("odd"))
    known = materialise(plain.select("word").join(lows.select(F.col("low").alias("word"), F.col("n").alias("w_n")), "word"), "known")
    right = known.select("word", "w_n", F.explode(F.expr(_splits("word"))).alias("x")).select("word", "w_n", F.col("x.sig").alias("sig"), F.col("x.part").alias("w_part"))
    left = lows.where("length(low) > 1").select("low", "n", "unsure", "odd", F.explode(F.expr(_splits("low"))).alias("x")).select("low", "n", "unsure", "odd", F.col("x.sig").alias("sig"), F.col("x.part").alias("part"))
    met = left.join(right, "sig").where((F.col("low") != F.col("word")) & (F.col("n") <= F.col("w_n")))
    least = met.groupBy("low", "word", "n", "unsure", "odd", "w_n").agg(F.min_by(F.struct("part", "w_part"), F.struct(F.length("part") + F.length("w_part"), "part", "w_part")).alias("m"))
    near = materialise(least.select("low", "word", "n", "unsure", "odd", "w_n", "m.part", "m.w_part"), "near")
    counted = F.when(~F.col("odd") & (F.col("n") <= F.col("w_n") * OWN_WORD + 1), F.col("n")).otherwise(0)
    cases = near.groupBy("part", "w_part").agg(F.sum(counted).alias("cases"))
    held = known.select("w_n", F.explode(F.expr(_held("word"))).alias("w_part")).groupBy("w_part").agg(F.sum("w_n").alias("held"))
    others = F.coalesce((F.col("cases") - counted) / F.nullif(F.col("held") - F.col("w_n"), F.lit(0)), F.lit(0.0))
    usual = F.col("w_n") * others * MARGIN
    judged = near.join(cases, ["part", "w_part"]).join(held, "w_part").where(F.col("odd") | (F.col("n") <= usual + F.sqrt(usual) * CHANCE + 1))
    pairs = materialise(judged.select("low", "word", "n", "unsure", "odd", "w_n", "part", "w_part"), "misreads")
    seen = pairs.groupBy("part", "w_part").agg(F.countDistinct("word").alias("words"))
    stray = F.col("part").rlike(r"^[^\p{L}\p{N}-]+$") & (F.col("w_part") == "")
    fine = pairs.join(seen, ["part", "w_part"]).where(F.col("odd") | stray | (F.col("words") >= CONFUSION_WORDS) | (F.col("unsure") >= UNSURE_SHARE * F.col("n")))
    # of several right words the one whose confusion is common and small
    likely = F.col("words") * F.log1p("w_n") / (1 + F.length("part") + F.length("w_part"))
    best = fine.groupBy("low").agg(F.max_by("word", F.struct(likely, "word")).alias("word"))
    out = t.join(best, "low", "left").where(F.col("word").isNotNull() | F.col("odd") | F.col("cased"))
    return out.select("core", F.coalesce("word", F.when(F.col("cased") & ~F.col("odd"), F.col("low"))).alias("word"))


def analyse(words: DataFrame) -> dict[str, DataFrame]:
    """Labelled pages, broken words and misread types, each computed once; ``tokens`` are the words of the body."""
    labelled = label(words)
    tokens = tokens_of(labelled)
    lexicon = materialise(lexicon_of(tokens), "lexicon")
    broken = materialise(broken_words(labelled, lexicon), "broken")
    return {"labelled": labelled, "tokens": tokens, "broken": broken, "misread": materialise(misread_types(tokens, lexicon, broken), "types")}


def faults(words: DataFrame) -> DataFrame:
    """``source_document, page_number, line_number, word_number, kind``."""
    got = analyse(words)
    tokens, broken = got["tokens"], got["broken"]
    kind = F.when(F.col("l.state") == lm.HEADER, "running_header").otherwise("page_number").alias("kind")
    furniture = F.filter("lines", lambda x: x["state"].isin(lm.HEADER, lm.NUMBER_LINE))
    lines = got["labelled"].select(*PAGE, F.explode(furniture).alias("l")).select(*PAGE, "l.line_number", F.lit(0).cast("long").alias("word_number"), kind)
    cut = broken.select(*PLACE, F.lit("broken_word").alias("kind"))
    wrong = tokens.join(got["misread"].select("core"), "core", "left_semi").join(parts_of(broken), PLACE, "left_anti").select(*PLACE, F.lit("misread_word").alias("kind"))
    return lines.unionByName(cut).unionByName(wrong).distinct()


def _as_written(core: Column, word: Column) -> Column:
    """The word in the case that the misread one shows."""
    letters = F.regexp_replace(core, r"[^\p{L}]", "")
    head = F.substr(core, F.lit(1), F.lit(1))
    upper = (letters == F.upper(letters)) & (F.length(letters) > 1)
    capital = F.substr(letters, F.lit(1), F.lit(1)).rlike(r"\p{Lu}") | head.rlike(r"\p{Lu}")
    capitalised = F.concat(F.upper(F.substr(word, F.lit(1), F.lit(1))), F.substr(word, F.lit(2)))
    return F.when(word.isNull(), core).when(upper, F.upper(word)).when(capital, capitalised).otherwise(word)


def repaired_lines(got: dict[str, DataFrame]) -> DataFrame:
    """``source_document, page_number, line_number, text`` of the body: cut words whole where they begin, misread ones mended."""
    broken = got["broken"]
    wholes = broken.groupBy(PLACE).agg(F.min("next_word").alias("rest"))
    tails = broken.select("source_document", F.col("next_page").alias("page_number"), F.col("next_line").alias("line_number"), F.col("next_word_number").alias("word_number")).distinct().withColumn("is_tail", F.lit(True))
    t = got["tokens"].join(got["misread"], "core", "left").join(wholes, PLACE, "left").join(tails, PLACE, "left")
    fixed = F.expr("replace(content, core, fixed)")
    head = F.regexp_replace("content", _CUT_END, "")
    shown = F.when(F.col("rest").isNotNull(), F.concat(head, "rest")).when(F.col("is_tail"), None).when(F.col("core") == "", F.col("content")).otherwise(fixed)
    t = t.withColumn("fixed", _as_written(F.col("core"), F.col("word"))).withColumn("shown", shown)
    at = F.array_sort(F.collect_list(F.struct("word_number", "shown")))
    return t.groupBy(*PAGE, "line_number").agg(F.array_join(F.transform(at, lambda w: w["shown"]), " ").alias("text"))


def paragraph_starts(labelled: DataFrame) -> DataFrame:
    """``source_document, page_number, line_number, new``: every body line, and whether it opens a paragraph."""
    line = F.transform("lines", lambda x, i: F.struct(x["line_number"].alias("line_number"), x["state"].alias("state"), (i > 0) & (F.get("lines", i - 1)["state"] == lm.BREAK), x["text"].alias("text"), x["x1"].alias("x1"), x["first_width"].alias("first_width")))
    named = line.cast("array<struct<line_number:bigint,state:int,headed:boolean,text:string,x1:double,first_width:double>>")
    body = labelled.select(*PAGE, "right", F.filter(named, _is_body).alias("b")).where("size(b) > 0")
    last = body.select(F.col("source_document").alias("p_doc"), (F.col("page_number") + 1).alias("p_page"), F.element_at("b", -1)["text"].alias("p_text"), (F.col("right") - F.element_at("b", -1)["x1"]).alias("p_room"))
    turn = body.join(last, (F.col("source_document") == F.col("p_doc")) & (F.col("page_number") == F.col("p_page")), "left")
    top = F.get("b", F.lit(0))
    closed = F.col("p_text").rlike(r"[.?!][\"”’')\]]*$") & top["text"].rlike(r"^[\"“‘'(\[]*\p{Lu}") & F.coalesce(F.col("p_room") > top["first_width"] + 0.1, F.lit(True))
    at_turn = F.col("p_doc").isNull() | closed
    each = turn.select(*PAGE, at_turn.alias("at_turn"), F.posexplode("b").alias("i", "l"))
    new = F.col("l.headed") | F.when(F.col("i") == 0, F.col("at_turn")).otherwise(F.col("l.state") == lm.OPENING)
    return each.select(*PAGE, "l.line_number", new.alias("new"))


def paragraphs(words: DataFrame) -> DataFrame:
    """``source_document, first_page, first_line, part, last_page, lines, text``: repaired running text by paragraph.

    A paragraph is named by the line that opens it and goes on over page turns; it comes as one row (part 0), or as one row
    for each ``PART_PAGES`` pages from its start, so that a document without any paragraph isn't gathered in one row.
    Furniture of the page and headings are left out. Starts are carried from page to page in two levels, never through a
    whole document in one task.
    """
    got = analyse(words)
    lines = materialise(repaired_lines(got).join(paragraph_starts(got["labelled"]), [*PAGE, "line_number"]), "lines")
    here = F.struct("page_number", "line_number")
    last = lines.where("new").groupBy(*PAGE).agg(F.max(here).alias("start"))
    pages = lines.select(*PAGE).distinct().join(last, PAGE, "left")
    carried = carry_in_groups(pages, "source_document", "page_number", "start", F.floor(F.col("page_number") / 256)).select(*PAGE, F.col("before_start"))
    so_far = F.last(F.when(F.col("new"), here), ignorenulls=True).over(Window.partitionBy(*PAGE).orderBy("line_number"))
    owned = lines.join(carried, PAGE).withColumn("start", F.coalesce(so_far, F.col("before_start")))
    part = F.floor((F.col("page_number") - F.col("start.page_number")) / PART_PAGES).alias("part")
    whole = owned.groupBy("source_document", F.col("start.page_number").alias("first_page"), F.col("start.line_number").alias("first_line"), part)
    at = F.array_sort(F.collect_list(F.struct("page_number", "line_number", "text")))
    text = F.array_join(F.filter(F.transform(at, lambda x: x["text"]), lambda x: x != ""), " ")
    return whole.agg(F.max("page_number").alias("last_page"), F.count("*").alias("lines"), text.alias("text"))


def contexts(entries: DataFrame, words: DataFrame) -> DataFrame:
    """``error_id, line_text, repaired``: lines of error entries with misread words written as they should be."""
    misread = analyse(words)["misread"]
    lines = entries.select("error_id", F.col("context.line_text").alias("line_text")).distinct()
    each = lines.select("*", F.posexplode_outer(F.split("line_text", " ")).alias("pos", "content")).withColumn("core", core_of(F.col("content")))
    fixed = each.join(misread, "core", "left").withColumn("fixed", _as_written(F.col("core"), F.col("word")))
    shown = F.when(F.col("core") == "", F.col("content")).otherwise(F.expr("replace(content, core, fixed)"))
    put = fixed.groupBy("error_id", "line_text").agg(F.sort_array(F.collect_list(F.struct("pos", shown.alias("w")))).alias("at"))
    return put.select("error_id", "line_text", F.when(F.col("line_text").isNotNull(), F.array_join("at.w", " ")).alias("repaired"))
