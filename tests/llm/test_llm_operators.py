"""Token encoding, packing, repeated lines, scan repair and reading levels on small cases."""

import os
import random

import duckdb
import pytest

from vellumry.llm import levels, packing, queries, repeats, scans, tokens
from vellumry.llm import line_model as lm


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Tokens

TEXTS = ["", "plain words, don't they", "a  b   c \n\n d\t", "Così virtù — 東京 👩‍🌾 \x00\x07 <|endoftext|>", "x" * 3000, " lead and trail ", "12 345,67 ''s 'll"]


def test_ids_are_those_of_the_whole_text_and_decode_to_it():
    enc = tokens.encoding(f"{tokens.TOKENIZER_DIR}/{tokens.RANK_FILE}")
    rnd = random.Random(2)
    long = "".join(rnd.choice(["word", " ", "  ", "\n", "é", "'s", "7", "-", "东"]) for _ in range(60_000))
    for text in [*TEXTS, long, "word " * 40_000, " " * 70_000 + "x", "y" * 70_000]:
        parts = list(tokens.safe_parts(text, 500))
        assert "".join(parts) == text
        got = [i for p in parts for i in enc.encode_ordinary(p)] if len(text) < 200_000 else tokens.encode_text(enc, text)
        assert got == enc.encode_ordinary(text)
        assert tokens.decode_ids(got) == text.encode()
    assert tokens.encode_text(enc, None) == [] and tokens.decode_ids(None) is None


def test_ids_agree_with_the_other_library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    enc = tokens.encoding(f"{tokens.TOKENIZER_DIR}/{tokens.RANK_FILE}")
    assert [t.encode(x, add_special_tokens=False).ids for x in TEXTS] == [tokens.encode_text(enc, x) for x in TEXTS]


def test_encode_frames(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "x"), (3, "", None), (None, "c", "y"), (1, "a b", "x")], "doc_id long, text string, ids string")
    got = tokens.encode(df, "text", ["doc_id"])
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, len(r["ids"])) for r in got.collect()) == [(False, 1, 2), (False, 1, 2), (False, 2, 0), (False, 3, 0), (True, 0, 1)]
    assert rows(tokens.encode(df, "text", ["doc_id"], "n", count_only=True).where("doc_id = 1").distinct()) == [(1, 2)]
    assert [bytes(r["bytes"]) for r in tokens.decode(got.where("doc_id = 1"), "ids", ["doc_id"]).collect()] == [b"a b"] * 2
    assert tokens.encode(df.where("false"), "text", ["doc_id"]).count() == 0


# Packing


def best_fit(sizes, capacity):
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    sizes = [min(64, max(1, int(rnd.expovariate(1 / rnd.choice([3, 20]))))) for _ in range(rnd.randrange(1, 800))]
    histogram = {}
    for s in sizes:
        histogram[s] = histogram.get(s, 0) + 1
    segments, n = packing.plan_runs(histogram, 64)
    used, placed = [0] * n, dict.fromkeys(histogram, 0)
    for size, rank, items, each, first in segments:
        assert rank == placed[size]
        placed[size] += items
        for r in range(items):
            used[first + r // each] += size
    assert placed == histogram and max(used) <= 64 and min(used) > 0
    assert n == best_fit(sizes, 64)


def test_plan_refuses_impossible_sizes():
    assert packing.plan_runs({}, 10) == ([], 0)
    with pytest.raises(ValueError):
        packing.plan_runs({11: 1}, 10)


@pytest.mark.parametrize("how", [packing.pack_runs, packing.pack_sweeps])
def test_pack_keeps_everything(spark, how):
    rnd = random.Random(9)
    data = [(i, rnd.choice([0, 1, 5, 5, 5, 9, 10, 11, 20, 25, None]), 0, 0) for i in range(400)]
    df = spark.createDataFrame([*data, data[1], (None, 4, 0, 0)], "doc_id long, n long, size int, rank int")
    packed = how(df, "doc_id", "n", 10)
    got = packed.collect()
    total = {}
    for r in got:
        assert r["size"] <= 10 and (r["container"] is None) == (r["size"] == 0)
        total.setdefault(r["doc_id"], []).append(r["size"])
    assert {k: sum(v) for k, v in total.items()} == {**{i: n or 0 for i, n, _, _ in data}, None: 4}
    assert all(len(v) == 1 for k, v in total.items() if k is None or (data[k][1] or 0) <= 10)
    held = {}
    for r in got:
        if r["container"] is not None:
            held[r["container"]] = held.get(r["container"], 0) + r["size"]
    assert max(held.values()) <= 10 and set(held) == set(range(len(held)))
    report = packing.fill_report(packed, 10).first()
    assert report["containers"] == len(held) and report["used"] == sum(held.values())
    assert how(df.where("false"), "doc_id", "n", 10).count() == 0
    assert packing.fill_report(how(df.where("false"), "doc_id", "n", 10), 10).first()["containers"] == 0


@pytest.mark.parametrize("capacity, mean", [(2048, 300), (1 << 17, 20_000)])
def test_sweeps_come_near_to_best_fit(spark, capacity, mean):
    rnd = random.Random(5)
    sizes = [min(capacity, max(1, int(rnd.expovariate(1 / mean)))) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n long")
    if capacity > packing.RUN_SIZES:
        with pytest.raises(ValueError):
            packing.pack_runs(df, "doc_id", "n", capacity)
    got = packing.fill_report(packing.pack_sweeps(df, "doc_id", "n", capacity, parts=4), capacity).first()
    assert got["items"] == 4000 and got["used"] == sum(sizes) and got["fullest"] <= capacity
    assert got["containers"] <= best_fit(sizes, capacity) * 1.02 + 4


# Repeated lines

LINES = "source_document string, page_number long, line_number long, content string, confidence double, form string, id int, pages int, key int"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[-1] + 1, last[j + 1] + 1, last[j] + (x != y)))
    return row[-1]


def brute(lines):
    form = {}
    for s, p, n, c, *_ in lines:
        if s is not None and p is not None and c is not None and (f := "".join(ch for ch in c.lower() if ch.isalpha())):
            form.setdefault((s, p, n), set()).add(f)
    texts = {(k[0], f, k[1]) for k, fs in form.items() for f in fs}
    near = lambda a, b: edits(a, b) <= repeats.EDITS
    good = set()
    for s, f in {(s, f) for s, f, _ in texts}:
        if len({p for s2, g, p in texts if s2 == s and near(f, g)}) >= repeats.MIN_PAGES:
            good |= {(s, g) for s2, g, _ in texts if s2 == s and near(f, g)}
    return sorted((k for k, fs in form.items() if any((k[0], f) in good for f in fs)), key=repr)


def test_repeated_lines_against_all_pairs(spark):
    rnd = random.Random(11)
    notices = ["Continued overleaf, typing pool", "Continued overleaf, reading room", "By hand", "All rights stay with the house at Draholt", "All rights stay with the house at Ingford"]

    def noisy(t):
        t = list(t)
        for _ in range(rnd.choice([0, 0, 0, 1, 2])):
            i = rnd.randrange(len(t))
            t[i : i + 1] = rnd.choice(["", "q", t[i] + "z", "5"])
        return rnd.choice([str.upper, str.lower, str])("".join(t)) + rnd.choice(["", ".", " 12"])

    lines = []
    for s in ("a", "b", None):
        for p in [*range(1, 16), None]:
            for n in range(1, 5):
                lines.append((s, p, n, rnd.choice([None, "", " 12 ", noisy(rnd.choice(notices)), noisy(rnd.choice(notices)), "".join(rnd.choice("abcdefgh ") for _ in range(30))]), 0.5, "x", 1, 1, 1))
    df = spark.createDataFrame(lines + lines[:40], LINES)
    got = repeats.repeated_lines(df)
    assert rows(got) == brute(lines)
    dropped = set(rows(got))
    kept = {(s, p) for s, p, n, *_ in lines if (s, p, n) not in dropped}
    assert {(r["source_document"], r["page_number"]) for r in repeats.without_repeats(df).collect()} == kept
    assert repeats.repeated_lines(df.where("false")).count() == 0


def test_light_centres_of_heavier_misreadings(spark):
    clean = "all rights stay with the house"
    variants = [clean, *["xx" + clean[2:]] * 2, *[clean[:i] + "qq" + clean[i + 2 :] for i in (4, 12, 17, 26)]]
    lines = [("a", p, 1, text, 0.5, "x", 1, 1, 1) for p, text in enumerate(variants, 1)]
    assert len(brute(lines)) == 7
    assert rows(repeats.repeated_lines(spark.createDataFrame(lines, LINES))) == brute(lines)


@pytest.mark.parametrize("seed, letters, lengths, most", [(0, "abcdef", (1, 13), 32), (1, "abcdefghiмно", (9, 16), 32), (2, "abcdefgh", (28, 38), 3), (3, "abcdefgh", (14, 30), 1)])
def test_light_notices_against_all_pairs(spark, seed, letters, lengths, most):
    rnd = random.Random(seed)
    notices = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(*lengths))) for _ in range(12)]

    def noisy(t, most):
        t = list(t)
        for _ in range(rnd.randrange(most + 1)):
            i = rnd.randrange(len(t) or 1)
            t[i : i + 1] = rnd.choice(["", "q", *[x + "z" for x in t[i : i + 1]]])
        return "".join(t)

    lines = [(s, p, n, noisy(notices[rnd.randrange(12)], 4), 0.5, "x", 1, 1, 1) for s in "ab" for p in range(1, 36) for n in range(1, 4)]
    forms = repeats.line_forms(spark.createDataFrame(lines, LINES))
    drop = repeats.repeated_forms(forms, most=most)
    assert rows(forms.join(drop, ["source_document", "form"], "left_semi").select("source_document", "page_number", "line_number").distinct()) == brute(lines)


def test_summaries_are_bounded_and_hold_the_heavy(spark):
    lines = spark.range(20_000).selectExpr("'a' AS source_document", "id AS page_number", "if(id % 4 = 0, 'the notice', concat('text ', translate(id, '0123456789', 'abcdefghij'))) AS form")
    assert repeats.leaders(lines, tracked=64, most=8).where("id = xxhash64('a', 'the notice')").count() == 1
    assert len(repeats.summaries(lines, 64).first()["summary"]["sketch"]) < 64 * 40


# Scanned pages

WORDS = "source_document string, page_number long, line_number long, word_number long, content string, confidence double, at int, state string"
BODY = ["the remarkable visitor received an envelope from the doorkeeper of the monastery", "a gentle brother described the orchard and the lay-brother opened the window", "the doorkeeper recovered the remarkable envelope before the gentle visitor"]


def scanned(pages):
    """Words of ``[[line, ...], ...]``."""
    return [("d", p, n, i, w, 0.9, 1, "s") for p, lines in enumerate(pages, 1) for n, line in enumerate(lines, 1) for i, w in enumerate(line.split(" "), 1)]


def test_faults_of_a_scan(spark):
    plain = [["Letters Of The House", *BODY * 3, f"- {p} -"] for p in range(1, 9)]
    plain[2] = ["— 3 —", "LETTERS OF THE H0USE", BODY[0], "a gentle bro-", "ther described the orchard and the lay-", "brother opened the wind¬"]
    plain[3] = ["Letters Of The House 4", "ow of the rernarkable monastery —", "NOTES FROM ABROAD", "the doork6eper recovered the vis", "itor and the enve'lope 1,243", "1,243", "before the mOnastery", "4"]
    words = scanned(plain)
    df = spark.createDataFrame([*words, *words[:50], ("d", 4, 9, 1, None, None, 1, "s"), (None, 1, 1, 1, "x", 0.1, 1, "s"), ("d", None, 1, 1, "x", 0.1, 1, "s")], WORDS)
    got = set(rows(scans.faults(df)))
    heads = {("d", p, 2 if p == 3 else 1, 0, "running_header") for p in range(1, 9)}
    numbers = {("d", p, {3: 1, 4: 8}.get(p, 11), 0, "page_number") for p in range(1, 9)}
    cut = {("d", 3, 4, 3, "broken_word"), ("d", 3, 6, 4, "broken_word"), ("d", 4, 4, 5, "broken_word")}
    wrong = {("d", 4, 2, 4, "misread_word"), ("d", 4, 4, 2, "misread_word"), ("d", 4, 5, 4, "misread_word"), ("d", 4, 7, 3, "misread_word")}
    assert got - wrong == heads | numbers | cut
    assert {("d", 4, 4, 2, "misread_word"), ("d", 4, 5, 4, "misread_word"), ("d", 4, 7, 3, "misread_word")} <= got
    text = {(r["first_page"], r["first_line"]): r["text"] for r in scans.paragraphs(df).collect()}
    assert set(text) == {(1, 2), (4, 4)}
    assert "a gentle brother described the orchard and the lay-brother opened the window of the remarkable" not in text[1, 2]
    assert "opened the window of the" in text[1, 2] and "visitor and the envelope" in text[4, 4]


BOXES = WORDS + ", x0 double, y0 double, x1 double, y1 double"


def boxed(document, pages, indent=0.0):
    """Words of ``{page: [line, ...]}`` with boxes; a line that begins with ``>`` is indented."""
    out = []
    for p, lines in pages.items():
        for n, line in enumerate(lines, 1):
            x = 1.0 + (indent if line.startswith(">") else 0.0)
            for i, w in enumerate(line.lstrip(">").split(" "), 1):
                out.append((document, p, n, i, w, 0.95, 1, "s", x, 0.8 + n * 0.25, x + 0.08 * len(w), 0.95 + n * 0.25))
                x += 0.08 * (len(w) + 1)
    return out


def test_paragraphs_within_and_over_pages(spark):
    full = "the remarkable visitor received an envelope from the old doorkeeper"
    pages = {
        7: ["Letters Of The House", full, full, "and so it ended.", "> A second paragraph began with the visitor and the", full, "7"],
        8: ["Letters Of The House", full, "which then closed.", "Then a third one opened for the remarkable visitor", "8"],
        9: ["Letters Of The House", "Another one opened after the turn of the page and the", full, "NOTES FROM ABROAD", "the text went on below the heading", "9"],
        11: ["Letters Of The House", full, "11"],
    }
    pages[8][3] = "Then a third one opened and it soon closed."
    df = spark.createDataFrame(boxed("d", pages, 0.3) + boxed("e", {3: [full, full]}), BOXES)
    got = {(r["source_document"], r["first_page"], r["first_line"]): (r["last_page"], r["text"]) for r in scans.paragraphs(df).collect()}
    assert set(got) == {("d", 7, 2), ("d", 7, 5), ("d", 8, 4), ("d", 9, 2), ("d", 9, 5), ("d", 11, 2), ("e", 3, 1)}
    assert got["d", 7, 2] == (7, f"{full} {full} and so it ended.")
    assert got["d", 7, 5] == (8, f"A second paragraph began with the visitor and the {full} {full} which then closed.")


def test_the_last_delivery_of_a_word_counts(spark):
    schema = "source_document string, page_number long, line_number long, word_number long, content string, ingested_at timestamp"
    from datetime import datetime

    df = spark.createDataFrame([("d", 1, 1, 1, "a", datetime(2024, 1, 1)), ("d", 1, 1, 1, "z", datetime(2024, 1, 2)), ("d", 1, 1, 1, "b", None), ("d", 1, 1, 2, "y", None)], schema)
    assert [(x["line_number"], x["text"]) for x in scans.page_rows(df).first()["lines"]] == [(1, "z y")]


def test_scans_of_nothing(spark):
    df = spark.createDataFrame([("d", 1, 1, 1, " ", 0.1, 1, "s")], WORDS)
    assert scans.faults(df).count() == 0 and scans.paragraphs(df.where("false")).count() == 0


@pytest.mark.parametrize("times", [1, 10])
def test_misreadings_are_found_at_every_size(spark, times):
    right = {"with": 2454, "visitor": 600, "water": 900, "doctor": 500, "horse": 400, "morning": 500, "that": 2000, "for": 3291, "far": 138, "both": 900, "14th": 40, "12r": 9, "3,100": 5}
    wrong = {"wifh": 20, "visifor": 3, "wafer": 5, "docfor": 3, "harse": 2, "marning": 2, "dactor": 2, "w|th": 100, "B0th": 15}
    counts = spark.createDataFrame([(w, n * times) for w, n in (right | wrong).items()], "core string, n int")
    each = counts.selectExpr("core", "explode(sequence(1, n)) AS i").selectExpr("core AS source_document", "cast(i AS long) AS page_number", "1L AS line_number", "1L AS word_number", "core AS content", "core", "'mid' AS place", "false AS unsure")
    broken = spark.createDataFrame([], "source_document string, page_number long, line_number long, word_number long, next_page long, next_line long, next_word_number long")
    got = {r["core"]: r["word"] for r in scans.misread_types(each, scans.lexicon_of(each), broken).collect()}
    assert got == {"wifh": "with", "visifor": "visitor", "wafer": "water", "docfor": "doctor", "harse": "horse", "marning": "morning", "dactor": "doctor", "w|th": "with", "B0th": "both"}


def codes(page):
    return lm.codes_of([" ".join(words) for words in page])


def test_line_model_is_proper():
    model = lm.fit([codes([["Letters", "Of", "Home"], ["the", "text"], ["the", "text"], ["12"]])] * 30)
    for x in (model[0], *model[1], *[row for table in model[2] for row in table]):
        assert abs(x.sum() - 1) < 1e-9
    page = codes([["—", "l2", "—"], ["NOTES", "SENT"], ["so", "it", "was,"], ["VISITS", "ABROAD"], ["and", "is"]])
    assert [lm.STATES[s] for s in lm.viterbi(page, model)] == ["number", "header", "body", "break", "body"]
    assert lm.viterbi([], model) == [] and (lm.unpack_code(lm.pack_code(lm.unpack_code(lm.np.array(page)))) == lm.unpack_code(lm.np.array(page))).all()


def test_layout_features_of_lines():
    texts = ["Letters Of The House", "the text of a line that goes on.", "Another line", "the end"]
    geo = lm.np.array([[3, 1, 5, 1.2, 0.2, 0, 0.7], [1, 1.9, 7, 2.1, 0.2, 0, 0.3], [1.4, 2.15, 3, 2.35, 0.2, 1, 0.5], [float("nan")] * 7])
    got = lm.page_features(texts, geo)
    assert got[0].tolist() == [4, -1, 1, 2, 0, 1, 1, 1, -1]  # first, gap below, deep, short, usual height, centred, sure
    assert got[1, 1:].tolist() == [1, 0, 0, 2, 1, 0, 1, -1] and got[2, 3] == 1 and got[2, 7] == 0 and got[2, 8] == 1
    assert got[3, 1:8].tolist() == [-1] * 7


def test_line_model_is_fitted_on_all_pages(spark):
    kinds = [["Of Home", "the text", "so it was", "12"], ["the text", "so it was,"], ["7", "NOTES SENT", "the text"]]
    pages = [[line.split() for line in kinds[0 if i % 5 else 1 + i % 2]] for i in range(2500)]
    df = spark.createDataFrame([("d", p, n, i, w, 0.9, 1, "s") for p, lines in enumerate(pages) for n, line in enumerate(lines, 1) for i, w in enumerate(line, 1)], WORDS)
    rows_ = scans.page_rows(df)
    got = lm.fit_pages(rows_.select(lm.line_codes(rows_["lines"]).alias("codes")))
    sure = [lm.codes_of([" ".join(w) for w in page], lm.np.array([[float("nan")] * 5 + [0.0, float("nan")]] * len(page))) for page in pages]
    ruled_out = codes([["4"], ["5"], ["the", "text"], ["it", "was"]])
    assert abs(lm.flat(got) - lm.flat(lm.fit(sure))).max() < 1e-9
    assert (lm.flat(lm.fit(sure)) == lm.flat(lm.fit(sure + [ruled_out] * 9))).all()
    empty = scans.page_rows(df.where("false"))
    assert abs(lm.flat(lm.fit_pages(empty.select(lm.line_codes(empty["lines"]).alias("codes")))) - lm.flat(lm.start_values())).max() == 0


# Reading levels


def passage(band, rnd):
    hard = [["cat", "red", "bed", "ran"], ["lunch", "friendly", "quiet", "market"], ["chaplain", "received", "promise", "journey"], ["regulation", "deposited", "testimony", "provincial"], ["prosopographical", "hermeneutic", "adjudicated", "provenance"]][band - 1]
    n = [5, 8, 13, 18, 24][band - 1]
    return ". ".join(" ".join(rnd.choice([*hard, "the", "a", "and", "of", "was"]) for _ in range(n)) for _ in range(40 // n + 6)) + "."


def test_held_out_levels(spark):
    rnd = random.Random(4)
    train = spark.createDataFrame([(i, i % 5 + 1, passage(i % 5 + 1, rnd)) for i in range(100)], "passage_id long, band long, passage string")
    texts = [passage(i % 5 + 1, rnd) for i in range(100)]
    extra = [None, "", "  \n ", "Il convento " * 60, "12 13 14 " * 40, "the cat ran", ("Ford 12.50\n" * 50), texts[0].replace(".", ""), texts[3].upper()]
    df = spark.createDataFrame([(i, t, 1, 1) for i, t in enumerate([*texts, *extra])] + [(0, texts[0], 1, 1)], "doc_id long, text string, band int, ids int")
    got = {r["doc_id"]: r["band"] for r in levels.levels(df, train).collect()}
    assert set(got) == {*range(100), 107, 108}
    assert sum(got[i] == i % 5 + 1 for i in range(100)) >= 97 and got[107] == 1 and got[108] == 4
    words = {r["word"]: r["difficulty"] for r in levels.word_difficulty(df, train).collect()}
    assert words["cat"] < 1.5 < 2.5 < words["chaplain"] < 3.5 < words["hermeneutic"]
    assert levels.levels(df.where("false"), train).count() == 0 and levels.levels(df, train.where("false")).count() == 0


def test_queries_are_named_after_their_problems():
    assert all(name.split("_")[0] in {"p4", "p5", "p7", "p8", "p9"} for name in queries.queries())
    assert set(queries.oracle_sql()) <= set(queries.queries())


DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW ocr_lines AS SELECT * FROM '{DATA}/ocr_lines.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, DATA).toPandas()[list(want.columns)]
    assert sorted(map(repr, got.astype(str).values.tolist())) == sorted(map(repr, want.astype(str).values.tolist()))
