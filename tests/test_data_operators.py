"""Drift, shredding, compaction and orphans on small cases with nulls, repeats, ties, empty tables and clashing columns."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vellumry.operators import compact, drift, orphans, shred
from vellumry.scale import carry_in_groups, dense_id, lag_in_groups, rank_in_groups
from vellumry.sources import versions

T0 = datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Drift


def files(spark, items):
    return spark.createDataFrame([(i, s, f"{s}/{i}.json", T0 + timedelta(days=d) if d is not None else None, T0, b, 1, 2) for i, s, d, b in items], "file_id long, series string, file_name string, exported_at timestamp_ntz, received_at timestamp_ntz, body string, pair int, observed int")


def test_changes_between_files(spark):
    a = [{"error_id": 1, "ctx": {"line_text": "one two"}, "n": 4}, {"error_id": 2, "ctx": {"line_text": "three"}, "n": 5}]
    b = [{"error_id": 1, "context": {"text": "one two"}, "n": "4"}, {"error_id": 2, "context": {"text": "three"}, "n": "5"}, {"error_id": 3, "context": None, "n": None, "new": True}]
    c = "\n".join(json.dumps({"error_id": i, "context": ["one", "two"] if i == 1 else ["three"], "new": None}) for i in (1, 2))
    got = drift.changes(drift.ingest(files(spark, [(1, "s", 0, json.dumps({"errors": a})), (2, "s", 3, json.dumps(b)), (9, "s", 1, "[{"), (8, "s", 2, None), (7, "s", 2, '{"errors": []}'), (3, "s", 4, c), (3, "s", 4, c), (5, None, 4, "[]"), (6, "t", None, json.dumps(a))])))
    assert rows(got) == sorted([(2, "ctx", "renamed"), (2, "ctx.line_text", "renamed"), (2, "n", "type_changed"), (2, "new", "added"), (3, "context", "type_changed"), (3, "n", "removed")], key=repr)


def test_a_field_renamed_and_retyped(spark):
    a = [{"error_id": i, "images": {"context": f"c{i}", "error": f"e{i}"}} for i in range(4)]
    b = [{"error_id": i, "crops": f"c{i};e{i}"} for i in range(4)]
    assert rows(drift.changes(drift.ingest(files(spark, [(1, "s", 0, json.dumps(a)), (2, "s", 1, json.dumps(b))])))) == [(2, "images", "renamed"), (2, "images", "type_changed")]


def test_rescue_and_replay(spark):
    body = json.dumps([{"error_id": "7", "page_number": "x", "offset_in_page": 12.0, "ctx": ["a", "b"], "extra": [1]}, {"error_id": 1.5, "context": {"line_text": "t"}}])
    got = drift.ingest(files(spark, [(1, "s", 0, body)]))
    first, second = sorted(got.collect(), key=lambda r: r["record_no"])
    assert first["error_id"] == 7 and first["page_number"] is None and json.loads(first["rescued"]) == {"page_number": "x", "offset_in_page": 12.0, "ctx": ["a", "b"], "extra": [1]}
    assert second["error_id"] is None and json.loads(second["rescued"]) == {"error_id": 1.5, "context.line_text": "t"}
    approved = {**drift.DEFAULT, "ctx": "context", "offset_in_page": "character_number"}
    first, second = sorted(drift.promote(got, approved).collect(), key=lambda r: r["record_no"])
    assert (first["character_number"], first["context"], json.loads(first["rescued"])) == (12, "a b", {"page_number": "x", "extra": [1]})
    assert second["context"] == "t"


def test_names_are_approved_from_the_renames_found(spark):
    ids = range(1, 4)
    bodies = [
        [{"error_id": i, "character_number": 40 + i, "context": {"line_text": f"t{i}"}, "images": {"context": f"c{i}", "error": f"e{i}"}, "x.y": i} for i in ids],
        [{"error_id": i, "start.at": 40 + i, "context": f"t{i}", "pics": {"context": f"c{i}", "word": f"e{i}"}, "x.y": i} for i in ids],
        [{"error_id": i, "start.at": float(40 + i), "around": {"text": f"t{i}"}, "pics": {"line": f"c{i}", "word": f"e{i}"}, "z.y": i} for i in ids],
    ]
    got = drift.ingest(files(spark, [(n, "s", n, json.dumps(b)) for n, b in enumerate(bodies)] + [(3, "t", 0, json.dumps([{"error_id": 9, "pics": {"word": "w"}, "z.y": 5}]))]))
    found = drift.comparisons(got)
    assert {(r["file_id"], r["field"], r["change"]) for r in drift.changes(got).collect()} == {
        (1, "character_number", "renamed"), (1, "context", "type_changed"), (1, "images", "renamed"), (1, "images.error", "renamed"),
        (2, "start.at", "type_changed"), (2, "context", "renamed"), (2, "context", "type_changed"), (2, "pics.context", "renamed"), (2, "x.y", "renamed"),
    }
    approved = drift.approvals(drift.drift_links(found))
    assert approved == {
        "character_number": "character_number", "start\\.at": "character_number", "context": "context", "context.line_text": "context", "around": "context", "around.text": "context",
        "images.context": "image_context", "pics.context": "image_context", "pics.line": "image_context", "images.error": "image_error", "pics.word": "image_error",
        **{c: c for c in ("error_id", "error_type", "source_document", "page_number", "line_number", "word_number", "error", "image_context", "image_error")},
    }
    typed = {(r["file_id"], r["error_id"]): (r["character_number"], r["context"], r["image_context"], r["image_error"], json.loads(r["rescued"])) for r in drift.promote(got, approved).collect()}
    for n in range(3):
        for i in ids:
            assert typed[n, i] == (40 + i, f"t{i}", f"c{i}", f"e{i}", {"x\\.y" if n < 2 else "z\\.y": i})
    assert typed[3, 9] == (None, None, None, "w", {"z\\.y": 5})


def test_every_file_has_a_status(spark):
    bodies = [None, " ", "[{", "[]", '{"errors": null}', '{"errors": []}', '{"errors": [{"a": 1}]}', '[{"a": 1}, {"b": 2}]', '{"a": 1}\n{"a": 2}']
    df = files(spark, [(i, "s", i, b) for i, b in enumerate(bodies)] + [(8, "s", 8, bodies[8])])
    want = ["null", "blank", "unreadable", "no records", "no records", "no records", "read", "read", "read"]
    assert rows(drift.statuses(df)) == [(i, w, n) for i, (w, n) in enumerate(zip(want, [0] * 6 + [1, 2, 2]))]


def test_no_files(spark):
    none = drift.ingest(files(spark, []).where("false"))
    assert drift.changes(none).count() == 0 and drift.promote(none).count() == 0
    assert drift.approvals(drift.drift_links(drift.comparisons(none)))["images.error"] == "image_error" and drift.statuses(files(spark, []).where("false")).count() == 0


# Shredding


READS = "read_id long, source_document string, file_path string, pages array<struct<pagenumber:bigint,words:array<struct<content:string,polygon:array<double>,confidence:double,span:struct<offset:bigint,length:bigint>>>,lines:array<struct<content:string,polygon:array<double>,spans:array<struct<offset:bigint,length:bigint>>>>>>, received_at timestamp_ntz, node string, _k int"


def word(at, n=2):
    return ("w", [0.0, 1.0, 2.0], 0.5, (at, n) if at is not None else None)


def test_words_to_lines(spark):
    lines = [("a", None, [(0, 10), (50, 5)]), ("b", [], [(8, 10_000_000)]), ("c", None, None), ("d", None, [(3, None), (None, 4), (20, 0)])]
    page = (1, [word(0), word(8), word(None), word(52), ("x", None, None, None), word(9_999_999), None, word(11_000_000)], lines)
    other = (None, [word(5)], [])
    df = spark.createDataFrame([(1, "d", "p", [page, None, (2, None, lines), other], T0, "n", 1), (1, "d", "p", [page, None, (2, None, lines), other], T0, "n", 1), (1, "d", "p", [other], T0 - timedelta(days=1), "n", 1), (2, "d", "p", None, None, "n", 1), (3, "d", "p", [], T0, "n", 1)], READS)
    got = rows(shred.words_to_lines(df))
    assert got == sorted([(1, 0, 0, 0), (1, 0, 1, 1), (1, 0, 2, -1), (1, 0, 3, 1), (1, 0, 4, -1), (1, 0, 5, 1), (1, 0, 6, -1), (1, 0, 7, -1), (1, 3, 0, -1)], key=repr)
    tables = shred.read_tables(df)
    assert rows(tables["pages"]) == sorted([(1, 0, 1), (1, 1, None), (1, 2, 2), (1, 3, None)], key=repr)
    assert tables["words"].count() == 9 and tables["lines"].count() == 8
    assert (1, 0, "word", 0, 1, 2.0, None) in rows(tables["points"])
    assert shred.words_to_lines(df.where("false")).count() == 0


def test_words_to_lines_against_all_pairs(spark):
    rnd = random.Random(5)
    reads, want = [], []
    for r in range(12):
        words = [rnd.choice([None, rnd.randrange(0, 400)]) for _ in range(60)]
        lines = [[(rnd.randrange(0, 400), rnd.choice([0, 3, 40, 64, 65, 900])) for _ in range(rnd.randrange(0, 3))] for _ in range(15)]
        reads.append((r, "d", "p", [(1, [word(w) for w in words], [("l", None, s) for s in lines])], T0, "n", 1))
        want += [(r, 0, i, max([-1, *(k for k, s in enumerate(lines) for o, n in s if w is not None and o <= w < o + n)])) for i, w in enumerate(words)]
    assert rows(shred.words_to_lines(spark.createDataFrame(reads, READS))) == sorted(want, key=repr)


# Small files


def page_body(page, pdf="/a/Bundle_1.PDF", **more):
    return {"page_number": page, "source_pdf": pdf, "width_points": 1.0, **more}


SIZES = "file_id long, file_path string, written_at timestamp_ntz, n_bytes long, body string, bin int, record string"


def test_compaction(spark):
    items = [
        (1, json.dumps(page_body(1)), 0), (2, json.dumps([page_body("001"), page_body(2.0, "c:\\x\\bundle_1.pdf")]), 1), (3, json.dumps(page_body(2)), 1), (4, json.dumps(page_body(3))[:-4], 9), (5, None, 9), (6, "", 9), (7, "[]", 9),
        (8, json.dumps([page_body(None), page_body(1, None), page_body(2.5), page_body("x"), 5, None]), 9), (9, json.dumps(page_body(1, "")), 9), (3, json.dumps(page_body(2)), 1), (10, json.dumps(page_body(7)), None),
    ]
    df = spark.createDataFrame([(i, "p", T0 + timedelta(days=d) if d is not None else None, 1, b, 0, "r") for i, b, d in items], SIZES)
    kept, folder = compact.compact(df, target_bytes=60)
    assert rows(kept.select("source_document", "page_number", "file_id")) == [("bundle_1", 1, 2), ("bundle_1", 2, 3), ("bundle_1", 7, 10)]
    assert versions.current(spark, folder) == 1 and kept.select("bin").distinct().count() >= 1
    assert compact.compact(df.where("false"))[0].count() == 0


def test_compaction_of_real_files(spark, tmp_path, monkeypatch):
    for i in range(3000):
        at = tmp_path / "in" / f"d{i % 7}"
        at.mkdir(parents=True, exist_ok=True)
        (at / f"{i}.json").write_text(json.dumps(page_body(i, f"/x/Vol_{i % 3}.pdf", note="n" * (i % 50))) if i % 100 else "{cut")
    files = compact.list_files(spark, f"file://{tmp_path}/in")
    to = f"file://{tmp_path}/out"
    kept, _ = compact.compact(files, to, target_bytes=8192)
    assert kept.count() == 2970 and {r["page_number"] for r in kept.collect()} == {i for i in range(3000) if i % 100}
    written = [p for p in (tmp_path / "out/v1/records").rglob("*.parquet")]
    bins = sorted(r["bin"] for r in kept.select("bin").distinct().collect())
    assert bins == list(range(len(bins))) and len(written) == len(bins) > 3 and len({p.parent for p in written}) == 1
    # a run that breaks off before its marker leaves the version before as it was
    monkeypatch.setattr(compact, "sums_of", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        compact.compact(files, to, target_bytes=8192)
    assert versions.current(spark, to) == 1 and versions.read(spark, to, "records").count() == 2970


def test_first_fit_decreasing():
    assert compact.first_fit_decreasing([], 10) == []
    sizes = [7, 5, 5, 3, 12, 0, 10]
    bins = compact.first_fit_decreasing(sizes, 10)
    held = {}
    for s, b in zip(sizes, bins):
        held[b] = held.get(b, 0) + s
    assert sorted(held.values()) == [10, 10, 10, 12]


# Orphans


def reason_of(c, entries):
    doc, page, line, number, at = c
    if None in (doc, page, line, number):
        return "incomplete"
    key = (doc.strip().lower().removesuffix(".pdf").replace("_", "").replace("-", "").replace(" ", ""), page, line, number)
    for n, level in enumerate(["document", "page", "line", "word"], 1):
        if not any(e[0][:n] == key[:n] for e in entries):
            return level
    here = [e for e in entries if e[0] == key and e[1] is not None and at is not None and e[1] <= at]
    if not here:
        return "late"
    return "withdrawn" if all(e[2] is not None and e[2] <= at for e in here) else None


def tables(spark, refs, entries):
    c = spark.createDataFrame([(i, d, p, l, w, "x", t, T0, "m", 1) for i, (d, p, l, w, t) in enumerate(refs)], "correction_id long, source_document string, page_number long, line_number long, word_number long, corrected string, submitted_at timestamp_ntz, loaded_at timestamp_ntz, missing string, refs int")
    e = spark.createDataFrame([(i, k[0], k[1], k[2], k[3], a, b, 1) for i, (k, a, b) in enumerate(entries)], "error_id long, source_document string, page_number long, line_number long, word_number long, exported_at timestamp_ntz, withdrawn_at timestamp_ntz, at int")
    return c, e


def test_orphans_against_brute_force(spark):
    rnd = random.Random(3)
    when = lambda: rnd.choice([None, *(T0 + timedelta(hours=h) for h in range(0, 200, 7))])
    entries = [((rnd.choice(["d1", "d2"]), rnd.randrange(1, 3), rnd.randrange(1, 4), rnd.randrange(1, 4)), when(), when()) for _ in range(60)]
    refs = [(rnd.choice(["D_1.pdf", " d 1", "d-2.PDF", "d9", None, ""]), rnd.choice([1, 2, 3, None]), rnd.choice([1, 2, 3, 4]), rnd.choice([1, 2, 3, 4]), when()) for _ in range(400)]
    c, e = tables(spark, refs, entries)
    got = {r["correction_id"]: r["reason"] for r in orphans.orphans(c.union(c), e.union(e)).collect()}
    assert got == {i: r for i, ref in enumerate(refs) if (r := reason_of(ref, entries))}
    # increments in any order, late and repeated, give the state of one run
    state = orphans.OrphanState(spark)
    asked, came = orphans.references_of(c), orphans.parents_of(e)
    for i in (2, 0, 1, 1):
        state.advance(asked.where(F.col("_id") % 3 == i).unionByName(asked.where("_id < 5")), came.where((F.col("error_id") * 7) % 3 == i))
    assert {r["correction_id"]: r["reason"] for r in state.orphans().collect()} == got and state.references().count() == len(refs)
    assert {r["correction_id"]: r["reason"] for r in orphans.replay(c, e).orphans().collect()} == got


def test_moments_and_empty_tables(spark):
    k = ("a", 1, 1, 1)
    c, e = tables(spark, [("a", 1, 1, 1, T0), ("a", 1, 1, 1, T0 + timedelta(days=1)), ("a", 1, 1, 1, T0 - timedelta(seconds=1))], [(k, T0, T0 + timedelta(days=1))])
    found = orphans.orphans(c, e)
    assert rows(found.select("correction_id", "reason")) == [(1, "withdrawn"), (2, "late")]
    assert {r["reason"] for r in orphans.orphans(c, e.where("false")).collect()} == {"document"}
    assert orphans.orphans(c.where("false"), e).count() == 0
    assert orphans.replay(c.where("false"), e.where("false")).orphans().count() == 0
    assert rows(orphans.open_by_month(orphans.replay(c, e))) == [("2023-12", 1), ("2024-01", 3)]
    assert rows(orphans.orphan_counts(found, "corrections")) == [("corrections", "2023-12", "late", 1), ("corrections", "2024-01", "withdrawn", 1)]


# Plumbing


def test_ranks_and_lags(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["a", "b", None]), i, T0 + timedelta(hours=rnd.randrange(300))) for i in range(300)]
    df = spark.createDataFrame(data, "g string, id long, t timestamp_ntz")
    ranked = rank_in_groups(df, ["g"], ["id"], "r", 8).collect()
    for g in ("a", "b", None):
        assert sorted(r["r"] for r in ranked if r["g"] == g) == list(range(sum(x[0] == g for x in data)))
    assert [r["n"] for r in dense_id(df, ["t", "id"], "n").orderBy("t", "id").collect()] == list(range(300))
    some = df.withColumn("v", F.when(F.col("id") % 9 == 0, F.col("id")))
    carried = {r["id"]: r["before_v"] for r in carry_in_groups(some, "g", "id", "v", F.floor(F.col("id") / 40)).collect()}
    assert carried == {i: max((j for x, j, _ in data if x == g and j < i and j % 9 == 0), default=None) for g, i, _ in data if g is not None} | {i: carried[i] for g, i, _ in data if g is None}
    got = {r["id"]: r["prev_id"] for r in lag_in_groups(df, "g", "t", ["id"], ["id"], F.to_date("t")).collect()}
    for g in ("a", "b", None):
        order = [i for _, i in sorted((t, i) for x, i, t in data if x == g)]
        assert all(got[b] == a for a, b in zip([None, *order], order))


@pytest.mark.parametrize("text", ["", "x", "[1]", "{", '{"errors": 3}', "null", "[" * 100_000])
def test_odd_bodies(text):
    got = drift.parse_records(text)
    assert got is None or isinstance(got, list)
