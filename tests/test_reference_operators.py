"""Reference operators: quirks, golden values, properties, and every query with SQL against DuckDB on the smallest tables."""

import json
import math
import os
import zlib
from datetime import datetime, timedelta
from functools import reduce

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.functions import geometry as g
from vellumry.functions import maps, text
from vellumry.operators import corrections, errors, labels, lines, orphans, pages, polygons, raster
from vellumry.plans import catalog
from vellumry.sources import artifacts, documents, ocr_json, pdf, sinks, versions
from vellumry.streaming import orphans as stream_orphans
from vellumry.streaming import polygons as stream_polygons

DATA = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


def cell(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, float):
        return str(int(x)) if x == int(x) else repr(round(x, 9))
    return str(x)


def table(df):
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA) if os.path.isdir(DATA) else []:
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_against_sql(spark, duck, name):
    got, want = catalog.queries()[name](spark, DATA).toPandas(), duck.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got) == table(want)


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_rounding_is_half_to_even(spark):
    r = one(spark, g.points_to_pixels(F.lit(2550.0)), g.points_to_pixels(F.lit(3300.0)), g.points_to_inches(F.lit(2550.0)), g.points_to_pixels(F.lit(2535.0)), g.points_to_pixels(F.lit(3278.0)))
    assert tuple(r) == (5312, 6875, 35.4167, 5281, 6829)


def test_matches_of_dots(spark):
    r = one(spark, *[text.match_offsets(F.lit(t), p) for t, p in (("....", "..."), ("....", ".."), ("a=b=", "="), ("", "="), ("..x..", ".."))])
    assert tuple(map(list, r)) == ([0], [0, 2], [1, 3], [], [0, 3])


@pytest.mark.parametrize("line,find,put,want", [("a b a", "a", "x", "x b a"), ("abc", "z", "x", "abc"), ("abc", "", "x", "xabc"), ("a.b", ".", "$1", "a$1b"), ("ab", "b", "", "a")])
def test_replace_first(spark, line, find, put, want):
    assert one(spark, text.replace_first(F.lit(line), F.lit(find), F.lit(put)))[0] == want


def test_hotword_categories(spark):
    df = spark.createDataFrame([(w,) for w in ("O.F.M.CAP.", "C.I.C.M.", "Notebook", "O.", "nothing")], "content string")
    rule = errors.word_rules()[3]
    assert {r[0]: r[1] for r in df.where(rule.holds).select("content", rule.kind).collect()} == {"O.F.M.CAP.": "hotword_general", "C.I.C.M.": "hotword_abbreviations", "Notebook": "hotword_all-caps", "O.": "hotword_short-words"}


WORDS = "source_document string, page_number long, line_number long, word_number long, content string, confidence double, span_offset long, span_length long, x0 double, y0 double, x1 double, y1 double, line int, all int"


def test_lines_and_errors_of_odd_words(spark):
    df = spark.createDataFrame([("d", 1, 1, 1, "a..", 0.5, 0, 3, 1.0, 1.0, 2.0, 1.1, 0, 0), ("d", 1, 1, 1, "a..", 0.5, 0, 3, 1.0, 1.0, 2.0, 1.1, 0, 0), ("d", 1, 1, 2, None, None, None, None, 0.0, 1.12, 0.5, 1.2, 0, 0), ("d", 1, 2, 1, "c-", 0.95, 9, 1, 1.0, 1.3, 2.0, 1.35, 0, 0), ("d", None, 2, 1, "x", 0.1, 9, 1, 1.0, 1.3, 2.0, 1.4, 0, 0), ("d", 1, 2, 2, "y", 0.1, 9, 1, None, 1.3, 2.0, 1.4, 0, 0)], WORDS)
    got = sorted((r["line"], r["pos"], r["content"]) for r in lines.group_lines(df).collect())
    assert got == [(1, 1, None), (1, 2, "a.."), (2, 1, "c-")]
    assert [(r["error_type"], r["word_number"]) for r in errors.errors_all(df).orderBy("error_id").collect()] == [("low_confidence", 2), ("hyphenated_word", 1), ("small_token", 1), ("ellipsis_2", -1)]
    assert errors.errors_all(df.where("false")).count() == 0


def test_corrections_last_record_and_order(spark):
    e = spark.createDataFrame([(1, "d", 1, 1, 1, "t", "cat", ("the cat cat",), T0), (2, "d", 1, 1, 1, "t", "cat", ("the cat cat",), T0), (3, "d", 1, 1, 2, "t", None, None, T0)], "error_id long, source_document string, page_number long, line_number long, word_number long, error_type string, error string, context struct<line_text:string>, exported_at timestamp_ntz")
    c = spark.createDataFrame([(2, "d", 1, 1, 1, "dog", T0 + timedelta(1)), (1, "d", 1, 1, 1, "hat", T0), (1, "d", 1, 1, 1, "hat", T0), (3, "d", 1, 1, 2, "x", T0), (4, "d", 9, 1, 2, "x", T0), (5, None, 1, 1, 1, "x", T0), (6, "d", 1, 1, 1, None, T0)], "correction_id long, source_document string, page_number long, line_number long, word_number long, corrected string, submitted_at timestamp_ntz")
    got = {r["error_id"]: (r["corrected_text"], r["corrections"]) for r in corrections.apply(c, e).collect()}
    assert got == {1: ("the cat cat", 0), 2: ("the hat dog", 2), 3: (None, 1)}
    assert sorted(r["correction_id"] for r in corrections.unmatched(c, e).collect()) == [4, 5]
    with pytest.raises(KeyError):
        corrections.apply(c, e, on_missing="error")


@pytest.mark.parametrize("total,start,end,swapped,collapsed", [(9, None, None, list(range(1, 10)), list(range(1, 10))), (9, 7, 5, [5, 6, 7], [5]), (9, 12, None, [9], [9]), (9, 12, 15, [], []), (9, -2, 2, [1, 2], [1, 2])])
def test_page_scopes(spark, total, start, end, swapped, collapsed):
    i = lambda v: F.lit(v).cast("int")
    r = one(spark, pages.scope_swapped(i(total), i(start), i(end)), pages.scope_collapsed(i(total), i(start), i(end)))
    assert (list(r[0]), list(r[1])) == (swapped, collapsed)


def test_chunks(spark):
    df = spark.createDataFrame([(1, p) for p in (1, 2, 3, 4, 5, 9, 10, 20)], "d int, page int")
    got = {}
    for r in pages.chunks(df, ["d"], size=2).collect():
        got.setdefault(r["chunk"], []).append(r["page"])
    assert [sorted(got[k]) for k in sorted(got)] == [[1, 2], [3, 4], [5], [9, 10], [20]]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-300, 300), st.integers(-300, 300)), min_size=3, max_size=6))
def test_polygon_properties(spark, points):
    p = F.array(*[g.point(F.lit(float(x)), F.lit(float(y))) for x, y in points])
    w, h = F.lit(200), F.lit(100)
    r = one(spark, g.back_on_page(p, w, h), g.saved(p, w, h), g.saved(g.saved(p, w, h), w, h), g.eight_points(p))
    assert all(0 <= q["x"] <= 199 and 0 <= q["y"] <= 99 for q in r[0])
    assert r[1] == r[2]
    kept = [(q["x"], q["y"]) for q in r[3]]
    assert kept[:: 2 if len(points) == 4 else 1] == [(float(x), float(y)) for x, y in points]


def test_null_polygons(spark):
    p = F.lit(None).cast("array<struct<x:double,y:double>>")
    r = one(spark, g.validated(p, F.lit(5), F.lit(5))["error"], g.saved(p, F.lit(5), F.lit(5)), labels.closed(p))
    assert tuple(r) == (g.TOO_FEW, None, None)


def test_json_layouts_and_sinks(spark, tmp_path):
    page = {"pageNumber": 9, "words": [{"content": "w", "polygon": [1, 2], "confidence": 0.5, "span": {"offset": 3, "length": 1}}, {"content": "v"}], "lines": []}
    for path, body in {"a/D/page-2/read.json": {"pages": [page, page]}, "a/_analysis1/page-1/read.json": {"pages": [page]}, "a/D/page-x/read.json": {"pages": [page]}, "b/f1/page_1.json": {"pages": [page]}, "b/f1/page_2.json": {"pages": [page, page]}, "b/f2/page_3.json": {"pages": []}, "c/X.pdf.json": {"pages": [page, page, page]}, "e/D/page_sizes/page_001.json": {"page_number": 1, "width_points": 2550.0}}.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(json.dumps(body))
    a = ocr_json.read_page_folders(spark, f"{tmp_path}/a")
    assert [(r["document"], r["page_number"]) for r in a.collect()] == [("D", 2)]
    assert [(r["content"], r["span_offset"]) for r in ocr_json.words_of(a, ["document"]).orderBy("seq").collect()] == [("w", 3), ("v", None)]
    kept, rejected = ocr_json.read_page_files(spark, f"{tmp_path}/b", ["f2", "f1", "nowhere"])
    assert [(r["folder"], r["page_number"]) for r in kept.collect()] == [("f1", 1)] and sorted(r["pages"] for r in rejected.collect()) == [0, 2]
    assert [r["page_number"] for r in ocr_json.read_documents(spark, f"{tmp_path}/c", 2).collect()] == [1, 2]
    assert ocr_json.read_page_records(spark, f"{tmp_path}/e", "page_sizes").first()["width_points"] == 2550.0
    df = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a")], "source_document string, error_id int, error string")
    errors_ = spark.createDataFrame([("d", p, i, e) for p in (1, 2, 10) for i, e in ((2, 'b"'), (1, None))] + [("c", 1, 3, "é")], "source_document string, page_number int, error_id int, error string")
    pieces = sinks.error_pieces(errors_, ["error_id", "error"], ["error_id"])
    assert sinks.write_error_file(pieces, f"file://{tmp_path}/errors.json") == 7
    assert [e["error_id"] for e in json.loads((tmp_path / "errors.json").read_text())["errors"]] == [3, 1, 2, 1, 2, 1, 2]
    sinks.write_errors_by_document(errors_, f"file://{tmp_path}/by_document")
    assert sorted(p.name for p in (tmp_path / "by_document").iterdir() if p.is_dir()) == ["source_document=c", "source_document=d"]
    sinks.write_errors(errors_, f"file://{tmp_path}/lines")
    assert spark.read.json(f"file://{tmp_path}/lines").count() == 7
    bodies = sinks.page_bodies(spark.createDataFrame([("D", 7), ("E", 1)], "document string, page_number int"))
    assert {r["n_bytes"] for r in sinks.write_bodies(bodies, f"file://{tmp_path}/pages").collect()} == {17}
    assert json.loads((tmp_path / "pages/D/page_007.json").read_text()) == {"page_number": 7}
    at = f"file://{tmp_path}/t"
    df.write.parquet(at)
    sinks.replace_table(spark.read.parquet(at).where("error_id = 1"), at)
    assert sinks.read_table(spark, at).count() == 1
    sinks.replace_table(sinks.read_table(spark, at).unionByName(df), at)
    assert sinks.read_table(spark, at).count() == 3
    df.write.parquet(f"{at}/v3/table")  # a writer that died before its marker
    assert sinks.read_table(spark, at).count() == 3 and versions.current(spark, at) == 2
    with pytest.raises(Exception, match="already exists|FileAlreadyExists"):
        versions.mark(spark, at, 2)
    assert sinks.page_bodies(spark.createDataFrame([("D", 7)], "document string, page_number int")).first()["path"] == "D/page_007.json"


def test_pdf_pages_and_services(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"%PDF-1.4\n1 0 obj\n<< /Type /Pages /MediaBox [0 0 612 792] >>\nendobj\n2 0 obj << /Type /Page /MediaBox [0 0 2550 3300] >> endobj\n3 0 obj << /Type /Page >> endobj")
    (tmp_path / "y.pdf").write_bytes(b"none")
    files = documents.read_files(spark, f"file://{tmp_path}")
    assert sorted(tuple(r) for r in documents.read_page_boxes(files).collect()) == [("x.pdf", 1, 2550.0, 3300.0), ("x.pdf", 2, 612.0, 792.0)]

    def client(content, n):
        if not bytes(content).startswith(b"%PDF"):
            raise ValueError("no pdf")
        return "{}"

    assert {r["name"]: r["error"] for r in documents.recognise(files, client).collect()} == {"x.pdf": None, "y.pdf": "no pdf"}
    with pytest.raises(KeyError):
        documents.credentials("VELLUMRY_NOT_SET")


def test_orphans_over_a_stream(spark, tmp_path):
    key = ("d.pdf", 1, 1, 1)
    schema = "source_document string, page_number long, line_number long, word_number long, {}"
    steps = [([T0, T0 + timedelta(5)], []), ([], [(T0 + timedelta(2), None)]), ([T0, T0 + timedelta(1)], [(T0 + timedelta(1), T0 + timedelta(4)), (T0 + timedelta(2), None)]), ([], [(T0 + timedelta(2), T0 + timedelta(5))])]
    all_refs, all_entries = [], []
    state = orphans.OrphanState(spark, f"file://{tmp_path}/state")
    for i, (refs, entries) in enumerate(steps):
        r = spark.createDataFrame([(*key, t, t.day) for t in refs], schema.format("submitted_at timestamp_ntz, correction_id long"))
        e = spark.createDataFrame([(*key, a, b, a.day) for a, b in entries], schema.format("exported_at timestamp_ntz, withdrawn_at timestamp_ntz, error_id long"))
        all_refs.append(r)
        all_entries.append(e)
        stream_orphans.events(r, e).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        src = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
        q = src.writeStream.foreachBatch(stream_orphans.tracker(state)).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        q.awaitTermination(120)
        want = orphans.orphans(reduce(DataFrame.unionByName, all_refs), reduce(DataFrame.unionByName, all_entries))
        assert sorted(map(tuple, state.orphans().collect())) == sorted(map(tuple, want.collect()))
    assert {r["reason"] for r in state.orphans().collect()} == {"late"}


def test_polygons_from_a_stream(spark, tmp_path):
    at = f"file://{tmp_path}/polygons"
    point = "array<struct<x:double,y:double>>"
    spark.createDataFrame([(1, 100, 100, 150, [(10.0, 10.0)]), (2, 100, 100, 150, [(10.0, 10.0)])], f"page int, page_width int, page_height int, render_dpi int, polygon {point}").write.parquet(at)
    batch = spark.createDataFrame([(1, 200, 100, 150), (3, 100, 100, 150)], "page int, page_width int, page_height int, render_dpi int")
    for i in range(2):
        stream_polygons.merger(at, ["page"])(batch, i)
    got = {r["page"]: (r["polygon"][0]["x"], len(r["polygon"])) for r in sinks.read_table(spark, at).collect()}
    assert got == {1: (20.0, 1), 2: (10.0, 1), 3: (172.0, len(g.DEFAULT_POLYGON))}
    assert polygons.PATCH_FROM == 61


def test_polygons_fill_their_outline_too():
    box = raster.fill([np.array([(1, 2), (5, 2), (5, 6), (1, 6)], dtype=float)], 8, 8)
    assert box.sum() == 25 and box[2:7, 1:6].all()
    both = raster.fill([np.array([(1, 2), (5, 2), (5, 6), (1, 6)]) * 1.0, np.array([(0, 0), (1, 0), (0, 1)]) * 1.0, np.array([(7, 7), (0, 7)]) * 1.0, np.array([(-5, 7), (20, 7), (20, 7)]) * 1.0], 8, 8)
    assert both.sum() == 25 + 3 + 8


@pytest.mark.parametrize("angle", [-12.0, -4.0, 3.0, 9.0])
def test_a_turned_page_is_found_and_turned_back(angle):
    page = np.zeros((240, 200))
    page[60:180, 40:160:6] = 255
    page[60, 40:160] = page[179, 40:160] = 255
    turned = raster.rotate(page, angle)
    n, seen = raster.skew_angle(np.where(turned > 127, 255, 0))
    # rows stand for x, as in the rule that is applied to it
    assert n > raster.SPARSE and min(abs(seen % 90 - t % 90) for t in (angle, angle + 90, angle - 90)) < 1.0
    back, decision, turn = raster.deskewed(np.where(turned > 127, 255, 0))
    assert decision == "rotate" and abs(abs(turn) - abs(angle)) < 1.0
    assert raster.deskewed(np.zeros((9, 9)))[1] == "sparse" and raster.deskewed(page)[1] == "straight"
    assert (raster.rotate(page, 0.0) == page).all()


def test_images_as_bytes_and_as_lists(spark):
    rnd = np.random.default_rng(1)
    stack = rnd.integers(0, 256, (5, 6, 7))
    colour = rnd.integers(0, 256, (5, 6, 7, 3))
    as_list = spark.createDataFrame([(i, x.ravel().tolist()) for i, x in enumerate(stack)], "id long, image array<int>")
    as_bytes = spark.createDataFrame([(i, x.astype(np.uint8).tobytes()) for i, x in enumerate(stack)], "id long, image binary")
    for made in (raster.median3, raster.binarise):
        assert {r["id"]: list(r["image"]) for r in made(as_list, "id", 7, 6).collect()} == {r["id"]: list(bytes(r["image"])) for r in made(as_bytes, "id", 7, 6).collect()}
    df = spark.createDataFrame([(i, x.astype(np.uint8).tobytes()) for i, x in enumerate(colour)], "id long, image binary")
    want = raster.thresholds(raster.contrasts(raster.medians(raster.grays(colour))))
    assert all(list(bytes(r["image"])) == want[r["id"]].ravel().tolist() for r in raster.clean(df, "id", 7, 6, turn=True).collect())
    assert {r["decision"] for r in raster.deskew(as_bytes, "id", 7, 6).collect()} == {"sparse"}
    assert raster.median3(as_bytes.where("false"), "id", 7, 6).count() == 0


def test_pages_become_documents(spark, tmp_path):
    rows_ = [("a", p, bytes([p] * 12), 2, 2) for p in (10, 2, 1)] + [("b", 1, bytes(range(18)), 3, 2), ("b", 1, bytes(range(18)), 3, 2)]
    images = spark.createDataFrame(rows_, "document string, page_number int, image binary, width int, height int")
    pages_ = pdf.image_pages(images, ["document", "page_number"], 144.0)
    root = f"file://{tmp_path}/merged"
    got = {r["document"]: r["pages"] for r in pdf.merge_documents(pages_, root).collect()}
    assert got == {"a": 3, "b": 1} and sorted(p.name for p in (tmp_path / "merged").iterdir()) == ["a.pdf", "b.pdf"]
    content = (tmp_path / "merged/a.pdf").read_bytes()
    assert documents.page_boxes(content) == [(1, 1.0, 1.0), (2, 1.0, 1.0), (3, 1.0, 1.0)]
    shown = [zlib.decompress(s[7:-10]) for h, s in pdf.objects_of(content).values() if b"/Image" in h]
    assert shown == [bytes([p] * 12) for p in (1, 2, 10)]
    start = int(content.rsplit(b"startxref", 1)[1].split()[0])
    assert content[start : start + 4] == b"xref"
    for i, entry in enumerate(content[start:].split(b"\n")[3 : 3 + len(pdf.objects_of(content))], 1):
        assert content[int(entry[:10]) :].startswith(b"%d 0 obj" % i)
    again: list[bytes] = []
    merger = pdf.Merger(again.append)
    assert merger.add(content) == 3 and merger.add((tmp_path / "merged/b.pdf").read_bytes()) == 1 and merger.end() == 4
    assert [w for _, w, _ in documents.page_boxes(b"".join(again))] == [1.0, 1.0, 1.0, 1.5]
    with pytest.raises(Exception, match="no pages: c"):
        pdf.require_pages(spark.createDataFrame([("c",)], "document string"), pages_).collect()
    with pytest.raises(ValueError):
        merger.add(b"%PDF-1.5 nothing")


def test_page_sizes_in_compressed_streams():
    inner = [b"<< /Type /Pages /Kids [2 0 R 3 0 R] /Count 2 /MediaBox [0 0 2550 3300] >>", b"<< /Type /Page /Parent 1 0 R /MediaBox [0 0 612 792] >>", b"<< /Type /Page /Parent 1 0 R >>"]
    at, heads = 0, b""
    for i, x in enumerate(inner, 1):
        heads, at = heads + b"%d %d " % (i, at), at + len(x) + 1
    data = zlib.compress(heads + b"\n".join(inner))
    content = b"%%PDF-1.5\n9 0 obj\n<< /Type /ObjStm /N 3 /First %d /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream\nendobj\n" % (len(heads), len(data), data)
    assert documents.page_boxes(content) == [(1, 612.0, 792.0), (2, 2550.0, 3300.0)]


def test_rendered_pages_are_numbered_from_the_first(spark):
    chunks = spark.createDataFrame([("x.pdf", 3, 4), ("x.pdf", 1, 1)], "path string, first int, last int")
    got = documents.render(chunks, lambda path, first, last, dpi: [f"{path} {n} {dpi}".encode() for n in range(first, last + 1)], 150)
    assert sorted((r["page_number"], bytes(r["image"])) for r in got.collect()) == [(1, b"x.pdf 1 150"), (3, b"x.pdf 3 150"), (4, b"x.pdf 4 150")]


def test_crops_and_label_files(spark, tmp_path):
    pixels = np.random.default_rng(2).integers(0, 256, (60, 90, 3)).astype(np.uint8)
    images = spark.createDataFrame([("d", 1, pixels.tobytes(), 90, 60)], "source_document string, page_number long, image binary, width int, height int")
    box = [0.1, 0.1, 0.15, 0.12, 0.1, 0.1, 9.0, 9.0]
    errors_ = spark.createDataFrame([(7, "d", 1, *box), (8, "e", 1, *box)], "error_id long, source_document string, page_number long, ctx_x0 double, ctx_y0 double, ctx_x1 double, ctx_y1 double, err_x0 double, err_y0 double, err_x1 double, err_y1 double")
    crops = {r["path"]: bytes(r["body"]) for r in artifacts.error_crops(errors_, images).collect()}
    assert set(crops) == {"images/error_7/context.png", "images/error_7/error.png"} and all(b.startswith(b"\x89PNG") for b in crops.values())
    point = "array<struct<x:double,y:double>>"
    square = [(1.0, 1.0), (9.0, 1.0), (9.0, 9.0), (1.0, 9.0)]
    rows_ = spark.createDataFrame([("d", 1, "doc_1", maps.INFO_TYPES[0], 0, square), ("d", 1, "doc_2", maps.INFO_TYPES[0], 0, square[:2])], f"document string, page_number long, doc_key string, info_type string, poly_idx int, polygon {point}")
    made = artifacts.label_artifacts(images.withColumnRenamed("source_document", "document"), rows_, 150.0)
    got = {r["path"]: bytes(r["body"]) for r in made.collect()}
    assert set(got) == {f"d/page_001/doc_1/{t}.pdf" for t in [*maps.INFO_TYPES, "unified"]} | {"d/page_001/doc_1/labels.json"}
    shown = lambda name: next(zlib.decompress(s[7:-10]) for h, s in pdf.objects_of(got[f"d/page_001/doc_1/{name}.pdf"]).values() if b"/Image" in h)
    unified = np.frombuffer(shown("unified"), dtype=np.uint8).reshape(60, 90, 3)
    assert (unified[1:10, 1:10] == pixels[1:10, 1:10]).all() and (unified[10:] == 255).all() and set(shown(maps.INFO_TYPES[1])) == {255}
    body = json.loads(got["d/page_001/doc_1/labels.json"])
    assert list(body) == ["page_number", "doc_key", "polygons"] and {t: len(p) for t, p in body["polygons"].items()} == {t: int(t == maps.INFO_TYPES[0]) for t in maps.INFO_TYPES}
    assert artifacts.label_artifacts(images.withColumnRenamed("source_document", "document").where("false"), rows_, 150.0).count() == 0


def test_missing_records(spark):
    pages_ = spark.createDataFrame([("d", 1), ("d", 2)], "document string, page_number int")
    have, lack = labels.present(pages_, pages_.where("page_number = 1"), ["document", "page_number"])
    assert [r["page_number"] for r in have.collect()] == [1] and [r["page_number"] for r in lack.collect()] == [2]
    got = polygons.load(pages_, pages_.where("page_number = 1").withColumn("polygon", F.lit("p")), ["document", "page_number"])
    assert {(r["page_number"], r["polygon"], r["failure"]) for r in got.collect()} == {(1, "p", None), (2, None, "no polygon record")}


@pytest.mark.parametrize("points, inches, pixels", [((2550.0, 3300.0), (35.4167, 45.8333), (5312, 6875)), ((2535.0, 3278.0), (35.2083, 45.5278), (5281, 6829))])
def test_golden_page_sizes(spark, points, inches, pixels):
    row = spark.range(1).select(g.points_to_pixels(F.lit(points[0]), 150).alias("w"), g.points_to_pixels(F.lit(points[1]), 150).alias("h")).first()
    assert (row["w"], row["h"]) == pixels
    assert tuple(round(p / 72, 4) for p in points) == inches


def test_insert_only_and_document_bodies(spark, tmp_path):
    at = f"file://{tmp_path}/labels"
    make = lambda *rows_: spark.createDataFrame(list(rows_), "document string, page_number int, label string")
    assert sinks.insert_only(make(("d", 1, "a"), ("d", 2, "a")), at, ["document", "page_number"]) == 2
    assert sinks.insert_only(make(("d", 2, "b"), ("d", 3, "b")), at, ["document", "page_number"]) == 1
    assert sorted(tuple(r) for r in sinks.read_table(spark, at).collect()) == [("d", 1, "a"), ("d", 2, "a"), ("d", 3, "b")]
    got = sinks.document_bodies(spark.createDataFrame([("x.pdf", "{}", None), ("y.pdf", None, "bad")], "name string, body string, error string"))
    assert [tuple(r) for r in got.collect()] == [("x.pdf.json", "{}")]


def test_the_only_document(spark):
    files = spark.createDataFrame([("a.pdf",), ("b.txt",)], "name string")
    assert pages.only_document(files).first()["name"] == "a.pdf"
    with pytest.raises(Exception, match="exactly one document"):
        pages.only_document(files.unionByName(spark.createDataFrame([("c.PDF",)], "name string"))).collect()


def test_lines_of_pages(spark):
    page = "struct<pageNumber:bigint,words:array<struct<content:string>>,lines:array<struct<content:string,polygon:array<double>,spans:array<struct<offset:bigint,length:bigint>>>>>"
    df = spark.createDataFrame([("d", (1, [], [("l", [0.0], [(0, 1)]), ("m", None, None)]))], f"document string, page {page}")
    assert [(r["line_index"], r["content"]) for r in ocr_json.lines_of(df, ["document"]).orderBy("line_index").collect()] == [(0, "l"), (1, "m")]


def test_canvas_and_page_are_inverse_and_boxes_unite(spark):
    fit = F.struct(F.lit(0.25).alias("scale"), F.lit(10.0).alias("offset_x"), F.lit(4.0).alias("offset_y"))
    poly = F.array(g.point(F.lit(8.0), F.lit(20.0)), g.point(F.lit(-4.0), F.lit(0.5)))
    box = lambda *v: F.struct(*[F.lit(x).alias(n) for n, x in zip(("x0", "y0", "x1", "y1"), v)])
    row = spark.range(1).select(g.to_page(g.to_canvas(poly, fit), fit).alias("p"), g.bbox_union(box(1.0, 5.0, 2.0, 6.0), box(0.0, 7.0, 1.5, 9.0)).alias("b")).first()
    assert [tuple(q) for q in row["p"]] == [(8.0, 20.0), (-4.0, 0.5)] and tuple(row["b"]) == (0.0, 5.0, 2.0, 9.0)
