"""Files made from page images: crops of errors, and the parts of labelled documents. Rows of ``path, body`` for ``sinks.write_bodies``."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.functions import geometry as g
from vellumry.functions import maps as m
from vellumry.operators import labels, raster
from vellumry.sources import pdf


def error_crops(errors: DataFrame, images: DataFrame) -> DataFrame:
    """``path, body``: two PNG files of each error, its line and its word, cut from the page's colour image.

    ``errors`` has error_id, source_document, page_number and the boxes ``ctx_*`` and ``err_*`` in inches; ``images``
    source_document, page_number, image (binary, three bytes a pixel), width, height. A window beyond the page is cut to it; one
    without a pixel gives no file.
    """
    windows = [F.struct(F.lit(kind).alias("kind"), g.crop_window(*[F.col(f"{p}_{c}") for c in ("x0", "y0", "x1", "y1")]).alias("w")) for kind, p in (("context", "ctx"), ("error", "err"))]
    each = errors.select("error_id", "source_document", "page_number", F.explode(F.array(*windows)).alias("c")).select("error_id", "source_document", "page_number", "c.kind", "c.w.*")
    by_page = each.groupBy("source_document", "page_number").agg(F.collect_list(F.struct("error_id", "kind", "left", "top", "right", "bottom")).alias("crops"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for image, width, height, crops in zip(frame["image"], frame["width"], frame["height"], frame["crops"]):
                pixels = np.frombuffer(bytes(image), dtype=np.uint8).reshape(int(height), int(width), 3)
                for c in crops:
                    part = pixels[max(0, c["top"]) : max(0, c["bottom"]), max(0, c["left"]) : max(0, c["right"])]
                    if part.size:
                        rows.append((f"images/error_{c['error_id']}/{c['kind']}.png", pdf.png(part.tobytes(), part.shape[1], part.shape[0])))
            yield pd.DataFrame(rows, columns=["path", "body"], dtype="object")

    joined = images.select("source_document", "page_number", "image", "width", "height").join(by_page, ["source_document", "page_number"])
    return joined.select("image", "width", "height", "crops").mapInPandas(run, "path string, body binary")


def label_artifacts(images: DataFrame, label_rows: DataFrame, dpi: float) -> DataFrame:
    """``path, body`` of each document on a page that has any polygon of three points: a PDF for each info type, blank or not,
    one of all types, and ``labels.json``. ``images`` has document, page_number, image (binary, colour), width, height.
    """
    by = ["document", "page_number"]
    wanted = labels.manifest(label_rows, by).select(*by, "doc_key").distinct()
    types = labels.export(label_rows, by).join(wanted, [*by, "doc_key"], "left_semi")
    narrow = images.select(*by, "image", "width", "height").join(types, by).select(*by, "doc_key", F.to_json("polygons").alias("polygons"), "image", "width", "height")
    names = list(m.INFO_TYPES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for document, page, key, text, image, width, height in frame.itertuples(index=False):
                pixels = np.frombuffer(bytes(image), dtype=np.uint8).reshape(int(height), int(width), 3)
                polygons = {t: [np.array([(q["x"], q["y"]) for q in p]).reshape(-1, 2) for p in ps] for t, ps in json.loads(text).items()}
                at = f"{document}/page_{page:03d}/{key}"
                every = [p for t in names for p in polygons.get(t, [])]
                for name, parts in [*((t, polygons.get(t, [])) for t in names), ("unified", every)]:
                    held = raster.fill(parts, int(width), int(height))
                    shown = np.where(held[:, :, None], pixels, 255).astype(np.uint8)
                    rows.append((f"{at}/{name}.pdf", pdf.image_page(shown.tobytes(), int(width), int(height), dpi)))
                held_ = json.loads(text)
                body = {"page_number": int(page), "doc_key": key, "polygons": {t: held_.get(t, []) for t in names}}
                rows.append((f"{at}/labels.json", json.dumps(body).encode()))
            yield pd.DataFrame(rows, columns=["path", "body"], dtype="object")

    return narrow.mapInPandas(run, "path string, body binary")
