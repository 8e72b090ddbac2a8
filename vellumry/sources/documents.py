"""PDF files as binary rows, and the two outside services: a renderer and an OCR client, both passed in by the caller."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.sources import pdf

_PAGE = re.compile(rb"/Type\s*/Page(?![a-zA-Z])")
_BOX = re.compile(rb"/MediaBox\s*\[\s*([-\d.]+)\s+([-\d.]+)\s+([-\d.]+)\s+([-\d.]+)\s*\]")


def read_files(spark: SparkSession, root: str) -> DataFrame:
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return df.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path", "length", "content")


_PACKED = re.compile(rb"/Type\s*/ObjStm\b")


def _unpacked(content: bytes) -> Iterator[tuple[int, bytes]]:
    """Number and dictionary of all objects, those in compressed streams (deflate, without predictor) too."""
    for number, (head, stream) in pdf.objects_of(content).items():
        if not _PACKED.search(head):
            yield number, head
            continue
        n, first = (int(re.search(rb"/%s\s+(\d+)" % k, head)[1]) for k in (b"N", b"First"))
        try:
            data = zlib.decompressobj().decompress(re.sub(rb"^stream\r?\n", b"", stream))
        except zlib.error:
            continue
        table = [int(x) for x in data[:first].split()[: 2 * n]]
        ends = [*table[3::2], len(data) - first]
        for k, (inner, at) in enumerate(zip(table[::2], table[1::2])):
            yield inner, data[first + at : first + ends[k]]


def page_boxes(content: bytes) -> list[tuple[int, float, float]]:
    """``(page, width, height)`` in points, in the order of the page tree; a page without a size takes that of the node above."""
    objects = dict(_unpacked(content))
    out: list[tuple[int, float, float]] = []

    def size(head: bytes, box):
        own = _BOX.search(head)
        return own or box

    def walk(number: int, box, seen: frozenset) -> None:
        head = objects.get(number, b"")
        if number in seen or not head:
            return
        box = size(head, box)
        kids = re.search(rb"/Kids\s*\[([^\]]*)\]", head)
        if kids:
            for k in re.findall(rb"(\d+)\s+\d+\s+R", kids[1]):
                walk(int(k), box, seen | {number})
        elif _PAGE.search(head) and box:
            x0, y0, x1, y1 = map(float, box.groups())
            out.append((len(out) + 1, x1 - x0, y1 - y0))

    roots = [n for n, head in objects.items() if re.search(rb"/Type\s*/Pages\b", head) and b"/Kids" in head and b"/Parent" not in head]
    for root in roots:
        walk(root, None, frozenset())
    if not out:  # no tree that can be followed: the pages as they stand
        default = _BOX.search(content)
        for head in objects.values():
            box = size(head, default)
            if _PAGE.search(head) and box:
                x0, y0, x1, y1 = map(float, box.groups())
                out.append((len(out) + 1, x1 - x0, y1 - y0))
    return out


def read_page_boxes(files: DataFrame) -> DataFrame:
    """``name, page_number, width_points, height_points``; files without readable pages give nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = [(name, *box) for name, content in zip(frame["name"], frame["content"]) for box in page_boxes(content)]
            yield pd.DataFrame(rows, columns=["name", "page_number", "width_points", "height_points"]).astype({"name": "object", "page_number": "int64", "width_points": "float64", "height_points": "float64"})

    return files.select("name", "content").mapInPandas(run, "name string, page_number long, width_points double, height_points double")


def render(chunks: DataFrame, renderer: Callable[[str, int, int, int], list[bytes]], dpi: int) -> DataFrame:
    """Images of pages: ``chunks`` has ``path, first, last``; ``renderer(path, first, last, dpi)`` gives one image a page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for path, first, last in zip(frame["path"], frame["first"], frame["last"]):
                images = renderer(path, int(first), int(last), dpi)
                yield pd.DataFrame({"path": [path] * len(images), "page_number": range(int(first), int(first) + len(images)), "image": images})

    return chunks.mapInPandas(run, "path string, page_number long, image binary")


def recognise(files: DataFrame, client: Callable[[bytes, int], str], first_pages: int = 0) -> DataFrame:
    """``name, body, error``: one call of the service for each document; a call that fails gives its message."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for name, content in zip(frame["name"], frame["content"]):
                try:
                    rows.append((name, client(content, first_pages), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((name, None, str(e)))
            yield pd.DataFrame(rows, columns=["name", "body", "error"]).astype("object")

    return files.select("name", "content").mapInPandas(run, "name string, body string, error string")


def credentials(*names: str) -> dict[str, str]:
    """Settings of the service from the environment; all must be set. They stay on the driver unless the caller passes them on."""
    missing = [n for n in names if not os.environ.get(n)]
    if missing:
        raise KeyError(f"not set: {', '.join(missing)}")
    return {n: os.environ[n] for n in names}
