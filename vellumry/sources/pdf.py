"""PDF files written and put together without a codec library: pages from images, documents from pages.

A page is one image, deflated; a document is put together from the objects of its pages, renumbered. Files whose objects
lie in compressed streams are read for their page sizes (``documents.page_boxes``) but not merged: such a page is an error.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b")
_REF = re.compile(rb"(\d+)\s+(\d+)\s+R\b")
_LENGTH = re.compile(rb"/Length\s+(\d+)(?!\s+\d+\s+R)")
_PAGE = re.compile(rb"/Type\s*/Page(?![a-zA-Z])")


def image_page(pixels: bytes, width: int, height: int, dpi: float, channels: int = 3) -> bytes:
    """A PDF of one page that shows an image at a resolution; grey images are shown as they are."""
    if len(pixels) != width * height * channels:
        raise ValueError("the image isn't of the size given")
    w, h = width * 72.0 / dpi, height * 72.0 / dpi
    space = b"/DeviceRGB" if channels == 3 else b"/DeviceGray"
    data = zlib.compress(pixels)
    draw = b"q %.4f 0 0 %.4f 0 0 cm /Im0 Do Q" % (w, h)
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>",
        b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %.4f %.4f] /Resources << /XObject << /Im0 4 0 R >> >> /Contents 5 0 R >>" % (w, h),
        b"<< /Type /XObject /Subtype /Image /Width %d /Height %d /ColorSpace %s /BitsPerComponent 8 /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream" % (width, height, space, len(data), data),
        b"<< /Length %d >>\nstream\n%s\nendstream" % (len(draw), draw),
    ]
    out: list[bytes] = []
    w_ = Writer(out.append)
    for n, body in enumerate(objects, 1):
        w_.put(n, body)
    w_.end(1)
    return b"".join(out)


class Writer:
    """Objects written one after the other; only their offsets are kept."""

    def __init__(self, write: Callable[[bytes], object]):
        self.write_, self.at, self.offsets = write, 0, {}
        self._out(b"%PDF-1.4\n")

    def _out(self, data: bytes) -> None:
        self.write_(data)
        self.at += len(data)

    def put(self, number: int, body: bytes) -> None:
        self.offsets[number] = self.at
        self._out(b"%d 0 obj\n%s\nendobj\n" % (number, body))

    def end(self, root: int) -> None:
        start, n = self.at, max(self.offsets) + 1
        self._out(b"xref\n0 %d\n0000000000 65535 f \n" % n)
        for i in range(1, n):
            self._out(b"%010d 00000 n \n" % self.offsets[i] if i in self.offsets else b"0000000000 00000 f \n")
        self._out(b"trailer\n<< /Size %d /Root %d 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (n, root, start))


def objects_of(content: bytes) -> dict[int, tuple[bytes, bytes]]:
    """``{number: (dictionary or value, stream part)}`` of a file's plain objects; of several with one number the last."""
    out, at = {}, 0
    while m := _OBJECT.search(content, at):
        begin = m.end()
        end = content.find(b"endobj", begin)
        if end < 0:
            break
        stream = content.find(b"stream", begin, end)
        if stream >= 0:
            length = _LENGTH.search(content, begin, stream)
            data = stream + (8 if content[stream + 6 : stream + 8] == b"\r\n" else 7)
            if length:
                end = content.find(b"endobj", data + int(length[1]))
            out[int(m[1])] = content[begin:stream].strip(), content[stream:end].strip(b"\r\n")
        else:
            out[int(m[1])] = content[begin:end].strip(), b""
        at = end + 6
    return out


class Merger:
    """One document out of pages that come one after the other; nothing of a page is kept but its number."""

    def __init__(self, write: Callable[[bytes], object]):
        self.to, self.next, self.kids = Writer(write), 3, []

    def add(self, content: bytes) -> int:
        """Add the pages of a file; how many they are. A file without plain page objects is an error."""
        objects = objects_of(content)
        pages = [n for n, (head, _) in objects.items() if _PAGE.search(head)]
        if not pages:
            raise ValueError("no page objects that can be copied")
        skipped = {n for n, (head, _) in objects.items() if re.search(rb"/Type\s*/(Pages|Catalog|XRef)\b", head)}
        number = {n: self.next + i for i, n in enumerate(sorted(set(objects) - skipped))}
        self.next += len(number)
        for n, new in number.items():
            head, stream = objects[n]
            if n in pages:
                head = head if b"/MediaBox" in head else head[:2] + self._inherited(objects, n) + head[2:]
                head = re.sub(rb"/Parent\s+\d+\s+\d+\s+R", b"/Parent @", head)
            refs = _REF.sub(lambda m: b"%d 0 R" % number.get(int(m[1]), 0), head).replace(b"/Parent @", b"/Parent 2 0 R")
            self.to.put(new, refs + (b"\n" + stream if stream else b""))
        self.kids.extend(number[n] for n in pages)
        return len(pages)

    @staticmethod
    def _inherited(objects: dict[int, tuple[bytes, bytes]], page: int) -> bytes:
        """The size that a page takes from the nodes above it."""
        seen: set[int] = set()
        while (up := re.search(rb"/Parent\s+(\d+)", objects.get(page, (b"", b""))[0])) and int(up[1]) not in seen:
            page = int(up[1])
            seen.add(page)
            if box := re.search(rb"/MediaBox\s*\[[^\]]*\]", objects.get(page, (b"", b""))[0]):
                return box[0] + b" "
        return b""

    def end(self) -> int:
        kids = b" ".join(b"%d 0 R" % k for k in self.kids)
        self.to.put(1, b"<< /Type /Catalog /Pages 2 0 R >>")
        self.to.put(2, b"<< /Type /Pages /Kids [%s] /Count %d >>" % (kids, len(self.kids)))
        self.to.end(1)
        return len(self.kids)


def png(pixels: bytes, width: int, height: int, channels: int = 3) -> bytes:
    """An image as PNG."""
    row = width * channels
    raw = b"".join(b"\x00" + pixels[i * row : (i + 1) * row] for i in range(height))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if channels == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def image_pages(images: DataFrame, by: list[str], dpi: float, channels: int = 3) -> DataFrame:
    """``by, body``: each row's ``image`` (binary) of ``width`` and ``height`` as a PDF of one page."""
    narrow = images.select(*by, "image", "width", "height")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["body"] = [image_page(bytes(i), int(w), int(h), dpi, channels) for i, w, h in zip(pdf["image"], pdf["width"], pdf["height"])]
            yield pdf[[*by, "body"]]

    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    return narrow.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in by) + ", body binary")


def merge_documents(pages: DataFrame, root: str) -> DataFrame:
    """``document, path, pages``: the ``body`` of all pages of a document, in order of ``page_number``, as ``root/<document>.pdf``.

    A task writes a document page by page as the sorted rows go by, so no document is gathered; the file has its name only
    when it is whole. Repeated pages count once.
    """
    ordered = pages.select("document", F.col("page_number").cast("long").alias("page_number"), "body").dropDuplicates(["document", "page_number"])
    ordered = ordered.repartition("document").sortWithinPartitions("document", "page_number")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        system.create_dir(base, recursive=True)
        open_: tuple | None = None

        def close() -> tuple[str, str, int]:
            document, part, file, merger = open_
            n = merger.end()
            file.close()
            system.move(part, f"{base}/{document}.pdf")
            return document, f"{document}.pdf", n

        for pdf in batches:
            done = []
            for document, body in zip(pdf["document"], pdf["body"]):
                if open_ is None or open_[0] != document:
                    if open_ is not None:
                        done.append(close())
                    part = f"{base}/{document}.part-{uuid.uuid4().hex}"
                    file = system.open_output_stream(part)
                    open_ = (document, part, file, Merger(file.write))
                open_[3].add(bytes(body))
            yield pd.DataFrame(done, columns=["document", "path", "pages"]).astype({"document": "object", "path": "object", "pages": "int64"})
        if open_ is not None:
            yield pd.DataFrame([close()], columns=["document", "path", "pages"])

    return ordered.mapInPandas(run, "document string, path string, pages long")


def require_pages(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """``pages``, or an error as soon as they are read if one of ``documents`` (``document``) has none."""
    lacking = documents.select("document").distinct().join(pages.select("document").distinct(), "document", "left_anti")
    none = lacking.select(F.raise_error(F.concat(F.lit("no pages: "), F.col("document"))).cast("string").alias("document"))
    return pages.unionByName(none, allowMissingColumns=True)
