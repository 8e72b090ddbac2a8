"""Encoding of texts with a public byte-level tokenizer, and raw-byte decoding.

``encode`` keeps every input row: null and empty texts give an empty list. Other columns are dropped except ``keep``.
Repeated rows stay repeated; column names of the input cannot clash, since only ``keep`` and the text are read.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = os.environ.get("VELLUMRY_TOKENIZERS", "/opt/tokenizers")
RANK_FILE = "byte_bpe_50k.tiktoken"
#: The pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of more characters than this are encoded in parts.
LONG_TEXT = 65_536

_encodings: dict[str, object] = {}


def encoding(path: str):
    """The tokenizer of a rank file; loaded once in each worker process."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        _encodings[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def safe_parts(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """Cut a text only where no token can span the cut: before a single space between two characters that aren't white space.

    There the pattern ends a piece and begins the next, whatever stands around, so the ids of the parts joined are the
    ids of the whole. A text without such a place within reach stays in one part as long as it must.
    """
    start, n = 0, len(text)
    while n - start > size:
        cut = start + size
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= n:
                cut = n
                break
            if not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        yield text[start:cut]
        start = cut
    if start < n:
        yield text[start:]


def encode_text(enc, text: str | None) -> list[int]:
    if not text:
        return []
    if len(text) <= LONG_TEXT:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_parts(text):
        ids.extend(enc.encode_ordinary(part))
    return ids


def encode(df: DataFrame, text: str, keep: list[str], out: str = "ids", path: str | None = None, count_only: bool = False) -> DataFrame:
    """``keep`` and the token ids of ``text`` (or with ``count_only`` their number, which spares their transfer)."""
    path = path or os.path.join(TOKENIZER_DIR, RANK_FILE)
    narrow = df.select(*keep, F.col(text).alias("_text"))
    fields = {f.name: f for f in narrow.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        enc = encoding(path)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            if count_only:
                made = pa.array([len(encode_text(enc, t)) for t in texts], pa.int64())
            else:
                parts = [np.asarray(encode_text(enc, t), dtype=np.int32) for t in texts]
                offsets = np.zeros(len(parts) + 1, dtype=np.int32)
                np.cumsum([len(p) for p in parts], out=offsets[1:])
                values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
                made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], made], [*keep, out])

    from pyspark.sql import types as T

    schema = T.StructType([*[fields[k] for k in keep], T.StructField(out, T.LongType() if count_only else T.ArrayType(T.IntegerType()))])
    return narrow.mapInArrow(run, schema)


def decode_ids(ids: list[int] | None, path: str | None = None) -> bytes | None:
    """The bytes that the ids stand for. A cut inside a character gives bytes that aren't valid text, so no string is made."""
    if ids is None:
        return None
    return encoding(path or os.path.join(TOKENIZER_DIR, RANK_FILE)).decode_bytes(list(ids))


def decode(df: DataFrame, ids: str, keep: list[str], out: str = "bytes", path: str | None = None) -> DataFrame:
    """``keep`` and the raw bytes of a column of id lists; null lists give null."""
    from pyspark.sql import types as T

    narrow = df.select(*keep, F.col(ids).alias("_ids"))
    fields = {f.name: f for f in narrow.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([decode_ids(x, path) for x in batch.column(len(keep)).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], made], [*keep, out])

    return narrow.mapInArrow(run, T.StructType([*[fields[k] for k in keep], T.StructField(out, T.BinaryType())]))
