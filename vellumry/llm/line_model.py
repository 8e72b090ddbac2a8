"""Lines of scanned pages labelled by a hidden Markov model over layout features.

A page is a sequence of lines from top to bottom, in one of five states: header, number, body, opening (a body line that
opens a paragraph) and break (a heading between text lines). Of each line the model sees nine features: what it looks
like and where it stands; the gaps above and below; its indent, width, height and centring against its own page; the
confidence of its words; and how the line before it ends. Features are independent given the state; one that can't be
told (no box, no confidence, no line before) is left out of the product. Baum-Welch fits the model on all pages: every
round adds up expected counts over tasks, and one number for each value of the model reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES = ["header", "number", "body", "opening", "break"]
HEADER, NUMBER_LINE, BODY, OPENING, BREAK = range(5)
ROUNDS = 8
#: The start values weigh as much as so many pages.
PRIOR_PAGES = 50.0

_LOOKS = 12  # number, title or prose; first, second, last or other line
#: Values of each feature, and for each state how often it shows them before the model is fitted. Zeros stay zeros.
FEATURES: dict[str, np.ndarray] = {
    "above": np.array([[0.85, 0.15], [0.8, 0.2], [0.97, 0.03], [0.85, 0.15], [0.8, 0.2]]),  # usual, wide
    "below": np.array([[0.8, 0.2], [0.8, 0.2], [0.96, 0.04], [0.95, 0.05], [0.8, 0.2]]),  # usual, wide
    "indent": np.array([[0.75, 0.05, 0.2], [0.75, 0.05, 0.2], [0.96, 0.03, 0.01], [0.68, 0.3, 0.02], [0.75, 0.05, 0.2]]),  # flush, indented, deep
    "width": np.array([[0.3, 0.6, 0.1], [0.9, 0.09, 0.01], [0.05, 0.45, 0.5], [0.05, 0.45, 0.5], [0.3, 0.6, 0.1]]),  # short, middle, full
    "height": np.array([[0.1, 0.8, 0.1], [0.1, 0.8, 0.1], [0.03, 0.95, 0.02], [0.03, 0.95, 0.02], [0.04, 0.8, 0.16]]),  # small, usual, large
    "centred": np.array([[0.75, 0.25], [0.75, 0.25], [0.97, 0.03], [0.97, 0.03], [0.75, 0.25]]),  # no, yes
    "sure": np.array([[0.2, 0.8], [0.2, 0.8], [0.15, 0.85], [0.15, 0.85], [0.2, 0.8]]),  # words of low confidence, none
    "before": np.array([[0.6, 0.2, 0.2], [0.6, 0.2, 0.2], [0.94, 0.04, 0.02], [0.05, 0.15, 0.8], [0.8, 0.1, 0.1]]),  # runs on, ends a sentence, and short of the margin
}
SIZES = [_LOOKS, *[x.shape[1] for x in FEATURES.values()]]
#: In a code every feature but the look has one value more, for what can't be told.
RADIX = [_LOOKS, *[n + 1 for n in SIZES[1:]]]

NUMBER = re.compile(r"^[^\w]*(?:[^\W\d_]{1,5}\.?\s*)?(?:[\dlOoSBIZ]{1,6}|[ivxlcdm]{1,9}|[IVXLCDM]{1,9})(?:[rv])?[^\w]*$")
#: Words of a heading that belong to its page number.
NUMBERED = re.compile(r"^[^\w]*(?:(?:p|pp|fol|page|f|leaf|folio|no)\.?|[\dlOoSBIZ]+[rv]?|[ivxlcdm]+|[IVXLC]+)[^\w]*$", re.I)
DIGITS = re.compile(r"\d")
_GROUPED = re.compile(r"^\d{1,3}(,\d{3})+$")
_TWO_LETTERS = re.compile(r"[^\W\d_]{2}")
_STOP_WITHIN = re.compile(r"[.,;:]$|[.,;] ")
_SENTENCE_END = re.compile(r"[.?!][\"”’')\]]*$")
_CAPITAL = re.compile(r"^[\"“‘'(\[]*[A-ZÀ-ÖØ-Þ]")


def shape_of(words: list[str]) -> int:
    """0 for a line of a number only, 1 for a title (capitalised words, perhaps with a number), 2 for prose."""
    text = " ".join(words)
    if len(words) <= 4 and NUMBER.match(text) and not _GROUPED.match(text):
        short = not any(ch.isalpha() and len(w) > 4 for w in words for ch in w)
        if DIGITS.search(text) or len(words) == 1 or short:
            return 0
    named = [w for w in words if _TWO_LETTERS.search(w) and not NUMBERED.match(w)]
    titled = len(named) >= 2 or (len(named) == 1 and len(named[0]) >= 4)
    if titled and all(w[0].isupper() or not w[0].isalpha() for w in named) and not _STOP_WITHIN.search(" ".join(named)):
        return 1
    return 2


def ends_sentence(text: str) -> bool:
    return bool(_SENTENCE_END.search(text))


def opens_sentence(text: str) -> bool:
    return bool(_CAPITAL.match(text))


def page_features(texts: list[str], geo: np.ndarray) -> np.ndarray:
    """Features of a page's lines, -1 for what can't be told.

    ``geo`` has for each line x0, y0, x1, y1, height, share of words of low confidence, width of the first word; NaN is null.
    """
    n = len(texts)
    out = np.full((n, len(SIZES)), -1, dtype=np.int64)
    shapes = [shape_of(t.split(" ")) for t in texts]
    for i, s in enumerate(shapes):
        out[i, 0] = s * 4 + (0 if i == 0 else 1 if i == 1 else 2 if i == n - 1 else 3)
    x0, y0, x1, _, high, low, first = geo.T
    out[:, 7] = np.where(np.isnan(low), -1, np.where(low > 0.25, 0, 1))
    told = ~(np.isnan(x0) | np.isnan(y0) | np.isnan(x1))
    right = np.nan
    if told.any():
        usual = np.nanmedian(high) if not np.isnan(high).all() else 0.15
        usual = usual if usual > 0 else 0.15
        left, right = np.nanmin(x0), np.nanmax(x1)
        wide = max(right - left, 1e-9)
        gaps = np.diff(y0)
        known = gaps[~np.isnan(gaps)]
        if len(known):
            far = np.where(np.isnan(gaps), -1, (gaps > 1.5 * np.median(known)).astype(int))
            out[1:, 1], out[:-1, 2] = far, far
        inward = (x0 - left) / usual
        with np.errstate(invalid="ignore"):
            out[told, 3] = np.digitize(inward[told], [0.8, 5.0])
            out[told, 4] = np.digitize(((x1 - x0) / wide)[told], [0.35, 0.75])
            tall = ~np.isnan(high)
            out[tall, 5] = np.digitize(high[tall] / usual, [0.75, 1.3])
            off = np.abs((x0 + x1) / 2 - (left + right) / 2) / wide
            out[told, 6] = ((off < 0.06) & (inward > 2.0))[told]
    for i in range(1, n):
        if shapes[i - 1] == 2:
            ends = ends_sentence(texts[i - 1]) and opens_sentence(texts[i])
            room = right - x1[i - 1] > first[i] + 0.1  # the first word of this line would have gone on the line before
            out[i, 8] = 0 if not ends else 2 if room else 1
    return out


def pack_code(features: np.ndarray) -> np.ndarray:
    code = features[:, 0].copy()
    for k in range(1, len(RADIX)):
        code = code * RADIX[k] + features[:, k] + 1
    return code


def unpack_code(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), len(RADIX)), dtype=np.int64)
    rest = codes.copy()
    for k in range(len(RADIX) - 1, 0, -1):
        rest, digit = np.divmod(rest, RADIX[k])
        out[:, k] = digit - 1
    out[:, 0] = rest
    return out


def codes_of(texts: list[str], geo: np.ndarray | None = None) -> list[int]:
    """The codes of a page's lines; without ``geo`` only text counts."""
    geo = np.full((len(texts), 7), np.nan) if geo is None else geo
    return pack_code(page_features(texts, geo)).tolist() if texts else []


Model = tuple[np.ndarray, np.ndarray, list[np.ndarray]]


def start_values() -> Model:
    """Start, transitions and emissions of the model before it is fitted. Zeros are ruled out and stay so."""
    begin = np.array([0.4, 0.25, 0.34, 0.01, 0.0])
    move = np.array([
        [0.0, 0.2, 0.78, 0.02, 0.0], [0.4, 0.0, 0.58, 0.02, 0.0], [0.0, 0.06, 0.88, 0.05, 0.01],
        [0.0, 0.06, 0.92, 0.01, 0.01], [0.0, 0.0, 0.97, 0.03, 0.0],
    ])
    prose = [0.002, 0.001, 0.997]
    shape = np.array([[0.0, 1.0, 0.0], [1.0, 0.0, 0.0], prose, prose, [0.0, 1.0, 0.0]])
    text = [0.04, 0.06, 0.05, 0.85]
    place = np.array([[0.7, 0.3, 0.0, 0.0], [0.4, 0.15, 0.45, 0.0], text, text, [0.0, 0.01, 0.04, 0.95]])
    look = shape[:, :, None] * place[:, None, :]
    look[[BODY, OPENING], 0, :3] = 0.0  # a line of one number in the text stands among text lines
    return begin, move, [look.reshape(len(STATES), -1), *[x.copy() for x in FEATURES.values()]]


def emissions(codes: np.ndarray, model: Model) -> np.ndarray:
    """``p(code | state)``, a row for each code."""
    seen = unpack_code(codes)
    out = np.ones((len(codes), len(STATES)))
    for k, table in enumerate(model[2]):
        table = table / table.sum(axis=1, keepdims=True)
        out *= np.where(seen[:, k, None] >= 0, table.T[np.maximum(seen[:, k], 0)], 1.0)
    return out


def expected(pages: list[np.ndarray], model: Model) -> Model:
    """Expected numbers of starts, moves and emissions, worked out for all pages of one length at once.

    A page that the model rules out has no expected numbers and adds nothing.
    """
    begin, move, _ = model
    b, m, e = np.zeros_like(begin), np.zeros_like(move), [np.zeros_like(x) for x in model[2]]
    by_length: dict[int, list[np.ndarray]] = {}
    for page in pages:
        if len(page):
            by_length.setdefault(len(page), []).append(page)
    for n, group in by_length.items():
        kinds, seen = np.unique(np.stack(group), return_inverse=True)
        seen = seen.reshape(len(group), n)
        emit, held = emissions(kinds, model), np.zeros((len(kinds), len(STATES)))
        weight, alpha, scale = np.ones((len(group), 1)), [], []
        for i in range(n):
            a = (begin if i == 0 else alpha[-1] @ move) * emit[seen[:, i]]
            total = a.sum(axis=1, keepdims=True)
            weight = weight * (total > 0)
            scale.append(np.where(total > 0, total, 1.0))
            alpha.append(a / scale[-1])
        beta = np.ones((len(group), len(STATES)))
        for i in range(n - 1, -1, -1):
            gamma = alpha[i] * beta
            total = gamma.sum(axis=1, keepdims=True)
            gamma = weight * gamma / np.where(total > 0, total, 1.0)
            for s in range(len(STATES)):
                held[:, s] += np.bincount(seen[:, i], weights=gamma[:, s], minlength=len(kinds))
            if i == 0:
                b += gamma.sum(axis=0)
            else:
                back = emit[seen[:, i]] * beta / scale[i]
                m += move * ((weight * alpha[i - 1]).T @ back)
                beta = back @ move.T
        values = unpack_code(kinds)
        for k, table in enumerate(e):
            told = values[:, k] >= 0
            np.add.at(table.T, values[told, k], held[told])
    return b, m, e


def flat(model: Model) -> np.ndarray:
    return np.concatenate([model[0].ravel(), model[1].ravel(), *[x.ravel() for x in model[2]]])


def shaped(values: np.ndarray) -> Model:
    like = start_values()
    parts = np.split(values, np.cumsum([like[0].size, like[1].size, *[x.size for x in like[2]]])[:-1])
    return parts[0], parts[1].reshape(like[1].shape), [p.reshape(x.shape) for p, x in zip(parts[2:], like[2])]


def refit(counts: Model) -> Model:
    """The model of expected counts, with ``PRIOR_PAGES`` of the start; what is impossible at the start stays so."""
    b, m, e = shaped(PRIOR_PAGES * flat(start_values()) + flat(counts))
    return b / b.sum(), m / m.sum(axis=1, keepdims=True), [x / x.sum(axis=1, keepdims=True) for x in e]


def fit(pages: list[list[int]], rounds: int = ROUNDS) -> Model:
    """Baum-Welch on the driver."""
    model, held = start_values(), [np.asarray(p, dtype=np.int64) for p in pages]
    for _ in range(rounds if any(pages) else 0):
        model = refit(expected(held, model))
    return model


def fit_pages(pages: DataFrame, codes: str = "codes", rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all pages; as many numbers as the model has reach the driver in each round."""
    model, narrow = start_values(), pages.select(codes)
    for _ in range(rounds):

        def step(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                counts = flat(expected(arrays_of(batch.column(0)), model))
                total = counts if total is None else total + counts
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "v"])

        sums = narrow.mapInArrow(step, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        if not sums:
            return model
        values = np.zeros(len(sums))
        for r in sums:
            values[r["i"]] = r["v"]
        model = refit(shaped(values))
    return model


def viterbi(codes: list[int] | np.ndarray, model: Model) -> list[int]:
    codes = np.asarray(codes, dtype=np.int64)
    if not len(codes):
        return []
    with np.errstate(divide="ignore"):
        begin, move, emit = np.log(model[0]), np.log(model[1]), np.log(emissions(codes, model))
    best, back = begin + emit[0], []
    for row in emit[1:]:
        paths = best[:, None] + move
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0) + row
    at = int(best.argmax())
    out = [at]
    for step in reversed(back):
        at = int(step[at])
        out.append(at)
    return out[::-1]


def arrays_of(column: pa.Array) -> list[np.ndarray]:
    if not len(column):
        return []
    ends = np.asarray(column.offsets)
    return np.split(np.asarray(column.flatten(), dtype=np.int64), (ends - ends[0])[1:-1])


def _lists(parts: list, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate([np.asarray(p, dtype=np.int64) for p in parts]) if parts else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


GEOMETRY = ["x0", "y0", "x1", "y1", "height", "low", "first_width"]


def line_codes(lines: Column) -> Column:
    """The codes of a page's ``lines``, an array of structs with ``text`` and the numbers of ``GEOMETRY``."""

    @F.arrow_udf("array<int>")
    def code(text: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array, height: pa.Array, low: pa.Array, first: pa.Array) -> pa.Array:
        geo = np.stack([c.flatten().to_numpy(zero_copy_only=False).astype(float) for c in (x0, y0, x1, y1, height, low, first)], axis=1)
        ends = np.asarray(text.offsets)
        ends = ends - ends[0]
        words = text.flatten().to_pylist()
        return _lists([codes_of(words[a:b], geo[a:b]) for a, b in zip(ends, ends[1:])], pa.int32())

    return code(lines["text"], *[lines[g] for g in GEOMETRY])


def decode(codes: Column, model: Model) -> Column:
    """The most likely state of each line, as an array of numbers."""

    @F.arrow_udf("array<int>")
    def states(column: pa.Array) -> pa.Array:
        known: dict[bytes, list[int]] = {}
        made = []
        for page in arrays_of(column):
            key = page.tobytes()
            if key not in known:
                known[key] = viterbi(page, model)
            made.append(known[key])
        return _lists(made, pa.int32())

    return states(codes)
