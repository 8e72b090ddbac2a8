"""Reading level of each document: a latent difficulty model that links levels with the occurrence of words.

Units are sentences (where punctuation is lost, windows of words), each with a level theta on a continuous scale. A word w
has a difficulty ``b``, a slope ``k`` and a frequency ``c``; a unit of level theta shows it with probability
``p(w | theta) ~ c * sqrt(k) * exp(-k * (theta - b)^2 / 2)``, normalised over the words. That is the unfolding form of a
Rasch model: with equal slopes the log odds of two words are linear in theta, as in Rasch's; its curve has its top at the
word's difficulty instead of only rising or only falling, so it holds words that are common at middle levels.

Levels and word parameters are estimated in turn. Given the words, each unit gets its distribution over theta (on ``GRID``);
given these, three sums a word (1, theta, theta^2) over all documents give its parameters anew, with the graded passages
held at their bands. Passes over the documents yield sums of fixed size (three for each word of the passages), so only those
reach the driver. Cut points between bands are fitted on the passages: where they part the levels of units with fewest
errors. A document's band is the one between whose cut points most of its units' levels lie, its theta their mean.

Training: all graded passages, at most ``LABELLED`` of them; documents take part in every pass, all of them.

Defined results: null, empty and blank texts, texts in other languages, lists of figures, and texts of fewer than
``MIN_WORDS`` running words get no band. Repeated rows count once in the result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.scale import materialise

BANDS = 5
MIN_WORDS = 40
#: Share of words known from the passages from which a text is taken as English.
KNOWN_SHARE = 0.35
#: The same against all words between white space, for texts that are mostly in other scripts.
KNOWN_WRITTEN = 0.3
LABELLED = 20_000
ROUNDS = 2
#: A stretch without a full stop of more known words than LONG_UNIT is cut into windows of WINDOW.
LONG_UNIT, WINDOW = 60, 12
#: What one passage count weighs against one document count when strengths are counted anew.
ANCHOR = 20.0

#: Levels at which a unit's distribution is held.
GRID = np.arange(1.0, BANDS + 0.01, 0.25)
#: What is assumed of a word before it is seen: so many occurrences around the middle with this spread; and the least spread.
PRIOR_WORDS, MIDDLE, PRIOR_SPREAD, LEAST_SPREAD = 1.0, (1 + BANDS) / 2, 2.0, 0.02

#: Units scored at once.
SLICE = 8192

STOPS = {".": -1, "?": -1, "!": -1}
_WORDS = re.compile(r"[a-z]+|[.?!]")
_LIST_LINE = re.compile(r"(?m)^[^\S\n]*(?:\S+[^\S\n]+){0,3}[\d.,]+[^\S\n]*$")
_HYPHEN = re.compile(r"(?<=[a-z])-\n(?=[a-z])")
#: Dashes and the like stand between words, marks of cut words are hyphens.
_SPACES = {**dict.fromkeys(map(ord, "—–…«»“”·•\u2028\u2029"), " "), **dict.fromkeys(map(ord, "‐‑¬"), "-")}


def running_text(text: str | None) -> tuple[str, int]:
    """The text without lists of figures, in lower case and with cut words mended, and its number of words."""
    if not text:
        return "", 0
    if any(d in text for d in "0123456789"):
        text = _LIST_LINE.sub(" ", text)
    n = len(text.split())
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.translate(_SPACES).replace("\u00ad\n", "").replace("\u00ad", "")).encode("ascii", "ignore").decode()
    text = text.lower()
    return (_HYPHEN.sub("", text) if "\n" in text else text), n


def unit_ids(text: str, vocabulary: dict[str, int]) -> tuple[list[int], int]:
    """Ids of the known words with -1 at each end of a sentence, and the number of all words."""
    get = vocabulary.get
    ids = [-1 if w in STOPS else get(w, -2) for w in _WORDS.findall(text)]
    return [i for i in ids if i != -2], len(ids) - ids.count(-1)


def cut_units(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each known word the number of its unit, and whether that is a window; ``ids`` has -1 between sentences."""
    ends = ids == -1
    unit = np.cumsum(ends)[~ends]
    if not len(unit):
        return unit, np.zeros(0, dtype=bool)
    first = np.r_[0, np.flatnonzero(np.diff(unit)) + 1]
    size = np.diff(np.r_[first, len(unit)])
    inside = np.arange(len(unit)) - np.repeat(first, size)
    long = np.repeat(size, size) > LONG_UNIT
    both = unit * (len(ids) + 1) + np.where(long, inside // WINDOW, 0)
    return np.cumsum(np.r_[0, np.diff(both) != 0]), long


def parameters(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Difficulty and slope of each word from its sums of 1, theta and theta^2; a rare word is drawn to the middle and flat."""
    n, first, second = sums.T
    b = (first + PRIOR_WORDS * MIDDLE) / (n + PRIOR_WORDS)
    spread = (second - 2 * b * first + b * b * n + PRIOR_WORDS * PRIOR_SPREAD) / (n + PRIOR_WORDS)
    return b, 1.0 / (np.maximum(spread, 0.0) + LEAST_SPREAD)


def strengths(sums: np.ndarray) -> np.ndarray:
    """``log p(word | theta)`` at each level of ``GRID``."""
    b, k = parameters(sums)
    c = np.log(sums[:, 0] + 0.02)
    score = (c + 0.5 * np.log(k))[:, None] - 0.5 * k[:, None] * (GRID[None, :] - b[:, None]) ** 2
    return score - np.log(np.exp(score).sum(axis=0))


def cut_points(theta: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Between each two bands the level that parts the given ones with fewest errors (of several the one in the middle)."""
    cuts = []
    for b in range(1, BANDS):
        near = np.unique(theta[(band == b) | (band == b + 1)])
        middles = (near[1:] + near[:-1]) / 2
        if not (len(middles) and (band <= b).any() and (band > b).any()):
            cuts.append(b + 0.5)
            continue
        low, high = np.sort(theta[band <= b]), np.sort(theta[band > b])
        errors = len(low) - np.searchsorted(low, middles) + np.searchsorted(high, middles)
        best = np.flatnonzero(errors == errors.min())
        cuts.append(float(middles[best[len(best) // 2]]))
    return np.maximum.accumulate(np.array(cuts))


class Model:
    """Vocabulary, sums of the passages, strengths, cut points, and mean known words of a sentence of each band."""

    def __init__(self, passages: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        rows = []
        for band, text in passages:
            text, _ = running_text(text)
            for w in _WORDS.findall(text):
                if w not in STOPS:
                    self.vocabulary.setdefault(w, len(self.vocabulary))
            rows.append((band, np.array(unit_ids(text, self.vocabulary)[0], dtype=np.int64)))
        self.passages = rows
        self.anchors = np.zeros((max(1, len(self.vocabulary)), 3))
        known, sentences = np.zeros(BANDS), np.zeros(BANDS)
        for band, ids in rows:
            words = ids[ids >= 0]
            for power in range(3):
                np.add.at(self.anchors[:, power], words, float(band) ** power)
            known[band - 1] += len(words)
            sentences[band - 1] += len(np.unique(cut_units(ids)[0]))
        self.length = np.where(sentences > 0, known / np.maximum(sentences, 1), 1.0)
        self.set(self.anchors)

    def set(self, sums: np.ndarray) -> None:
        """Take the parameters of ``sums`` and fit the cut points on the passages."""
        self.sums, self.beta = sums, strengths(sums)
        theta, band = [np.zeros(0)], [np.zeros(0)]
        for b, ids in self.passages:
            p = unit_levels(ids, self.beta)[2]
            theta.append(p @ GRID)
            band.append(np.full(len(p), b))
        self.cuts = cut_points(np.concatenate(theta), np.concatenate(band))


def unit_levels(ids: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Known words, their units; of each unit the probabilities, the number of words and whether it is a window.

    ``ids`` may hold many documents.
    """
    unit, long = cut_units(ids)
    words = ids[ids >= 0]
    if not len(words):
        return words, unit, np.zeros((0, len(GRID))), np.zeros(0), long
    first = np.r_[0, np.flatnonzero(np.diff(unit)) + 1]
    score = np.zeros((len(first), len(GRID)))
    for a in range(0, len(first), SLICE):  # whole units at a time, so that a very long text takes no more room than others
        part = first[a : a + SLICE]
        end = first[a + SLICE] if a + SLICE < len(first) else len(words)
        score[a : a + SLICE] = np.add.reduceat(beta[words[part[0] : end]], part - part[0], axis=0)
    score -= score.max(axis=1, keepdims=True)
    p = np.exp(score)
    return words, unit, p / p.sum(axis=1, keepdims=True), np.diff(np.r_[first, len(unit)]).astype(float), long[first]


def document_level(ids: np.ndarray, beta: np.ndarray, cuts: np.ndarray, length: np.ndarray) -> tuple[int, float]:
    """Band and theta of one document. A sentence counts once, a fragment or window by its words against a usual sentence."""
    _, _, p, n, window = unit_levels(ids, beta)
    if not len(n):
        return 0, 0.0
    theta = p @ GRID
    weight = n / length[np.digitize(theta, cuts)]
    weight = np.where(window, weight, np.minimum(1.0, weight))
    share = np.bincount(np.digitize(GRID, cuts), weights=weight @ p, minlength=BANDS)
    level = float(weight @ theta / weight.sum())
    best = np.flatnonzero(share >= share.max() * (1 - 1e-9)) + 1
    return int(min(best, key=lambda b: (abs(b - level), b))), level


def features(documents: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """``doc_id, ids`` of the documents that get a band."""
    from pyspark.sql import types as T

    narrow = documents.select("doc_id", "text")
    kind = narrow.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, made = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                text, n = running_text(text)
                if n < MIN_WORDS:
                    continue
                ids, words = unit_ids(text, vocabulary)
                known = sum(x >= 0 for x in ids)
                if known >= KNOWN_SHARE * max(1, words) and known >= KNOWN_WRITTEN * n:
                    keep.append(i)
                    made.append(np.array(ids, dtype=np.int16 if len(vocabulary) < 32_000 else np.int32))
            offsets = np.zeros(len(made) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in made], out=offsets[1:])
            values = np.concatenate(made).astype(np.int32) if made else np.zeros(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["doc_id", "ids"])

    return narrow.mapInArrow(run, T.StructType([kind, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(column.flatten(), dtype=np.int64), np.diff(np.asarray(column.offsets))


def count_anew(feats: DataFrame, beta: np.ndarray) -> np.ndarray:
    """Sums of 1, theta and theta^2 of each word over all documents, added up by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(beta), 3))
        for batch in batches:
            values, sizes = _lists(batch.column(0))
            # a unit never goes on into the next document
            ids = np.insert(values, np.cumsum(sizes)[:-1], -1) if len(sizes) else values
            words, unit, p, _, _ = unit_levels(ids, beta)
            if len(words):
                for power in range(3):
                    total[:, power] += np.bincount(words, weights=(p @ GRID**power)[unit], minlength=len(beta))
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["at", "n"])

    sums = feats.select("ids").mapInArrow(run, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()  # three rows for each word of the passages
    out = np.zeros(len(beta) * 3)
    for r in sums:
        out[r["at"]] = r["n"]
    return out.reshape(len(beta), 3)


def fit(documents: DataFrame, passages: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The fitted model and the features of the documents that it was fitted on."""
    rows = passages.where("passage is not null and band between 1 and 5").select("band", "passage").orderBy("passage_id").limit(LABELLED).collect()
    model = Model([(r["band"], r["passage"]) for r in rows])
    feats = materialise(features(documents, model.vocabulary), "levels")
    for _ in range(rounds):
        seen = count_anew(feats, model.beta)
        weight = max(ANCHOR, seen[:, 0].sum() / max(1.0, model.anchors[:, 0].sum()))  # passages weigh as much as all documents
        model.set(model.anchors * weight + seen)
    return model, feats


def levels(documents: DataFrame, passages: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, band, theta`` of every document with enough running English text."""
    from pyspark.sql import types as T

    model, feats = fit(documents, passages, rounds)
    beta, cuts, length = model.beta, model.cuts, model.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, sizes = _lists(batch.column(1))
            ends = np.cumsum(sizes)
            got = [document_level(values[e - n : e], beta, cuts, length) for e, n in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b for b, _ in got], pa.int64()), pa.array([t for _, t in got], pa.float64())], ["doc_id", "band", "theta"])

    return feats.mapInArrow(run, T.StructType([feats.schema["doc_id"], T.StructField("band", T.LongType()), T.StructField("theta", T.DoubleType())])).where("band > 0").distinct()


def profile(found: DataFrame) -> DataFrame:
    """Documents and mean theta of each band."""
    return found.groupBy("band").agg(F.count("*").alias("documents"), F.avg("theta").alias("mean_theta"))


def word_difficulty(documents: DataFrame, passages: DataFrame) -> DataFrame:
    """``word, difficulty, slope``: the parameters of each known word; at most as many rows as the passages have words."""
    model, feats = fit(documents, passages)
    b, k = parameters(model.sums)
    rows = [(w, float(b[i]), float(k[i])) for w, i in model.vocabulary.items()]
    return feats.sparkSession.createDataFrame(rows, "word string, difficulty double, slope double")
