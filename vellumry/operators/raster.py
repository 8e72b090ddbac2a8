"""Images as grey or colour values, row by row: kernels on whole batches in numpy.

An image is an array of whole numbers or, for pages as they are scanned, a binary of one byte for each value; a result has
the form of its input. Images of one frame have one size. Kernels need a page image at a time, which is one row, and never
make Python numbers of pixels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of cleaning: contrast, threshold block and constant, deskew limits, weights of the channels.
GAIN, OFFSET, BLOCK, CONSTANT = 1.5, -100.0, 31, 10
SPARSE, MOST_ANGLE, LEAST_ANGLE = 1000, 15.0, 1.0
CHANNELS = (0.114, 0.587, 0.299)


def gray(first: Column, second: Column, third: Column) -> Column:
    """Channels weighted by ``CHANNELS`` in their order."""
    both = F.arrays_zip(first.alias("a"), second.alias("b"), third.alias("c"))
    return F.transform(both, lambda p: F.bround(p["a"] * F.lit(CHANNELS[0]) + p["b"] * F.lit(CHANNELS[1]) + p["c"] * F.lit(CHANNELS[2])).cast("int"))


def contrast(image: Column) -> Column:
    """Absolute value of 1.5 v - 100, at most 255: dark values fold upward."""
    return F.transform(image, lambda v: F.least(F.lit(255), F.bround(F.abs(v * F.lit(GAIN) + F.lit(OFFSET))).cast("int")))


def deskew_decision(non_zero: Column, angle: Column) -> Column:
    """``struct<decision,angle>``: sparse and steep pages and small angles are kept, others turned."""
    turn = F.when(angle < -45, -(angle + 90)).otherwise(-angle)
    what = F.when(non_zero < SPARSE, "sparse").when(F.abs(turn) > MOST_ANGLE, "too_steep").when(F.abs(turn) < LEAST_ANGLE, "straight").otherwise("rotate")
    return F.struct(what.alias("decision"), turn.alias("angle"))


# Kernels: stacks of images (n, height, width) to stacks


def grays(stack: np.ndarray) -> np.ndarray:
    """Of colour images (n, height, width, 3)."""
    return np.rint(stack @ np.array(CHANNELS))


def medians(stack: np.ndarray) -> np.ndarray:
    n, h, w = stack.shape
    wide = np.pad(stack, ((0, 0), (1, 1), (1, 1)), mode="edge")
    return np.median(np.stack([wide[:, y : y + h, x : x + w] for y in range(3) for x in range(3)]), axis=0)


def contrasts(stack: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.rint(np.abs(stack * GAIN + OFFSET)))


def gaussian(size: int) -> np.ndarray:
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    at = np.arange(size) - (size - 1) / 2
    k = np.exp(-(at**2) / (2 * sigma**2))
    return k / k.sum()


def thresholds(stack: np.ndarray, block: int = BLOCK, constant: float = CONSTANT) -> np.ndarray:
    """255 where a pixel is above its Gaussian mean less the constant, else 0."""
    _, h, w = stack.shape
    r = block // 2
    wide = np.pad(stack.astype(float), ((0, 0), (r, r), (r, r)), mode="edge")
    rows = np.zeros((len(stack), h + 2 * r, w))
    for i, k in enumerate(gaussian(block)):
        rows += k * wide[:, :, i : i + w]
    mean = np.zeros((len(stack), h, w))
    for i, k in enumerate(gaussian(block)):
        mean += k * rows[:, i : i + h]
    return np.where(stack > np.rint(mean) - constant, 255, 0)


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of points with distinct first coordinates sorted, two for each (least and greatest)."""
    sides = []
    for order in (points, points[::-1]):
        side: list[np.ndarray] = []
        for p in order:
            while len(side) > 1:
                (ax, ay), (bx, by) = side[-1] - side[-2], p - side[-2]
                if ax * by - ay * bx > 0:
                    break
                side.pop()
            side.append(p)
        sides.extend(side[:-1])
    return np.array(sides)


def skew_angle(image: np.ndarray) -> tuple[int, float]:
    """Number of non-zero pixels, and the angle, from -90 up to 0, of the smallest rectangle around them (row, column)."""
    rows, cols = np.nonzero(image)
    if len(rows) < 3:
        return len(rows), 0.0
    ys, first = np.unique(rows, return_index=True)
    last = np.r_[first[1:], len(rows)] - 1
    ends = np.unique(np.concatenate([np.stack([ys, cols[first]], 1), np.stack([ys, cols[last]], 1)]), axis=0).astype(float)
    corners = hull(ends)
    if len(corners) < 3:
        return len(rows), 0.0
    edges = np.diff(np.vstack([corners, corners[:1]]), axis=0)
    angles = np.unique(np.round(np.degrees(np.arctan2(edges[:, 1], edges[:, 0])) % 90.0, 9))
    turn = np.radians(angles)
    along = corners @ np.stack([np.cos(turn), np.sin(turn)])
    across = corners @ np.stack([-np.sin(turn), np.cos(turn)])
    angle = angles[int(np.argmin(np.ptp(along, axis=0) * np.ptp(across, axis=0)))]
    return len(rows), float(angle - 90.0) if angle else 0.0


def _cubic(t: np.ndarray) -> np.ndarray:
    t, a = np.abs(t), -0.75
    return np.where(t <= 1, (a + 2) * t**3 - (a + 3) * t**2 + 1, np.where(t < 2, a * (t**3 - 5 * t**2 + 8 * t - 4), 0.0))


def rotate(image: np.ndarray, angle: float) -> np.ndarray:
    """Turned about the middle by ``angle`` degrees, counterclockwise; cubic interpolation, border values repeated."""
    h, w = image.shape
    cx, cy, rad = w // 2, h // 2, np.radians(angle)
    y, x = np.mgrid[0:h, 0:w].astype(float)
    sx = np.cos(rad) * (x - cx) - np.sin(rad) * (y - cy) + cx
    sy = np.sin(rad) * (x - cx) + np.cos(rad) * (y - cy) + cy
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    out = np.zeros((h, w))
    for dy in range(-1, 3):
        weight = _cubic(sy - (y0 + dy))
        row = np.clip(y0 + dy, 0, h - 1)
        for dx in range(-1, 3):
            out += weight * _cubic(sx - (x0 + dx)) * image[row, np.clip(x0 + dx, 0, w - 1)]
    return np.clip(np.rint(out), 0, 255)


def deskewed(image: np.ndarray) -> tuple[np.ndarray, str, float]:
    """The image, turned where ``deskew_decision`` says so, with the decision and the angle."""
    n, angle = skew_angle(image)
    turn = -(angle + 90) if angle < -45 else -angle
    if n < SPARSE:
        return image, "sparse", turn
    if abs(turn) > MOST_ANGLE:
        return image, "too_steep", turn
    if abs(turn) < LEAST_ANGLE:
        return image, "straight", turn
    return rotate(image, turn), "rotate", turn


def fill(polygons: list[np.ndarray], width: int, height: int) -> np.ndarray:
    """Pixels of all polygons of three points: those whose centre one holds (even-odd), and those of its outline.

    Corners are cut to whole numbers.
    """
    y, x = np.mgrid[0:height, 0:width].astype(float)
    out = np.zeros((height, width), dtype=bool)
    for p in polygons:
        if len(p) < 3:
            continue
        p = np.trunc(p)
        inside = np.zeros_like(out)
        for (xa, ya), (xb, yb) in zip(np.roll(p, 1, axis=0), p):
            inside ^= ((ya > y) != (yb > y)) & (x < (xb - xa) * (y - ya) / (yb - ya + 1e-9) + xa)
            steps = int(max(abs(xb - xa), abs(yb - ya))) + 1
            lx, ly = np.rint(np.linspace(xa, xb, steps)).astype(int), np.rint(np.linspace(ya, yb, steps)).astype(int)
            seen = (lx >= 0) & (lx < width) & (ly >= 0) & (ly < height)
            out[ly[seen], lx[seen]] = True
        out |= inside
    return out


# Frames


def stack_of(column: pa.Array, *shape: int) -> np.ndarray:
    """The images of an Arrow column, lists or binaries, as one stack."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return np.stack([np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in column]).reshape(-1, *shape) if len(column) else np.zeros((0, *shape), dtype=np.uint8)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, *shape)


def column_of(stack: np.ndarray, kind: pa.DataType) -> pa.Array:
    size = int(np.prod(stack.shape[1:]))
    if pa.types.is_binary(kind) or pa.types.is_large_binary(kind):
        return pa.array([x.tobytes() for x in stack.astype(np.uint8)], kind)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(stack) + 1, dtype=np.int32) * size), pa.array(stack.astype(np.int32).ravel())).cast(kind)


def per_image(images: DataFrame, key: str, shape: tuple[int, ...], kernel: Callable, *extra: str) -> DataFrame:
    """``key, image`` with ``kernel(stack, *columns of extra)`` applied to each batch."""
    narrow = images.select(key, "image", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            made = kernel(stack_of(column, *shape), *[c.to_pylist() for c in batch.columns[2:]])
            yield pa.RecordBatch.from_arrays([batch.column(0), column_of(made, column.type)], [key, "image"])

    return narrow.mapInArrow(run, T.StructType([narrow.schema[key], narrow.schema["image"]]))


def median3(images: DataFrame, key: str, width: int, height: int) -> DataFrame:
    """Median of the 3 x 3 neighbourhood, border values repeated."""
    return per_image(images, key, (height, width), medians)


def binarise(images: DataFrame, key: str, width: int, height: int) -> DataFrame:
    return per_image(images, key, (height, width), thresholds)


def mask(images: DataFrame, key: str, width: int, height: int) -> DataFrame:
    """White outside all of the row's ``polygons`` (lists of flat x, y lists)."""

    def kernel(stack: np.ndarray, polygons: list) -> np.ndarray:
        held = [fill([np.asarray(p, dtype=float).reshape(-1, 2) for p in of_row or []], width, height) for of_row in polygons]
        return np.where(np.stack(held), stack, 255) if held else stack

    return per_image(images, key, (height, width), kernel, "polygons")


def deskew(images: DataFrame, key: str, width: int, height: int) -> DataFrame:
    """``key, image, decision, angle``: pages turned upright."""
    narrow = images.select(key, "image")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [deskewed(x) for x in stack_of(batch.column(1), height, width)]
            stack = np.stack([x for x, _, _ in got]) if got else np.zeros((0, height, width))
            yield pa.RecordBatch.from_arrays([batch.column(0), column_of(stack, batch.column(1).type), pa.array([d for _, d, _ in got], pa.string()), pa.array([a for _, _, a in got], pa.float64())], [key, "image", "decision", "angle"])

    return narrow.mapInArrow(run, T.StructType([*narrow.schema.fields, T.StructField("decision", T.StringType()), T.StructField("angle", T.DoubleType())]))


def clean(images: DataFrame, key: str, width: int, height: int, turn: bool = False) -> DataFrame:
    """The cleaning chain of colour images (three values a pixel): grey, median, contrast, threshold and, with ``turn``, deskew."""
    narrow = images.select(key, "image")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = thresholds(contrasts(medians(grays(stack_of(batch.column(1), height, width, 3)))))
            if turn and len(made):
                made = np.stack([deskewed(x)[0] for x in made])
            yield pa.RecordBatch.from_arrays([batch.column(0), column_of(made, batch.column(1).type)], [key, "image"])

    return narrow.mapInArrow(run, narrow.schema)


def cropped(image: Column, width: int, left: Column, top: Column, right: Column, bottom: Column) -> Column:
    """The window's pixels, row by row; the window lies within the image."""
    return F.flatten(F.transform(F.sequence(top, bottom - 1), lambda y: F.slice(image, y * width + left + 1, right - left)))
