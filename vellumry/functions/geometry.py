"""Boxes, polygons and page coordinates as column expressions.

A flat polygon is ``array<double>`` x, y, x, y; a point polygon ``array<struct<x,y>>``. Lengths name their unit: inches
(``_in``), points (``_pt``, 1/72 inch), pixels (``_px``). Rounding is half to even throughout. Null in, null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Resolutions and padding.
FLAG_DPI, PAGE_DPI, CROP_PAD_IN = 300, 150, 0.08
#: The page outline with a notch at the lower right, in pixels.
DEFAULT_POLYGON = [(172, 234), (4916, 208), (4952, 5556), (2669, 5540), (2679, 6653), (182, 6622)]
#: Messages of polygon validation.
TOO_FEW, NO_COORDINATES, TOO_FEW_UNIQUE = "Polygon must contain at least 3 points", "Every polygon point must contain x and y", "Polygon must contain at least 3 unique points"


def _d(v: float) -> Column:
    return F.lit(float(v))


def flat_bbox(poly: Column) -> Column:
    """``struct<x0,y0,x1,y1>`` of a flat polygon."""
    xs, ys = F.filter(poly, lambda v, i: i % 2 == 0), F.filter(poly, lambda v, i: i % 2 == 1)
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def bbox_union(a: Column, b: Column) -> Column:
    return F.struct(F.least(a["x0"], b["x0"]).alias("x0"), F.least(a["y0"], b["y0"]).alias("y0"), F.greatest(a["x1"], b["x1"]).alias("x1"), F.greatest(a["y1"], b["y1"]).alias("y1"))


def bbox_to_flat(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Clockwise from the upper left."""
    return F.array(x0, y0, x1, y0, x1, y1, x0, y1)


def crop_window(x0: Column, y0: Column, x1: Column, y1: Column, dpi: int = FLAG_DPI, pad: float = CROP_PAD_IN) -> Column:
    """Pixel window around a box in inches: padded, cut off at 0 only, truncated to whole pixels."""
    px = lambda c: (c * F.lit(dpi)).try_cast("int")
    return F.struct(px(F.greatest(_d(0), x0 - _d(pad))).alias("left"), px(F.greatest(_d(0), y0 - _d(pad))).alias("top"), px(x1 + _d(pad)).alias("right"), px(y1 + _d(pad)).alias("bottom"))


def center(lo: Column, hi: Column) -> Column:
    return (lo + hi) / _d(2)


def points_to_pixels(pt: Column, dpi: int = PAGE_DPI) -> Column:
    return F.bround(pt / _d(72) * F.lit(dpi)).try_cast("int")


def points_to_inches(pt: Column) -> Column:
    return F.bround(pt / _d(72), 4)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def default_polygon(width: Column | None = None, height: Column | None = None, notch: str = "fixed") -> Column:
    """The fixed outline, or with ``notch="relative"`` the page less a lower-right part of 1/2.5 by 1/8."""
    if notch == "fixed":
        return F.array(*[point(_d(x), _d(y)) for x, y in DEFAULT_POLYGON])
    w, h, zero = width.cast("double"), height.cast("double"), _d(0)
    right, bottom = F.greatest(zero, w - 1), F.greatest(zero, h - 1)
    left = F.least(right, F.greatest(zero, w - F.greatest(_d(1), F.floor(w / _d(2.5)).cast("double"))))
    top = F.least(bottom, F.greatest(zero, h - F.greatest(_d(1), F.floor(h / _d(8)).cast("double"))))
    return F.array(point(zero, zero), point(right, zero), point(right, top), point(left, top), point(left, bottom), point(zero, bottom))


def rescale(poly: Column, old_w: Column, old_h: Column, new_w: Column, new_h: Column) -> Column:
    sx, sy = new_w / F.greatest(F.lit(1), old_w), new_h / F.greatest(F.lit(1), old_h)
    return F.transform(poly, lambda q: point(F.bround(q["x"] * sx).cast("double"), F.bround(q["y"] * sy).cast("double")))


def clamp(v: Column, size: Column) -> Column:
    return F.greatest(_d(0), F.least(size.cast("double") - 1, v))


def validated(poly: Column, width: Column, height: Column) -> Column:
    """``struct<polygon,error>``: truncated and clamped points, or the reason against the polygon."""
    kept = F.transform(poly, lambda q: point(clamp(q["x"].try_cast("long").cast("double"), width), clamp(q["y"].try_cast("long").cast("double"), height)))
    bare = F.exists(poly, lambda q: q["x"].isNull() | q["y"].isNull())
    error = F.when(poly.isNull() | (F.size(poly) < 3), TOO_FEW).when(bare, NO_COORDINATES).when(F.size(F.array_distinct(kept)) < 3, TOO_FEW_UNIQUE)
    return F.struct(F.when(error.isNull(), kept).alias("polygon"), error.alias("error"))


def bounding_rectangle(poly: Column, width: Column, height: Column) -> Column:
    """Right and bottom exclusive, cut to the image."""
    xs, ys = F.transform(poly, lambda q: q["x"]), F.transform(poly, lambda q: q["y"])
    return F.struct(F.greatest(_d(0), F.array_min(xs)).alias("left"), F.greatest(_d(0), F.array_min(ys)).alias("top"), F.least(width.cast("double"), F.array_max(xs) + 1).alias("right"), F.least(height.cast("double"), F.array_max(ys) + 1).alias("bottom"))


def contains(poly: Column, x: Column, y: Column) -> Column:
    """Even-odd rule: whether a ray to the right of the point meets an odd number of edges."""
    edges = F.arrays_zip(poly.alias("a"), F.concat(F.slice(poly, F.size(poly), 1), F.slice(poly, F.lit(1), F.size(poly) - 1)).alias("b"))

    def meets(e: Column) -> Column:
        xa, ya, xb, yb = e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]
        return ((ya > y) != (yb > y)) & (x < (xb - xa) * (y - ya) / (yb - ya + _d(1e-9)) + xa)

    return F.when(F.size(poly) > 0, F.size(F.filter(edges, meets)) % 2 == 1).otherwise(F.lit(False))


def eight_points(poly: Column) -> Column:
    """A quadrilateral with the middle of each edge put in; anything else as it is."""

    def with_middle(q: Column, i: Column) -> Column:
        n = F.get(poly, (i + 1) % 4)
        return F.array(q, point((q["x"] + n["x"]) / 2, (q["y"] + n["y"]) / 2))

    return F.when(F.size(poly) == 4, F.flatten(F.transform(poly, with_middle))).otherwise(poly)


def _shift(lo: Column, hi: Column, size: Column) -> Column:
    end = size.cast("double") - 1
    return F.when(lo < 0, -lo).when(hi > end, end - hi).otherwise(_d(0))


def back_on_page(poly: Column, width: Column, height: Column) -> Column:
    """Moved by the least way onto the page, the upper left first; points still outside are clamped."""
    xs, ys = F.transform(poly, lambda q: q["x"]), F.transform(poly, lambda q: q["y"])
    dx, dy = _shift(F.array_min(xs), F.array_max(xs), width), _shift(F.array_min(ys), F.array_max(ys), height)
    return F.transform(poly, lambda q: point(clamp(q["x"] + dx, width), clamp(q["y"] + dy, height)))


def fit_canvas(width: Column, height: Column, canvas_w: Column, canvas_h: Column, guard: bool = True, padding: int = 16) -> Column:
    """Scale, rendered size and offset of a page in a canvas; ``guard`` keeps the room at 1 pixel at least."""
    room_w, room_h = canvas_w - padding, canvas_h - padding
    if guard:
        room_w, room_h = F.greatest(F.lit(1), room_w), F.greatest(F.lit(1), room_h)
    scale = F.least(F.try_divide(room_w, width), F.try_divide(room_h, height))
    rw, rh = F.greatest(F.lit(1), F.bround(width * scale).cast("int")), F.greatest(F.lit(1), F.bround(height * scale).cast("int"))
    return F.struct(scale.alias("scale"), rw.alias("rendered_w"), rh.alias("rendered_h"), F.greatest(F.lit(0), F.floor((canvas_w - rw) / 2)).alias("offset_x"), F.greatest(F.lit(0), F.floor((canvas_h - rh) / 2)).alias("offset_y"))


def to_canvas(poly: Column, fit: Column) -> Column:
    return F.transform(poly, lambda q: point(q["x"] * fit["scale"] + fit["offset_x"], q["y"] * fit["scale"] + fit["offset_y"]))


def to_page(poly: Column, fit: Column) -> Column:
    return F.transform(poly, lambda q: point((q["x"] - fit["offset_x"]) / fit["scale"], (q["y"] - fit["offset_y"]) / fit["scale"]))


def to_flat(poly: Column) -> Column:
    return F.flatten(F.transform(poly, lambda q: F.array(q["x"], q["y"])))


def handle_at(poly: Column, x: Column, y: Column, radius: int = 6) -> Column:
    """0-based number of the first corner within twice the radius on both axes, or null."""
    hits = F.transform(poly, lambda q: (F.abs(q["x"] - x) <= 2 * radius) & (F.abs(q["y"] - y) <= 2 * radius))
    return F.nullif(F.array_position(hits, True), F.lit(0)) - 1


def translated(poly: Column, dx: Column, dy: Column, width: Column, height: Column) -> Column:
    return F.transform(poly, lambda q: point(clamp(q["x"] + dx, width), clamp(q["y"] + dy, height)))


def corner_moved(poly: Column, index: Column, dx: Column, dy: Column, width: Column, height: Column) -> Column:
    return F.transform(poly, lambda q, i: F.when(i == index, point(clamp(q["x"] + dx, width), clamp(q["y"] + dy, height))).otherwise(q))


def saved(poly: Column, width: Column, height: Column) -> Column:
    """Clamped, then rounded to whole pixels."""
    return F.transform(poly, lambda q: point(F.bround(clamp(q["x"], width)), F.bround(clamp(q["y"], height))))
