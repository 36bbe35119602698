"""Boxes as four double columns: corners x1, y1 (included) to x2, y2 (excluded), in pixels. All are plain expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    x1: Column
    y1: Column
    x2: Column
    y2: Column


def box(prefix: str = "", names: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2")) -> Box:
    """The box in the columns ``x1 .. y2``, each with ``prefix`` before its name (also 'a.' of an alias)."""
    return Box(*[F.col(prefix + n) for n in names])


def field_box(struct: Column) -> Box:
    return Box(*[struct[n] for n in ("x1", "y1", "x2", "y2")])


def array_box(c: Column) -> Box:
    """The box in an array of four numbers; all null if the array has another length."""
    return Box(*[F.when(F.size(c) == 4, F.get(c, k)) for k in range(4)])


def area(b: Box) -> Column:
    """Null where a corner is null; 0 for turned-over boxes."""
    return F.greatest(F.lit(0.0), b.x2 - b.x1) * F.greatest(F.lit(0.0), b.y2 - b.y1)


def area_ratio(b: Box, width: Column, height: Column) -> Column:
    whole = (width * height).cast("double")
    return F.when(whole > 0, area(b) / whole)


def intersection(a: Box, b: Box) -> Column:
    return F.greatest(F.lit(0.0), F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)) * F.greatest(F.lit(0.0), F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where the union is empty."""
    shared = intersection(a, b)
    union = area(a) + area(b) - shared
    return F.when(union > 0, shared / union).otherwise(0.0)


def containment(inner: Box, outer: Box) -> Column:
    """Share of ``inner`` inside ``outer``; 0 for an empty ``inner``."""
    return F.when(area(inner) > 0, intersection(inner, outer) / area(inner)).otherwise(0.0)


def size_ratio(a: Box, b: Box, least: float = 1e-9) -> Column:
    """Larger over smaller area; the smaller one counts as ``least`` at least."""
    return F.greatest(area(a), area(b)) / F.greatest(F.least(area(a), area(b)), F.lit(least))


def center_offset(a: Box, b: Box) -> Column:
    """Distance of the centres over the smaller side, on the axis where it is greater; null for an empty side."""

    def axis(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
        side = F.least(a2 - a1, b2 - b1)
        return F.when(side > 0, F.abs((a1 + a2) / 2 - (b1 + b2) / 2) / side)

    return F.greatest(axis(a.x1, a.x2, b.x1, b.x2), axis(a.y1, a.y2, b.y1, b.y2))


def center_distance(a: Box, b: Box, width: Column, height: Column) -> Column:
    """Squared distance of the centres, in shares of the image."""
    dx = ((b.x1 + b.x2) / 2 - (a.x1 + a.x2) / 2) / width
    dy = ((b.y1 + b.y2) / 2 - (a.y1 + a.y2) / 2) / height
    return dx * dx + dy * dy


def clip(b: Box, width: Column, height: Column) -> Box:
    w, h, zero = width.cast("double"), height.cast("double"), F.lit(0.0)
    return Box(F.greatest(zero, F.least(b.x1, w)), F.greatest(zero, F.least(b.y1, h)), F.greatest(zero, F.least(b.x2, w)), F.greatest(zero, F.least(b.y2, h)))


def is_valid(b: Box, width: Column, height: Column, min_side: float = 1.0) -> Column:
    """Inside the image, not empty and no side under ``min_side``; false where anything is null."""
    test = (b.x1 >= 0) & (b.x1 < b.x2) & (b.x2 <= width) & (b.y1 >= 0) & (b.y1 < b.y2) & (b.y2 <= height)
    return F.coalesce(test & (b.x2 - b.x1 >= min_side) & (b.y2 - b.y1 >= min_side), F.lit(False))


def from_unit_xywh(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    return Box(x * width, y * height, (x + w) * width, (y + h) * height)


def from_unit_center(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    return Box((cx - w / 2) * width, (cy - h / 2) * height, (cx + w / 2) * width, (cy + h / 2) * height)


def is_unit_region(b: Box, scale: float = 1000.0) -> Column:
    """A finite, non-empty region within 0..``scale``."""
    test = (b.x1 >= 0) & (b.x1 < b.x2) & (b.x2 <= scale) & (b.y1 >= 0) & (b.y1 < b.y2) & (b.y2 <= scale)
    return F.coalesce(test & ~F.isnan(b.x1) & ~F.isnan(b.y1) & ~F.isnan(b.x2) & ~F.isnan(b.y2), F.lit(False))


def region_to_pixels(b: Box, width: Column, height: Column, padding: float = 0.0, scale: float = 1000.0) -> Box:
    """A region of 0..``scale`` as whole pixels, padded by a share of its sides; null where it is invalid."""
    dx, dy = (b.x2 - b.x1) * padding, (b.y2 - b.y1) * padding
    zero, top = F.lit(0.0), F.lit(scale)
    raw = Box(
        F.floor(F.greatest(zero, b.x1 - dx) * width / scale).cast("double"),
        F.floor(F.greatest(zero, b.y1 - dy) * height / scale).cast("double"),
        F.ceil(F.least(top, b.x2 + dx) * width / scale).cast("double"),
        F.ceil(F.least(top, b.y2 + dy) * height / scale).cast("double"),
    )
    good = is_unit_region(b, scale) & is_valid(raw, width, height)
    return Box(*[F.when(good, c) for c in raw])


def checked_region(b: Box, width: Column, height: Column, scale: float = 1000.0) -> Box:
    """As ``region_to_pixels`` without padding; an invalid region ends the query with an error."""
    error = F.raise_error("invalid normalized region").cast("double")
    return Box(*[F.when(is_unit_region(b, scale), c).otherwise(error) for c in region_to_pixels(b, width, height, 0.0, scale)])


def crop_to_original(b: Box, region: Box, crop_width: Column, crop_height: Column) -> Box:
    """A box found in a crop, in the coordinates of the image the crop was taken from."""
    sx, sy = region.x2 - region.x1, region.y2 - region.y1
    return Box(region.x1 + b.x1 * sx / crop_width, region.y1 + b.y1 * sy / crop_height, region.x1 + b.x2 * sx / crop_width, region.y1 + b.y2 * sy / crop_height)


def expand(b: Box, width: Column, height: Column, scale: float = 1.0, minimum: float = 0.0) -> Box:
    """A window around the box's centre: ``scale`` times its sides, at least ``minimum`` of the image, moved inside it."""

    def axis(lo: Column, hi: Column, whole: Column) -> tuple[Column, Column]:
        size = F.least(whole, F.greatest((hi - lo) * scale, whole * minimum))
        start = F.greatest(F.lit(0.0), F.least(whole - size, (lo + hi) / 2 - size / 2))
        return F.floor(start).cast("double"), F.ceil(start + size).cast("double")

    x1, x2 = axis(b.x1, b.x2, width.cast("double"))
    y1, y2 = axis(b.y1, b.y2, height.cast("double"))
    return Box(x1, y1, x2, y2)


def padded(b: Box, width: Column, height: Column, padding: float) -> Box:
    """The box grown by a share of its sides on every side, clipped to the image, in whole pixels."""
    dx, dy = (b.x2 - b.x1) * padding, (b.y2 - b.y1) * padding
    grown = clip(Box(b.x1 - dx, b.y1 - dy, b.x2 + dx, b.y2 + dy), width, height)
    return Box(F.floor(grown.x1).cast("double"), F.floor(grown.y1).cast("double"), F.ceil(grown.x2).cast("double"), F.ceil(grown.y2).cast("double"))


def matches(a: Box, b: Box, min_iou: float = 0.5, min_containment: float = 0.8, max_size_ratio: float = 3.0) -> Column:
    """Boxes of one thing: enough overlap, or the smaller within the larger at a like size."""
    a_in_b = area(a) <= area(b)
    inside = F.when(a_in_b, containment(a, b)).otherwise(containment(b, a))
    like = (F.least(area(a), area(b)) > 0) & (inside >= min_containment) & (size_ratio(a, b) <= max_size_ratio)
    return (iou(a, b) >= min_iou) | like


def threshold_label(value: float) -> str:
    return f"{value:g}".replace(".", "_")


def size_columns(b: Box, width: Column, height: Column, least: float = 1e-5, preferred: tuple[float, float] = (1e-3, 0.10), most: float = 0.10) -> dict[str, Column]:
    """Short side, share of the image, band, and whether and why the size is refused."""
    ratio = area_ratio(b, width, height)
    reason = F.when(ratio < least, f"bbox_area_below_{threshold_label(least * 100)}_percent").when(ratio > most, f"bbox_area_above_{threshold_label(most * 100)}_percent")
    band = F.when(ratio < preferred[0], "borderline_small").when(ratio <= preferred[1], "preferred").when(ratio <= most, "large_acceptable").otherwise("too_large")
    return {"bbox_short_side_px": F.least(b.x2 - b.x1, b.y2 - b.y1), "bbox_area_ratio": ratio, "size_band": band, "size_pass": reason.isNull(), "size_reject_reason": reason}
