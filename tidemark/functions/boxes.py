"""Box geometry and overlap measures as column expressions.  A box is four columns (x1, y1, x2, y2)."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-7


class Box(NamedTuple):
    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @classmethod
    def of(cls, prefix: str = "") -> Box:
        return cls(*(F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2")))

    @property
    def width(self) -> Column:
        return self.x2 - self.x1

    @property
    def height(self) -> Column:
        return self.y2 - self.y1

    @property
    def area(self) -> Column:
        return self.width * self.height


def from_centre(cx: Column, cy: Column, w: Column, h: Column) -> Box:
    return Box(cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2)


def to_centre(b: Box) -> tuple[Column, Column, Column, Column]:
    return (b.x1 + b.x2) / 2, (b.y1 + b.y2) / 2, b.width, b.height


def to_pixels(cx: Column, cy: Column, w: Column, h: Column, width: float, height: float, pad: tuple[float, float] = (0.0, 0.0)) -> Box:
    """Corners in pixels of a box given by centre and size as shares of the image."""
    return Box(width * (cx - w / 2) + pad[0], height * (cy - h / 2) + pad[1], width * (cx + w / 2) + pad[0], height * (cy + h / 2) + pad[1])


def to_shares(b: Box, width: float, height: float) -> tuple[Column, Column, Column, Column]:
    cx, cy, w, h = to_centre(b)
    return cx / width, cy / height, w / width, h / height


def of_points(points: Column) -> Box:
    """The box around an array of structs (x, y)."""
    return Box(F.array_min(points["x"]), F.array_min(points["y"]), F.array_max(points["x"]), F.array_max(points["y"]))


def unlettered(b: Box, gain: float, pad: tuple[float, float], width: float, height: float) -> Box:
    """A box of a padded, resized image in the original one, clipped to it."""
    return clipped(Box((b.x1 - pad[0]) / gain, (b.y1 - pad[1]) / gain, (b.x2 - pad[0]) / gain, (b.y2 - pad[1]) / gain), F.lit(float(width)), F.lit(float(height)))


def flipped(b: Box, width: Column) -> Box:
    """Mirrored left to right."""
    return Box(width - b.x2, b.y1, width - b.x1, b.y2)


def clipped(b: Box, width: Column, height: Column) -> Box:
    zero = F.lit(0.0)
    return Box(F.least(F.greatest(b.x1, zero), width), F.least(F.greatest(b.y1, zero), height), F.least(F.greatest(b.x2, zero), width), F.least(F.greatest(b.y2, zero), height))


def collapsed(b: Box, width: Column, height: Column) -> Column:
    """Whether a clipped box has shrunk onto one edge of the image."""
    return ((b.y1 == height) & (b.y2 == height)) | ((b.x1 == width) & (b.x2 == width)) | ((b.y1 == 0) & (b.y2 == 0)) | ((b.x1 == 0) & (b.x2 == 0))


def plausible(old: Box, new: Box, least_side: float = 2, most_aspect: float = 20, least_area: float = 0.1) -> Column:
    """Whether a box changed by augmentation is still a fair candidate."""
    w, h = new.width, new.height
    aspect = F.greatest(w / (h + 1e-16), h / (w + 1e-16))
    return (w > least_side) & (h > least_side) & (w * h / (old.area + 1e-16) > least_area) & (aspect < most_aspect)


def widened(b: Box, gain: float = 1.02, pad: float = 10.0, square: bool = False) -> Box:
    cx, cy, w, h = to_centre(b)
    if square:
        w = h = F.greatest(w, h)
    return from_centre(cx, cy, w * gain + pad, h * gain + pad)


def intersection(a: Box, b: Box) -> Column:
    zero = F.lit(0.0)
    return F.greatest(F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1), zero) * F.greatest(F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1), zero)


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; NULL where both boxes are empty."""
    inter = intersection(a, b)
    return F.try_divide(inter, a.area + b.area - inter)


def over_smaller(a: Box, b: Box) -> Column:
    """Intersection over the smaller area."""
    return F.try_divide(intersection(a, b), F.least(a.area, b.area))


def size_iou(w1: Column, h1: Column, w2: Column, h2: Column) -> Column:
    """Overlap of two boxes put corner on corner."""
    inter = F.least(w1, w2) * F.least(h1, h2)
    return F.try_divide(inter, w1 * h1 + w2 * h2 - inter)


def cover(a: Box, b: Box) -> Box:
    return Box(F.least(a.x1, b.x1), F.least(a.y1, b.y1), F.greatest(a.x2, b.x2), F.greatest(a.y2, b.y2))


def giou(a: Box, b: Box) -> Column:
    """IoU less the share of the common bounding box that neither box covers."""
    inter = intersection(a, b)
    union, c = a.area + b.area - inter, cover(a, b).area
    return F.try_divide(inter, union) - F.try_divide(c - union, c)


def _centre_gap(a: Box, b: Box) -> Column:
    x, y = b.x1 + b.x2 - a.x1 - a.x2, b.y1 + b.y2 - a.y1 - a.y2
    return (x * x + y * y) / 4


def _diagonal(a: Box, b: Box) -> Column:
    c = cover(a, b)
    return c.width * c.width + c.height * c.height


def diou(a: Box, b: Box) -> Column:
    """IoU less the squared gap of the centres over the squared diagonal of the common bounding box."""
    return iou(a, b) - F.try_divide(_centre_gap(a, b), _diagonal(a, b))


def soft_iou(a: Box, b: Box, kind: str = "iou") -> Column:
    """The measures with a small constant in heights and denominators: kind iou, giou, diou or ciou."""
    inter = intersection(a, b)
    w1, h1, w2, h2 = a.width, a.height + EPS, b.width, b.height + EPS
    union = w1 * h1 + w2 * h2 - inter + EPS
    base = inter / union
    if kind == "iou":
        return base
    if kind == "giou":
        c = cover(a, b).area + EPS
        return base - (c - union) / c
    away = _centre_gap(a, b) / (_diagonal(a, b) + EPS)
    if kind == "diou":
        return base - away
    angle = F.atan(w2 / (h2 + EPS)) - F.atan(w1 / (h1 + EPS))
    v = 4 / math.pi**2 * angle * angle
    return base - (away + v * (v / (v - base + (1 + EPS))))


def alpha_iou(a: Box, b: Box, alpha: float = 2.0, kind: str = "iou", eps: float = 1e-9) -> Column:
    """The measures with each term raised to a power."""
    inter = intersection(a, b)
    w1, h1, w2, h2 = a.width, a.height + eps, b.width, b.height + eps
    union = w1 * h1 + w2 * h2 - inter + eps
    base = F.pow(inter / union + eps, alpha)
    if kind == "iou":
        return base
    if kind == "giou":
        c = F.greatest(cover(a, b).area + eps, union)
        return base - F.pow((c - union) / c + eps, alpha)
    away = F.pow(_centre_gap(a, b), alpha) / (F.pow(_diagonal(a, b), alpha) + eps)
    if kind == "diou":
        return base - away
    angle = F.atan(w2 / h2) - F.atan(w1 / h1)
    v = 4 / math.pi**2 * angle * angle
    return base - (away + F.pow(v * (v / ((1 + eps) - inter / union + v)) + eps, alpha))


def cosine_ciou(a: Box, b: Box) -> Column:
    """diou() less a shape term from the angle between the sizes, where the overlap is half or more."""
    dot = a.width * b.width + a.height * b.height
    cosine = F.try_divide(dot, F.sqrt(a.width * a.width + a.height * a.height) * F.sqrt(b.width * b.width + b.height * b.height))
    angle = 2 * F.acos(F.least(cosine, F.lit(1.0))) / math.pi
    v, base = angle * angle, iou(a, b)
    return diou(a, b) - F.when(base >= 0.5, F.coalesce(F.try_divide(v, 1 - base + v), F.lit(0.0))).otherwise(F.lit(0.0)) * v


def decoded_v7(tx: Column, ty: Column, tw: Column, th: Column, gx: Column, gy: Column, stride: Column, aw: Column, ah: Column) -> tuple[Column, Column, Column, Column]:
    """(cx, cy, w, h) of a cell's raw outputs that have passed a sigmoid."""
    return (2 * tx - 0.5 + gx) * stride, (2 * ty - 0.5 + gy) * stride, (2 * tw) * (2 * tw) * aw, (2 * th) * (2 * th) * ah


def decoded_v4(tx: Column, ty: Column, tw: Column, th: Column, gx: Column, gy: Column, aw: Column, ah: Column, width: Column, height: Column, scale: float = 1.0) -> Box:
    """Corners, as shares of the grid, of a cell's raw outputs; anchors are in cells."""
    shift = 0.5 * (scale - 1)
    cx, cy = (tx * scale - shift + gx) / width, (ty * scale - shift + gy) / height
    return from_centre(cx, cy, F.exp(tw) * aw / width, F.exp(th) * ah / height)
