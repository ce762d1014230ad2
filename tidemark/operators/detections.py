"""Detections: from raw outputs to suppressed, filtered and placed boxes (image_id, det_id, x1, y1, x2, y2, conf, cls)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS
from ..functions import boxes as bx
from ..functions.boxes import Box
from . import raster

D = DEFAULTS.detector


def best_class(scores: Column) -> tuple[Column, Column]:
    """(highest score, its first index) of an array."""
    most = F.array_max(scores)
    return most, (F.array_position(scores, most) - 1).cast("int")


def candidates(outputs: DataFrame, conf: float = D.conf, classes: list[int] | None = None, multi_label: bool = False) -> DataFrame:
    """Raw outputs (image_id, det_id, cx, cy, w, h, obj, scores) as boxes with a confidence above conf.

    Confidence is objectness times class score; with one class, objectness itself.  With multi_label, a box for each
    class above conf; else the best class, the first of equals.
    """
    one = F.size("scores") == 1
    rows = outputs.where(F.col("obj") > conf).withColumn("_s", F.when(one, F.array("obj")).otherwise(F.transform("scores", lambda s: s * F.col("obj"))))
    if multi_label:
        rows = rows.select("*", F.posexplode("_s").alias("cls", "conf"))
    else:
        most, cls = best_class(F.col("_s"))
        rows = rows.withColumns({"conf": most, "cls": cls})
    box = bx.from_centre(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"))
    rows = rows.where(F.col("conf") > conf)
    if classes is not None:
        rows = rows.where(F.col("cls").isin(classes))
    return rows.select("image_id", "det_id", *(v.alias(n) for n, v in zip(Box._fields, box, strict=True)), "conf", "cls")


def in_classes(detections: DataFrame, classes: int, most: int | None = None, order: str = "det_id") -> DataFrame:
    """Boxes of a class 0 <= cls < classes; with most, the first so many of each image, in the order of a column."""
    rows = detections.where((F.col("cls") >= 0) & (F.col("cls") < classes))
    if most is None:
        return rows
    place = F.row_number().over(Window.partitionBy("image_id").orderBy(order))
    return rows.withColumn("_k", place).where(F.col("_k") <= most).drop("_k")


def pooled(*parts: DataFrame) -> DataFrame:
    """Predictions (or labels) of several tiles, models or scales as one bag; `source` tells which part a row is from."""
    every = [p.withColumn("source", F.lit(k).cast("long")) for k, p in enumerate(parts)]
    out = every[0]
    for p in every[1:]:
        out = out.unionByName(p)
    return out


def reversed_order(detections: DataFrame, order: str = "det_id") -> DataFrame:
    """The boxes of each image from the last to the first."""
    return detections.orderBy("image_id", F.col(order).desc())


def beside(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Columns of two tables side by side, row by row of one key; a row that the other lacks has NULL."""
    return a.join(b, key, "full")


def top(detections: DataFrame, n: int, keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """The n most confident of each group, the smaller det_id of equals first; Spark cuts each task to n a group before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.col("conf").desc(), "det_id")
    return detections.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def _survivors(box: np.ndarray, group: np.ndarray, iou: float, smaller: bool) -> np.ndarray:
    """The places, in order, of the boxes (rows x1, y1, x2, y2, the most confident of a group first) that suppression keeps.

    All groups advance together: each round keeps the first box left of every group and drops what overlaps it.
    """
    area = (box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1])
    left, kept = np.argsort(group, kind="stable"), []
    while len(left):
        own = group[left]
        first = np.r_[True, own[1:] != own[:-1]]
        lead = left[first]
        kept.append(lead)
        by, left = lead[np.cumsum(first) - 1][~first], left[~first]
        sides = np.minimum(box[by, 2:], box[left, 2:]) - np.maximum(box[by, :2], box[left, :2])
        inter = np.prod(np.maximum(sides, 0.0), axis=1)
        with np.errstate(all="ignore"):
            over = inter / (np.minimum(area[by], area[left]) if smaller else area[by] + area[left] - inter)
        left = left[~(over > iou)]
    return np.sort(np.concatenate([*kept, np.zeros(0, np.int64)]))


def suppressed(detections: DataFrame, iou: float = D.iou, keys: tuple[str, ...] = ("image_id", "cls"), smaller: bool = False, most_in: int | None = D.most_in, most_out: int | None = D.most_out, out_keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """Greedy suppression: from the most confident down, a box goes if it overlaps a kept one of its group by more than iou.

    Equals rank by det_id.  most_in and most_out bound the boxes of an image as the detector does; None lifts a bound.
    One shuffle by out_keys, a part of keys; classes are told apart inside.
    """
    inner = [k for k in keys if k not in out_keys]
    if len(inner) + len(out_keys) != len(keys):
        raise ValueError("out_keys must be among keys")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["conf", "det_id"], ascending=[False, True], kind="stable")[:most_in]
        group = pdf.groupby(inner, sort=False, dropna=False).ngroup().to_numpy() if inner else np.zeros(len(pdf), np.int64)
        return pdf.iloc[_survivors(pdf[list(Box._fields)].to_numpy(float), group, iou, smaller)][:most_out]

    return detections.groupBy(*out_keys).applyInPandas(run, detections.schema)


def overlapping_pairs(detections: DataFrame, cell: float = 64.0, same_class: bool = False) -> DataFrame:
    """Pairs of boxes of an image that share some area, each once: columns of the smaller det_id with prefix a_, of the other with b_.

    Boxes meet in the grid cells that they cover; the cell of the intersection's corner decides, so no pair comes twice.
    """
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell)))
    rows = detections.withColumn("_cx", span("x1", "x2")).withColumn("_cy", span("y1", "y2"))
    keys = ["image_id", "_cx", "_cy", *(["cls"] if same_class else [])]
    side = lambda p: rows.select(*keys, *(F.col(c).alias(f"{p}{c}") for c in detections.columns if c not in keys))
    both = side("a_").join(side("b_"), keys).where("a_det_id < b_det_id")
    left, upper = F.greatest("a_x1", "b_x1"), F.greatest("a_y1", "b_y1")
    meets = (left < F.least("a_x2", "b_x2")) & (upper < F.least("a_y2", "b_y2"))
    return both.where(meets & (F.floor(left / cell) == F.col("_cx")) & (F.floor(upper / cell) == F.col("_cy"))).drop("_cx", "_cy")


def pair_boxes() -> tuple[Box, Box]:
    return Box.of("a_"), Box.of("b_")


def outdone(detections: DataFrame, iou: float = D.iou) -> DataFrame:
    """The boxes that overlap a more confident one of their image and class by more than iou: one step, not greedy suppression."""
    a, b = pair_boxes()
    pairs = overlapping_pairs(detections, same_class=True).where(bx.iou(a, b) > iou)
    weaker = F.when(F.col("a_conf") >= F.col("b_conf"), F.col("b_det_id")).otherwise(F.col("a_det_id"))
    lost = pairs.select("image_id", weaker.alias("det_id")).distinct()
    return detections.join(lost, ["image_id", "det_id"], "left_semi")


def class_counts(detections: DataFrame) -> DataFrame:
    """(cls, n): boxes of each class."""
    return detections.groupBy("cls").agg(F.count("*").alias("n"))


def clipped_to_image(detections: DataFrame, width: Column, height: Column) -> DataFrame:
    return detections.withColumns(dict(zip(Box._fields, bx.clipped(Box.of(), width, height), strict=True)))


def on_water(detections: DataFrame, mask: DataFrame) -> DataFrame:
    """Boxes of which all four corners are water in the mask (image_id, row, col, water); a corner without a mask pixel isn't."""
    at = lambda x, y: F.struct(F.floor(F.col(x)).cast("int").alias("col"), F.floor(F.col(y)).cast("int").alias("row"))
    corners = detections.select("image_id", "det_id", F.explode(F.array(at("x1", "y1"), at("x2", "y1"), at("x1", "y2"), at("x2", "y2"))).alias("c")).select("image_id", "det_id", "c.row", "c.col")
    wet = corners.join(mask, ["image_id", "row", "col"], "left").groupBy("image_id", "det_id").agg(F.min(F.coalesce("water", F.lit(0))).alias("w")).where("w = 1")
    return detections.join(wet, ["image_id", "det_id"], "left_semi")


def off_shore(detections: DataFrame, shore: DataFrame) -> DataFrame:
    """Boxes whose centre (x1 + int(w / 2), y1 + int(h / 2)) isn't a pixel of the shore mask (image_id, row, col)."""
    cx, cy = F.col("x1") + F.floor((F.col("x2") - F.col("x1")) / 2), F.col("y1") + F.floor((F.col("y2") - F.col("y1")) / 2)
    placed = detections.withColumns({"col": F.floor(cx).cast("int"), "row": F.floor(cy).cast("int")})
    return placed.join(shore.select("image_id", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col")).distinct(), ["image_id", "row", "col"], "left_anti").drop("row", "col")


def bright_boxes(boxes: DataFrame, pixels: DataFrame, share: float = 0.5, cell: int = 32, keep_zero: bool = False) -> DataFrame:
    """Training boxes (image_id, box_id, x, y, w, h) whose mean pixel (image_id, row, col, value) reaches the image's quantile.

    A box with x = 0 goes too unless keep_zero; one without pixels has no mean and stays.
    """
    span = lambda a, s: F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor((F.col(a) + F.col(s) - 1) / cell)))
    spread = boxes.where("w > 0 and h > 0").withColumn("cx", span("x", "w")).withColumn("cy", span("y", "h"))
    at = pixels.withColumn("cx", F.floor(F.col("col") / cell)).withColumn("cy", F.floor(F.col("row") / cell))
    held = spread.join(at, ["image_id", "cx", "cy"]).where("col >= x and col < x + w and row >= y and row < y + h")
    means = held.groupBy("image_id", "box_id").agg(F.avg("value").alias("mean"))
    level = raster.quantiles(pixels, "value", [share], keys=("image_id",)).withColumnRenamed("q0", "level")
    dark = means.join(level, "image_id").where("mean < level")
    rows = boxes if keep_zero else boxes.where("x > 0")
    return rows.join(dark, ["image_id", "box_id"], "left_anti")


def best_anchor(truth: DataFrame, anchors: list[tuple[float, float]]) -> DataFrame:
    """truth (box_id, w, h, ...) with the index of the anchor size that overlaps it most, the first of equals, and that overlap."""
    ious = F.array(*(bx.size_iou(F.col("w"), F.col("h"), F.lit(float(w)), F.lit(float(h))) for w, h in anchors))
    most, k = best_class(ious)
    return truth.withColumns({"anchor": k, "anchor_iou": most})


def predicted(tiles: DataFrame, model: Callable[[np.ndarray], np.ndarray], value: str = "pixels") -> DataFrame:
    """tiles (tile_id, h, w, pixels: array<double>) through a model that maps an array (n, h, w) to one value a pixel or tile.

    The model is sent to the workers; it sees batches of tiles of one shape.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (h, w), group in pdf.groupby(["h", "w"], sort=False):
                out = np.asarray(model(np.stack([np.asarray(v, float).reshape(h, w) for v in group[value]])))
                yield pd.DataFrame({"tile_id": group.tile_id.to_numpy(), "output": [np.ravel(o).astype(float) for o in out]})

    kind = dict(tiles.dtypes)["tile_id"]
    return tiles.select("tile_id", "h", "w", value).mapInPandas(run, f"tile_id {kind}, output array<double>")
