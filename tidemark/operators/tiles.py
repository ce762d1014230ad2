"""Tilings of scenes, and pixels and boxes dealt to tiles by arithmetic instead of range joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS

D = DEFAULTS.detector


def overlapping_starts(length: Column, size: int = D.tile, overlap: int = D.overlap, cover_edges: bool = False) -> Column:
    """Sorted starts of tiles `size` long that overlap: multiples of the stride, of which the last moves back so that its tile ends with the axis.

    The largest start is left out unless cover_edges, as the detector has it.
    """
    stride = size - overlap
    grid = F.sequence(F.lit(0), F.greatest(length - 1, F.lit(0)), F.lit(stride))
    moved = F.array_sort(F.concat(F.slice(grid, F.lit(1), F.size(grid) - 1), F.array((length - size).cast("int"))))
    return moved if cover_edges else F.slice(moved, F.lit(1), F.size(moved) - 1)


def divided_bounds(length: Column, div: int = D.div) -> Column:
    """Ends of the stretches of an axis cut by int(length / div): 0, step, ..., of which the last one becomes the axis' end."""
    step = F.floor(length / div).cast("int")
    grid = F.sequence(F.lit(0), length - 1, step)
    return F.concat(F.slice(grid, F.lit(1), F.size(grid) - 1), F.array(length.cast("int")))


def padded_count(length: Column, size: int) -> Column:
    """Tiles without overlap that cover an axis, the last one padded."""
    return F.ceil(length / size).cast("int")


def overlapping_tiles(scenes: DataFrame, size: int = D.tile, overlap: int = D.overlap, cover_edges: bool = False) -> DataFrame:
    """(scene_id, x1, y1, x2, y2) of scenes (scene_id, height, width)."""
    rows = scenes.select("scene_id", F.explode(overlapping_starts(F.col("height"), size, overlap, cover_edges)).alias("y1"), "width")
    rows = rows.select("scene_id", "y1", F.explode(overlapping_starts(F.col("width"), size, overlap, cover_edges)).alias("x1"))
    return rows.select("scene_id", "x1", "y1", (F.col("x1") + size).alias("x2"), (F.col("y1") + size).alias("y2"))


def divided_tiles(scenes: DataFrame, div: int = D.div) -> DataFrame:
    """(scene_id, x1, y1, x2, y2): div by div tiles without overlap, the last ones larger."""

    def stretches(bounds: Column) -> Column:
        return F.transform(F.slice(bounds, F.lit(1), F.size(bounds) - 1), lambda b, i: F.struct(b.alias("a"), F.get(bounds, i + 1).alias("b")))

    rows = scenes.select("scene_id", F.explode(stretches(divided_bounds(F.col("height"), div))).alias("y"), "width")
    rows = rows.select("scene_id", "y", F.explode(stretches(divided_bounds(F.col("width"), div))).alias("x"))
    return rows.select("scene_id", F.col("x.a").alias("x1"), F.col("y.a").alias("y1"), F.col("x.b").alias("x2"), F.col("y.b").alias("y2"))


def padded_tiles(scenes: DataFrame, size: int) -> DataFrame:
    """(scene_id, x1, y1, x2, y2): tiles without overlap; those at the far edges reach beyond the scene."""
    at = lambda c: F.explode(F.transform(F.sequence(F.lit(0), padded_count(F.col(c), size) - 1), lambda i: i * size))
    rows = scenes.select("scene_id", at("height").alias("y1"), "width").select("scene_id", "y1", at("width").alias("x1"))
    return rows.select("scene_id", "x1", "y1", (F.col("x1") + size).alias("x2"), (F.col("y1") + size).alias("y2"))


def tile_starts_of(position: Column, size: int, stride: int) -> Column:
    """The starts, multiples of the stride, of all tiles `size` long that hold a position."""
    first = F.greatest(F.lit(0), F.ceil((position - size + 1) / stride)).cast("int")
    return F.transform(F.sequence(first, F.floor(position / stride).cast("int")), lambda k: k * stride)


def dealt_pixels(pixels: DataFrame, size: int, stride: int | None = None) -> DataFrame:
    """Pixels (scene_id, row, col, ...) with x1, y1 of each tile that holds them; with a stride under size, once for each of up to four or more tiles."""
    stride = stride or size
    rows = pixels.withColumn("y1", F.explode(tile_starts_of(F.col("row"), size, stride)))
    return rows.withColumn("x1", F.explode(tile_starts_of(F.col("col"), size, stride)))


def filled_tiles(pixels: DataFrame, value: str, size: int, stride: int | None = None) -> DataFrame:
    """(scene_id, x1, y1, n, mean) of the tiles of which the mean isn't zero."""
    return dealt_pixels(pixels, size, stride).groupBy("scene_id", "x1", "y1").agg(F.count(value).alias("n"), F.avg(value).alias("mean")).where("mean != 0")


def boxes_in_tiles(boxes: DataFrame, tiles: DataFrame, cell: int = 256) -> DataFrame:
    """Boxes (scene_id, box_id, x, y) with x1, y1 of every tile whose closed range holds their corner; edges count on both sides."""
    spread = tiles.select("scene_id", F.col("x1").alias("tx1"), F.col("y1").alias("ty1"), F.col("x2").alias("tx2"), F.col("y2").alias("ty2"))
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell)))
    spread = spread.withColumn("cx", span("tx1", "tx2")).withColumn("cy", span("ty1", "ty2"))
    rows = boxes.withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell)).join(spread, ["scene_id", "cx", "cy"])
    held = F.col("x").between(F.col("tx1"), F.col("tx2")) & F.col("y").between(F.col("ty1"), F.col("ty2"))
    return rows.where(held).drop("cx", "cy", "tx2", "ty2").withColumnsRenamed({"tx1": "x1", "ty1": "y1"})
