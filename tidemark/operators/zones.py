"""Points in polygons.

Zones: zone_ord, zone_no, rings (array of arrays of structs x, y; a ring may close itself or not; holes are further rings).
A zone's bounding box is put into the grid cells that it covers and meets points by cell; a candidate then meets the edges of its zone in the
horizontal band of the point, and crossings are counted by an aggregate.  No row carries rings, and no point walks all the edges of a long
coast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import NO_ZONE

#: Side of a grid cell in the units of the coordinates.
CELL = 50_000.0


def _edges(ring: Column) -> Column:
    """Array of structs (a, b): each point with the next, the last with the first."""
    return F.transform(ring, lambda p, i: F.struct(p.alias("a"), F.when(i + 1 < F.size(ring), F.get(ring, i + 1)).otherwise(F.get(ring, F.lit(0))).alias("b")))


def edges_of(zones: DataFrame, band: float) -> DataFrame:
    """(zone_ord, band, ax, ay, bx, b_y): the edges of each zone in each horizontal band that they touch."""
    edge = zones.select("zone_ord", F.explode(F.flatten(F.transform("rings", _edges))).alias("e")).select("zone_ord", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("b_y"))
    return edge.select("zone_ord", F.explode(F.sequence(F.floor(F.least("ay", "b_y") / band), F.floor(F.greatest("ay", "b_y") / band))).alias("band"), "ax", "ay", "bx", "b_y")


def zone_of(points: DataFrame, zones: DataFrame, cell: float = CELL, bands: int = 16) -> DataFrame:
    """points (id, x, y, ...) with `zone`: the number of the first zone (by zone_ord) that holds the point; -1 if none, or if that number is 0 or null.

    Edges meet points in bands, `bands` to a cell.  Rows that share an id count as one point.
    """
    flat = F.flatten("rings")
    span = lambda c: (F.floor(F.array_min(flat[c]) / cell), F.floor(F.array_max(flat[c]) / cell))
    (x0, x1), (y0, y1) = span("x"), span("y")
    placed = zones.where(F.size(flat) > 0).select("zone_ord", "zone_no", F.explode(F.sequence(x0, x1)).alias("cx"), y0.alias("y0"), y1.alias("y1"))
    placed = placed.select("zone_ord", "zone_no", "cx", F.explode(F.sequence("y0", "y1")).alias("cy"))
    band = cell / bands
    at = points.select("id", "x", "y", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"), F.floor(F.col("y") / band).alias("band"))
    met = at.join(placed, ["cx", "cy"]).join(edges_of(zones, band), ["zone_ord", "band"])
    x, y, ax, ay, bx, b_y = (F.col(c) for c in ("x", "y", "ax", "ay", "bx", "b_y"))
    crosses = ((ay > y) != (b_y > y)) & (x < (bx - ax) * (y - ay) / (b_y - ay) + ax)
    touches = ((bx - ax) * (y - ay) - (b_y - ay) * (x - ax) == 0) & x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, b_y), F.greatest(ay, b_y))
    held = met.groupBy("id", "x", "y", "zone_ord", "zone_no").agg(F.count_if(crosses).alias("n"), F.count_if(touches).alias("on")).where("n % 2 = 1 and on = 0")
    first = held.groupBy("id").agg(F.min(F.struct("zone_ord", "zone_no")).alias("z")).select("id", F.col("z.zone_no").cast("double").alias("zone"))
    none = F.lit(NO_ZONE)
    return points.join(first, "id", "left").withColumn("zone", F.coalesce(F.when(F.col("zone") != 0, F.col("zone")), none))
