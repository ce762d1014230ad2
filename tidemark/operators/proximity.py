"""Joins by distance on the sphere, by way of an equi-join on grid cells.

Latitude is cut into bands as wide as the distance; each band is cut into a whole number of cells, each at least as long as the distance
anywhere in the band or its neighbours, so that cells wrap around at the antimeridian and grow towards the poles.
The points of one side stay in their cell; those of the other are put into the cells around theirs (nine at most).  The exact
distance decides.  No side is broadcast by hint; Spark may do so when it has measured a side to be small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.geo import haversine_m


def _band(lat: Column, step: float) -> Column:
    return F.floor((lat + 90) / step).cast("long")


def _cells(band: Column, step: float) -> Column:
    """How many cells a band has."""
    most = F.least(F.lit(90.0), F.greatest(F.abs((band - 1) * step - 90), F.abs((band + 2) * step - 90)))
    return F.greatest(F.lit(1).cast("long"), F.floor(360 * F.cos(F.radians(most)) / (step * 1.02)).cast("long"))


def _cell(lon: Column, cells: Column) -> Column:
    return F.pmod(F.floor((lon + 180) / 360 * cells), cells).cast("long")


def _pairs(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """(left_id, right_id, metres) for all pairs strictly nearer than `metres`; both sides have id, lon, lat."""
    step = max(math.degrees(metres / config.METRES_A_RADIAN) * 1.01, 1e-7)
    a = left.select(F.col("id").alias("left_id"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1")).where("lon1 is not null and lat1 is not null")
    a = a.withColumn("band", _band(F.col("lat1"), step))
    a = a.withColumn("cell", _cell(F.col("lon1"), _cells(F.col("band"), step)))
    b = right.select(F.col("id").alias("right_id"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2")).where("lon2 is not null and lat2 is not null")
    own = _band(F.col("lat2"), step)
    b = b.withColumn("band", F.explode(F.array(own - 1, own, own + 1)))
    cells = _cells(F.col("band"), step)
    at = _cell(F.col("lon2"), cells)
    b = b.withColumn("cell", F.explode(F.array_distinct(F.array(F.pmod(at - 1, cells), at, F.pmod(at + 1, cells)))))
    distance = haversine_m(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return a.join(b, ["band", "cell"]).select("left_id", "right_id", distance.alias("metres")).where(F.col("metres") < metres)


def pairs_within(left: DataFrame, right: DataFrame, metres: float = config.PROXIMITY_M) -> DataFrame:
    """All pairs (left_id, right_id, metres) nearer than `metres` (strictly).  Both sides: id, lon, lat; a null position is near nothing."""
    return _pairs(left, right, metres)


def near(left: DataFrame, right: DataFrame, metres: float = config.PROXIMITY_M) -> DataFrame:
    """The rows of left with a row of right nearer than `metres`."""
    found = _pairs(left, right, metres).select(F.col("left_id").alias("id")).distinct()
    return left.join(found, "id", "left_semi")


def not_near(left: DataFrame, right: DataFrame, metres: float = config.PROXIMITY_M) -> DataFrame:
    """The rows of left without a row of right nearer than `metres`; all of them if right is empty."""
    found = _pairs(left, right, metres).select(F.col("left_id").alias("id")).distinct()
    return left.join(found, "id", "left_anti")


def nearest(left: DataFrame, right: DataFrame, metres: float = config.PROXIMITY_M) -> DataFrame:
    """(left_id, right_id, metres): the nearest row of right within `metres`, the smallest id of equals."""
    best = F.min(F.struct("metres", "right_id"))
    return _pairs(left, right, metres).groupBy("left_id").agg(best.alias("b")).select("left_id", "b.right_id", "b.metres")


def not_near_by_nested_loop(left: DataFrame, right: DataFrame, metres: float = config.PROXIMITY_M) -> DataFrame:
    """not_near() as one theta join; for tests and tables of a few thousand rows."""
    distance = haversine_m(F.col("l.lat"), F.col("l.lon"), F.col("r.lat"), F.col("r.lon"))
    return left.alias("l").join(right.alias("r"), distance < metres, "left_anti")
