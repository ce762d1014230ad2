"""Whole pipelines over the engine's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import boxes as bx
from ..functions import geo, statistics
from ..functions import radiometry as rad
from ..functions.boxes import Box
from ..operators import detections as det
from ..operators import proximity, raster, tracks
from ..operators import zones as zone_ops
from ..shared import written


def centres(boxes: DataFrame) -> DataFrame:
    """Boxes (id, LatMin, LonMin, LatMax, LonMax) as id, lon, lat, length_m (along the longitudes), width_m (along the latitudes), corners in any order."""
    return boxes.select(
        "id", (0.5 * (F.col("LonMin") + F.col("LonMax"))).alias("lon"), (0.5 * (F.col("LatMin") + F.col("LatMax"))).alias("lat"),
        geo.metres_of_degrees(F.abs(F.col("LonMin") - F.col("LonMax"))).alias("length_m"), geo.metres_of_degrees(F.abs(F.col("LatMin") - F.col("LatMax"))).alias("width_m"),
    )


def removal_points(known: DataFrame, ships: DataFrame, reports: DataFrame) -> DataFrame:
    """Known facilities, ships and reports as one bag of points: source, id in the source, lon, lat; id orders them by source, then key."""
    part = lambda df, source, key, lon, lat: df.select(F.lit(source).alias("source"), F.col(key).cast("long").alias("key"), F.col(lon).alias("lon"), F.col(lat).alias("lat"))
    every = part(known, 0, "id", "lon", "lat").unionByName(part(ships, 1, "id", "Lon", "Lat")).unionByName(part(reports, 2, "seq", "lon", "lat"))
    return every.withColumn("id", F.col("source") * F.lit(1 << 48) + F.col("key"))


def mercator_zones(zones: DataFrame) -> DataFrame:
    """Zones in degrees as zones in metres."""
    point = lambda p: F.struct(*(v.alias(n) for v, n in zip(geo.web_mercator(p["x"], p["y"]), "xy", strict=True)))
    return zones.withColumn("rings", F.transform("rings", lambda ring: F.transform(ring, point)))


def unexplained_facilities(facilities: DataFrame, known: DataFrame, ships: DataFrame, reports: DataFrame, zones: DataFrame, metres: float = config.PROXIMITY_M, date: str | None = None) -> DataFrame:
    """Facilities that no known object explains, with extent and marine zone: id, lon, lat, length_m, width_m, date, region.

    zones: in metres.  One equi-join on grid cells, one anti-join on ids, one equi-join on zone cells.
    """
    left = proximity.not_near(centres(facilities), removal_points(centres(known), ships, reports), metres)
    x, y = geo.web_mercator(F.col("lon"), F.col("lat"))
    placed = zone_ops.zone_of(left.withColumns({"x": x, "y": y}), zones)
    return placed.select("id", "lon", "lat", "length_m", "width_m", F.lit(date).alias("date"), F.col("zone").alias("region"))


def ships_seen(reports: DataFrame, scenes: DataFrame, platform: config.Platform = config.DEFAULTS.platform) -> DataFrame:
    """Reports at the time a scene saw them, shifted along the flight path."""
    return tracks.azimuth_shifted(tracks.synchronised(reports, scenes), scenes, platform)


def sea_temperature(pixels: DataFrame, metadata: DataFrame, value: str = "b1", nodata: float | None = None) -> DataFrame:
    """(roi_id, timestamp, sst_mean): the mean known pixel of each scene, with its metadata (scene_id, roi_id, timestamp) or 'Unknown'."""
    said = lambda c: F.coalesce(F.col(c), F.lit("Unknown")).alias(c)
    return raster.scene_mean(pixels, value, nodata, single=True).join(metadata, "scene_id", "left").select(said("roi_id"), said("timestamp"), F.col("mean").alias("sst_mean"))


def change_mask(pixels: DataFrame, change: config.Change = config.DEFAULTS.change, tile: int = 512) -> DataFrame:
    """(scene_id, row, col, statistic, p, flag, written_mask) of a two-band pair (vh, vv, vh2, vv2).

    flag: p under the threshold that the mean band ratio gives; written_mask is 0 on flagged blobs of the least size and 1
    elsewhere, as the product has it.  A missing pixel has no statistic and no flag.
    """
    freedom = F.col("mean") * change.looks**2
    threshold = raster.ratio_mean(pixels, "vv", "vv2").select("scene_id", (statistics.f_quantiles(change.quantile, freedom * 20, freedom * 4) / change.quantile_div).alias("threshold"))
    value = rad.log_ratio((F.col("vh"), F.col("vv")), (F.col("vh2"), F.col("vv2")))
    scored = pixels.select("scene_id", "row", "col", value.alias("statistic"))
    scored = scored.withColumn("p", statistics.chi2_cdf(F.col("statistic"), change.df)).join(threshold, "scene_id", "left")
    scored = written(scored.withColumn("flag", F.coalesce(F.col("p") < F.col("threshold"), F.lit(False))).drop("threshold"), "scored")  # read twice
    blobs = raster.large_blobs(scored.where("flag"), change.least_blob, tile).withColumn("_large", F.lit(0))
    return scored.join(blobs, ["scene_id", "row", "col"], "left").withColumn("written_mask", F.coalesce("_large", F.lit(1))).drop("_large")


def facilities_of(outputs: DataFrame, scenes: DataFrame, classes: dict[int, str], water: DataFrame | None = None, detector: config.Detector = config.DEFAULTS.detector, swapped_lon: bool = False) -> DataFrame:
    """Raw detector outputs of tiles (image_id, tile_id, x0, y0, det_id, cx, ...) as facility boxes (image_id, LatMin, LonMin, LatMax, LonMax, Class).

    Suppression is by tile and class.  With swapped_lon, LonMin repeats LatMin as the product has it.
    """
    keyed = outputs.withColumn("image_id", F.struct("image_id", "tile_id"))
    kept = det.suppressed(det.candidates(keyed, detector.conf), detector.iou, most_in=detector.most_in, most_out=detector.most_out)
    where = outputs.select(F.struct("image_id", "tile_id").alias("image_id"), "det_id", "x0", "y0")
    placed = kept.join(where, ["image_id", "det_id"]).select(F.col("image_id.image_id").alias("image_id"), "det_id", *((F.col(c) + F.col(f"{c[0]}0")).alias(c) for c in Box._fields), "conf", "cls")
    if water is not None:
        placed = det.on_water(placed, water)
    rows = placed.join(scenes.select(F.col("scene_id").alias("image_id"), "min_lon", "dlon", "max_lat", "dlat"), "image_id")
    lon = lambda c: F.col("min_lon") + F.col("dlon") * F.col(c)
    lat = lambda c: F.col("max_lat") + F.col("dlat") * F.col(c)
    name: Column = F.create_map(*(F.lit(v) for pair in classes.items() for v in pair))[F.col("cls")]
    low = F.least(lat("y1"), lat("y2"))
    return rows.select("image_id", low.alias("LatMin"), (low if swapped_lon else lon("x1")).alias("LonMin"), F.greatest(lat("y1"), lat("y2")).alias("LatMax"), lon("x2").alias("LonMax"), name.alias("Class"))


def ships_of(boxes: DataFrame, scenes: DataFrame) -> DataFrame:
    """Detected ships (image, X, Y, W, H, Lon, Lat): corner, size and the centre's position of boxes in scene pixels."""
    rows = boxes.join(scenes.select(F.col("scene_id").alias("image_id"), "min_lon", "dlon", "max_lat", "dlat"), "image_id")
    b = Box.of()
    cx, cy, w, h = bx.to_centre(b)
    lon, lat = geo.position_of(cx, cy, (F.col("min_lon"), F.col("dlon"), F.lit(0.0), F.col("max_lat"), F.lit(0.0), F.col("dlat")))
    return rows.select(F.col("image_id").alias("image"), b.x1.alias("X"), b.y1.alias("Y"), w.alias("W"), h.alias("H"), lon.alias("Lon"), lat.alias("Lat"))
