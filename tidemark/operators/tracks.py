"""Ship tracks: position reports brought to the time a radar scene saw them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..config import Platform
from ..functions import geo, strings
from ..shared import written


def in_scene(pings: DataFrame, scenes: DataFrame, margin_s: float = config.TIME_MARGIN_S, bucket_s: int = 3600, zero_is_missing: bool = True) -> DataFrame:
    """Reports with the scene they fall into: on or inside its bounds, and within margin_s of its time span.

    pings: lon, lat, epoch (seconds) and more; scenes: scene_id, min_lon, max_lon, min_lat, max_lat, start_s, end_s and more.
    Scenes and reports meet by time bucket.  With zero_is_missing, a report on the equator or the zero meridian is dropped.
    """
    first, last = F.floor((F.col("start_s") - margin_s) / bucket_s), F.floor((F.col("end_s") + margin_s) / bucket_s)
    spread = scenes.withColumn("_bucket", F.explode(F.sequence(first, last)))
    rows = pings.withColumn("_bucket", F.floor(F.col("epoch") / bucket_s)).join(spread, "_bucket")
    kept = F.col("lat").between(F.col("min_lat"), F.col("max_lat")) & F.col("lon").between(F.col("min_lon"), F.col("max_lon")) & F.col("epoch").between(F.col("start_s") - margin_s, F.col("end_s") + margin_s)
    if zero_is_missing:
        kept = kept & (F.col("lat") * F.col("lon") != 0)
    return rows.where(kept).drop("_bucket")


def middle_index(n: Column) -> Column:
    """0 for one report, else half their number rounded half to even."""
    return F.when(n < 2, F.lit(0.0)).otherwise(F.bround(n / 2, 0))


def middle_row(rows: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The middle row of each group, in the order given."""
    w = Window.partitionBy(*keys)
    numbered = rows.withColumn("_k", F.row_number().over(w.orderBy(order)) - 1).withColumn("_n", F.count("*").over(w))
    return numbered.where(F.col("_k") == middle_index(F.col("_n"))).drop("_k", "_n")


def first_row(rows: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The first row of each group: an aggregate, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, "_r.*")


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """rows with `place`, counted from 1 in the order of a column: sorted ranges are numbered one by one and moved on by the rows of those before."""
    ranged = written(rows.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a range
    own = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return ranged.join(sizes.select("_range", before.alias("_before")), "_range").withColumn("place", own + F.col("_before")).drop("_range", "_before")


def scene_seconds(y: Column, scene: str = "") -> Column:
    """The time at which the scene's line int(y) was seen; NULL for lines it doesn't have."""
    c = lambda n: F.col(f"{scene}{n}")
    line = y.cast("long")
    first = F.when(c("ascending"), c("end_s")).otherwise(c("start_s"))
    last = F.when(c("ascending"), c("start_s")).otherwise(c("end_s"))
    return F.when((line >= 0) & (line < c("ysize")), geo.on_line(first, last, line, c("ysize")))


def synchronised(pings: DataFrame, scenes: DataFrame, margin_s: float = config.TIME_MARGIN_S, shifted_lookup: bool = False) -> DataFrame:
    """One row for each scene and ship: its middle report moved to the time the scene saw that place.

    Result: scene_id, mmsi, date, time, sar_s, lon, lat, cog, sog (m/s), dim_a..dim_d (from the ship's first report of all), and
    name, kind, destination (from its first report in the scene).  Ships whose place lies outside the scene's lines, and
    number 0, are dropped.  With shifted_lookup, names come as the original order of positions gives them: the k-th report of all,
    k being the place of the ship's first report among those in the scene.
    """
    inside = in_scene(pings, scenes, margin_s).withColumn("sog", F.col("sog") * config.KNOT)
    y, _ = geo.pixel_of(F.col("lat"), F.col("lon"))
    mid = middle_row(inside, ["scene_id", "mmsi"]).withColumn("sar_s", scene_seconds(y)).where("sar_s is not null")
    lat, lon = geo.dead_reckoned(F.col("lat"), F.col("lon"), F.col("sog"), F.col("cog"), F.col("sar_s") - F.col("epoch"))
    date, time = strings.date_and_time(F.col("sar_s"))
    moved = mid.select("scene_id", "mmsi", date.alias("date"), time.alias("time"), "sar_s", lon.alias("lon"), lat.alias("lat"), "cog", "sog")
    dims = first_row(pings.select("mmsi", "seq", "dim_a", "dim_b", "dim_c", "dim_d"), ["mmsi"]).drop("seq")
    if shifted_lookup:
        place = Window.partitionBy("scene_id").orderBy("seq")
        firsts = first_row(inside.select("scene_id", "mmsi", "seq").withColumn("_place", F.row_number().over(place)), ["scene_id", "mmsi"])
        every = numbered(pings.select("seq", "name", "kind", "destination"), "seq").drop("seq").withColumnRenamed("place", "_place")
        said = firsts.select("scene_id", "mmsi", "_place").join(every, "_place").drop("_place")
    else:
        said = first_row(inside.select("scene_id", "mmsi", "seq", "name", "kind", "destination"), ["scene_id", "mmsi"]).drop("seq")
    return moved.where("mmsi != 0").join(dims, "mmsi").join(said, ["scene_id", "mmsi"])


def azimuth_shifted(ships: DataFrame, scenes: DataFrame, platform: Platform = config.DEFAULTS.platform, right_looking: bool = True) -> DataFrame:
    """Ships (scene_id, lon, lat, sog in m/s, cog) moved along the flight path as the radar sees moving targets.

    Range and incidence angle run evenly across the scene's columns, backwards in a descending pass.  A ship
    outside the columns has no range: its position becomes NULL.
    """
    rows = ships.join(scenes, "scene_id")
    up = F.col("ascending")
    heading = F.when(up, F.lit(platform.heading_ascending)).otherwise(F.lit(platform.heading_descending))
    _, x = geo.pixel_of(F.col("lat"), F.col("lon"))
    k = x.cast("long")

    def across(pair: tuple[int, int]) -> Column:
        a, b = (F.lit(float(v)) for v in pair)
        return geo.on_line(F.when(up, a).otherwise(b), F.when(up, b).otherwise(a), k, F.col("xsize"))

    known = (k >= 0) & (k < F.col("xsize"))
    away = F.col("sog") * F.sin(F.radians(F.col("cog") - heading))
    shift = away * (across(platform.slant_m) * F.cos(F.radians(across(platform.incidence_deg)))) / platform.speed_m_s
    sign = 1 if right_looking else -1
    lat = F.when(known, F.col("lat") + sign * (shift * F.cos(F.radians(heading)) / config.METRES_A_DEGREE))
    lon = F.when(known, F.col("lon") + sign * (shift * F.sin(F.radians(heading)) / config.METRES_A_DEGREE))
    return rows.withColumns({"lat": lat, "lon": lon}).select(*ships.columns)
