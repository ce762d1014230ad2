"""Every operator as a query over the driver's tables, with SQL that must give the same rows.

Computed doubles are rounded on both sides; whole numbers are BIGINT on both sides.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import boxes as bx
from ..functions import geo, kernels, statistics, strings
from ..functions import radiometry as rad
from ..operators import alignment, lookup, products, proximity, raster, tiles, tracks
from ..operators import detections as det
from ..operators import zones as zone_ops
from ..sources import geotiff, tables
from . import adapters as a
from . import pipelines as pipe
from .adapters import with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
NEAR_M = 500.0


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def r(c: Column, digits: int = 4) -> Column:
    """Rounded, without negative zero."""
    return F.round(c, digits) + F.lit(0.0)


def n(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def _distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    s = f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    return f"(1000 * 6371.0::DOUBLE * 2 * atan2(sqrt({s}), sqrt(1 - {s})))"


_CENTRES = """-- more
f AS (SELECT id, 0.5 * (LonMin + LonMax) AS lon, 0.5 * (LatMin + LatMax) AS lat FROM facilities),
k AS (SELECT id, 0.5 * (LonMin + LonMax) AS lon, 0.5 * (LatMin + LatMax) AS lat FROM confirmed)
"""
_REMOVAL = "SELECT 0 AS source, id AS key, lon, lat FROM k UNION ALL SELECT 1, id, Lon, Lat FROM ships UNION ALL SELECT 2, seq, lon, lat FROM pings"


# ---- positions


@query(with_tables("facilities confirmed", _CENTRES + f"SELECT f.id, k.id AS other, round({_distance('f.lat', 'f.lon', 'k.lat', 'k.lon')}, 3) AS metres FROM f JOIN k ON k.id = f.id % 50"))
def haversine(spark, d):
    f, k = pipe.centres(a.facilities(spark, d)), pipe.centres(a.confirmed(spark, d))
    rows = f.alias("f").join(k.alias("k"), F.col("k.id") == F.col("f.id") % 50)
    return rows.select("f.id", F.col("k.id").alias("other"), r(geo.haversine_m(F.col("f.lat"), F.col("f.lon"), F.col("k.lat"), F.col("k.lon")), 3).alias("metres"))


@query(with_tables("ships", "SELECT id, round(6378137.0::DOUBLE * radians(Lon), 3) AS x, round(6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(Lat) / 2)), 3) AS y FROM ships"))
def web_mercator(spark, d):
    x, y = geo.web_mercator(F.col("Lon"), F.col("Lat"))
    return a.ships(spark, d).select("id", r(x, 3).alias("x"), r(y, 3).alias("y"))


@query(with_tables("ships scene", """SELECT id, round(1 + (max_lat - Lat) / (max_lat - min_lat) * (round_even(((max_lat - dlat) - min_lat) / (-dlat), 0) - 1), 4) AS y,
  round(1 + (Lon - min_lon) / (max_lon - min_lon) * (round_even(((max_lon + dlon) - min_lon) / dlon, 0) - 1), 4) AS x FROM ships, scene"""))
def geo_to_pixel(spark, d):
    y, x = geo.pixel_of(F.col("Lat"), F.col("Lon"))
    return a.ships(spark, d).crossJoin(F.broadcast(a.scene(spark))).select("id", r(y).alias("y"), r(x).alias("x"))


@query(with_tables("ships scene", "SELECT id, round(min_lon + dlon * (X + W / 2.0::DOUBLE), 6) AS lon, round(max_lat + dlat * (Y + H / 2.0::DOUBLE), 6) AS lat FROM ships, scene"))
def pixel_to_geo(spark, d):
    lon, lat = geo.position_of(F.col("X") + F.col("W") / 2, F.col("Y") + F.col("H") / 2, (F.col("min_lon"), F.col("dlon"), F.lit(0.0), F.col("max_lat"), F.lit(0.0), F.col("dlat")))
    return a.ships(spark, d).crossJoin(F.broadcast(a.scene(spark))).select("id", r(lon, 6).alias("lon"), r(lat, 6).alias("lat"))


@query(with_tables("facilities", """SELECT id, round(0.5 * (LonMin + LonMax), 6) AS lon, round(0.5 * (LatMin + LatMax), 6) AS lat,
  round(radians(abs(LonMin - LonMax)) * 6371000.0::DOUBLE * cos(radians(35.0::DOUBLE)), 3) AS length_m, round(radians(abs(LatMin - LatMax)) * 6371000.0::DOUBLE * cos(radians(35.0::DOUBLE)), 3) AS width_m FROM facilities"""))
def box_midpoint_extent(spark, d):
    return pipe.centres(a.facilities(spark, d)).select("id", r(F.col("lon"), 6).alias("lon"), r(F.col("lat"), 6).alias("lat"), r(F.col("length_m"), 3).alias("length_m"), r(F.col("width_m"), 3).alias("width_m"))


# ---- proximity and zones


@query(with_tables("facilities confirmed", _CENTRES + f"SELECT f.id FROM f WHERE NOT EXISTS (SELECT 1 FROM k WHERE {_distance('f.lat', 'f.lon', 'k.lat', 'k.lon')} < {NEAR_M})"))
def proximity_anti(spark, d):
    return proximity.not_near(pipe.centres(a.facilities(spark, d)), pipe.centres(a.confirmed(spark, d)), NEAR_M).select("id")


@query(with_tables("facilities confirmed", _CENTRES + f"SELECT f.id FROM f WHERE EXISTS (SELECT 1 FROM k WHERE {_distance('f.lat', 'f.lon', 'k.lat', 'k.lon')} < {NEAR_M})"))
def proximity_semi(spark, d):
    return proximity.near(pipe.centres(a.facilities(spark, d)), pipe.centres(a.confirmed(spark, d)), NEAR_M).select("id")


@query(with_tables("facilities confirmed", _CENTRES + f"""SELECT left_id, right_id, round(m, 3) AS metres FROM (SELECT f.id AS left_id, k.id AS right_id, {_distance('f.lat', 'f.lon', 'k.lat', 'k.lon')} AS m FROM f, k) WHERE m < {NEAR_M}"""))
def proximity_pairs(spark, d):
    pairs = proximity.pairs_within(pipe.centres(a.facilities(spark, d)), pipe.centres(a.confirmed(spark, d)), NEAR_M)
    return pairs.select("left_id", "right_id", r(F.col("metres"), 3).alias("metres"))


@query(with_tables("facilities confirmed", _CENTRES + f"""SELECT left_id, arg_min(right_id, m) AS right_id, round(min(m), 3) AS metres FROM (SELECT f.id AS left_id, k.id AS right_id, {_distance('f.lat', 'f.lon', 'k.lat', 'k.lon')} AS m FROM f, k) WHERE m < {NEAR_M} GROUP BY 1"""))
def nearest_within(spark, d):
    near = proximity.nearest(pipe.centres(a.facilities(spark, d)), pipe.centres(a.confirmed(spark, d)), NEAR_M)
    return near.select("left_id", "right_id", r(F.col("metres"), 3).alias("metres"))


@query(with_tables("facilities confirmed ships pings", _CENTRES + f", u AS ({_REMOVAL}) SELECT source::BIGINT AS source, count(*)::BIGINT AS n, round(min(lon), 6) AS west, round(max(lat), 6) AS north FROM u GROUP BY 1"))
def union_removal(spark, d):
    points = pipe.removal_points(pipe.centres(a.confirmed(spark, d)), a.ships(spark, d), a.pings(spark, d))
    return points.groupBy(n("source").alias("source")).agg(F.count("*").alias("n"), r(F.min("lon"), 6).alias("west"), r(F.max("lat"), 6).alias("north"))


_MX, _MY = "6378137.0::DOUBLE * radians({x})", "6378137.0::DOUBLE * ln(tan(pi() / 4 + radians({y}) / 2))"
_ZONED = f"""m AS (SELECT zone, {_MX.format(x='ax')} AS ax, {_MY.format(y='ay')} AS ay, {_MX.format(x='bx')} AS bx, {_MY.format(y='b_y')} AS b_y FROM edges),
p AS (SELECT *, {_MX.format(x='lon')} AS x, {_MY.format(y='lat')} AS y FROM {{points}}),
held AS (SELECT p.id, m.zone FROM p JOIN m ON (m.ay > p.y) <> (m.b_y > p.y) AND p.x < (m.bx - m.ax) * (p.y - m.ay) / (m.b_y - m.ay) + m.ax GROUP BY 1, 2 HAVING count(*) % 2 = 1),
z AS (SELECT id, min(zone) AS zone FROM held GROUP BY 1)"""


@query(with_tables("facilities confirmed edges", _CENTRES + ", " + _ZONED.format(points="f") + " SELECT p.id, coalesce(nullif(z.zone, 0), -1)::DOUBLE AS zone FROM p LEFT JOIN z ON z.id = p.id"))
def zone_assign(spark, d):
    points = pipe.centres(a.facilities(spark, d))
    x, y = geo.web_mercator(F.col("lon"), F.col("lat"))
    return zone_ops.zone_of(points.withColumns({"x": x, "y": y}), pipe.mercator_zones(a.zones(spark, d))).select("id", "zone")


@query(with_tables("facilities confirmed ships pings edges", _CENTRES + f""", u AS ({_REMOVAL}),
left_ AS (SELECT facilities.*, f.lon, f.lat FROM f JOIN facilities ON facilities.id = f.id WHERE NOT EXISTS (SELECT 1 FROM u WHERE abs(u.lat - f.lat) < 0.002 AND {_distance('f.lat', 'f.lon', 'u.lat', 'u.lon')} < 200.0)), """ + _ZONED.format(points="left_") + """
SELECT p.id, round(lon, 6) AS lon, round(lat, 6) AS lat, round(radians(abs(LonMin - LonMax)) * 6371000.0::DOUBLE * cos(radians(35.0::DOUBLE)), 3) AS length_m,
  round(radians(abs(LatMin - LatMax)) * 6371000.0::DOUBLE * cos(radians(35.0::DOUBLE)), 3) AS width_m, '20240110' AS date, coalesce(nullif(z.zone, 0), -1)::DOUBLE AS region FROM p LEFT JOIN z ON z.id = p.id"""))
def facility_filter(spark, d):
    out = pipe.unexplained_facilities(a.facilities(spark, d), a.confirmed(spark, d), a.ships(spark, d), a.pings(spark, d), pipe.mercator_zones(a.zones(spark, d)), date="20240110")
    return out.select("id", r(F.col("lon"), 6).alias("lon"), r(F.col("lat"), 6).alias("lat"), r(F.col("length_m"), 3).alias("length_m"), r(F.col("width_m"), 3).alias("width_m"), "date", "region")


# ---- tracks

_INSIDE = """-- more
inside AS (SELECT pings.* REPLACE (sog * 0.5144::DOUBLE AS sog), scene.* FROM pings, scene WHERE lat BETWEEN min_lat AND max_lat AND lon BETWEEN min_lon AND max_lon AND epoch BETWEEN start_s - 600 AND end_s + 600 AND lat * lon <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY seq) - 1 AS k, count(*) OVER (PARTITION BY mmsi) AS n FROM inside),
mid AS (SELECT *, 1 + (max_lat - lat) / (max_lat - min_lat) * (round_even(((max_lat - dlat) - min_lat) / (-dlat), 0) - 1) AS y,
  1 + (lon - min_lon) / (max_lon - min_lon) * (round_even(((max_lon + dlon) - min_lon) / dlon, 0) - 1) AS x FROM numbered WHERE k = CASE WHEN n < 2 THEN 0 ELSE round_even(n / 2.0::DOUBLE, 0) END),
seen AS (SELECT *, end_s + (start_s - end_s) * trunc(y) / (ysize - 1) AS sar_s FROM mid WHERE trunc(y) BETWEEN 0 AND ysize - 1),
moved AS (SELECT *, lat + (sar_s - epoch) * (sog * cos(radians(cog)) / 111000.0::DOUBLE) AS lat1, lon + (sar_s - epoch) * (sog * sin(radians(cog)) / 111000.0::DOUBLE) AS lon1 FROM seen)
"""


@query(with_tables("pings scene", _INSIDE + "SELECT seq, mmsi, epoch, round(lon, 6) AS lon, round(lat, 6) AS lat FROM inside"))
def ais_bbox_time_filter(spark, d):
    return tracks.in_scene(a.pings(spark, d), a.scene(spark)).select("seq", "mmsi", "epoch", r(F.col("lon"), 6).alias("lon"), r(F.col("lat"), 6).alias("lat"))


@query(with_tables("pings", "SELECT mmsi, seq FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY seq) - 1 AS k, count(*) OVER (PARTITION BY mmsi) AS n FROM pings) WHERE k = CASE WHEN n < 2 THEN 0 ELSE round_even(n / 2.0::DOUBLE, 0) END"))
def ais_middle_row(spark, d):
    return tracks.middle_row(a.pings(spark, d).select("mmsi", "seq"), ["mmsi"]).select("mmsi", "seq")


@query(with_tables("pings", "SELECT mmsi, min(seq) AS seq, arg_min(dim_a, seq) AS dim_a, arg_min(dim_b, seq) AS dim_b, arg_min(dim_c, seq) AS dim_c, arg_min(dim_d, seq) AS dim_d FROM pings GROUP BY 1"))
def ais_first_static(spark, d):
    return tracks.first_row(a.pings(spark, d).select("mmsi", "seq", "dim_a", "dim_b", "dim_c", "dim_d"), ["mmsi"])


@query(with_tables("pings", "SELECT seq, round(lat + 300 * (sog * 0.5144::DOUBLE * cos(radians(cog)) / 111000.0::DOUBLE), 6) AS lat, round(lon + 300 * (sog * 0.5144::DOUBLE * sin(radians(cog)) / 111000.0::DOUBLE), 6) AS lon FROM pings"))
def ais_dead_reckon(spark, d):
    lat, lon = geo.dead_reckoned(F.col("lat"), F.col("lon"), F.col("sog") * 0.5144, F.col("cog"), F.lit(300.0))
    return a.pings(spark, d).select("seq", r(lat, 6).alias("lat"), r(lon, 6).alias("lon"))


@query(with_tables("pings scene", _INSIDE + "SELECT mmsi, seq, trunc(y)::BIGINT AS line, round(sar_s, 3) AS sar_s FROM seen"))
def ais_sar_time(spark, d):
    y, _ = geo.pixel_of(F.col("lat"), F.col("lon"))
    mid = tracks.middle_row(tracks.in_scene(a.pings(spark, d), a.scene(spark)), ["scene_id", "mmsi"])
    return mid.select("mmsi", "seq", n(y).alias("line"), r(tracks.scene_seconds(y), 3).alias("sar_s")).where("sar_s is not null")


@query(with_tables("pings", "SELECT seq, strftime(make_timestamp((epoch * 1000000)::BIGINT), '%Y-%m-%d') AS date, strftime(make_timestamp((epoch * 1000000)::BIGINT), '%H:%M:%S') AS time FROM pings"))
def ais_format_ts(spark, d):
    date, time = strings.date_and_time(F.col("epoch"))
    return a.pings(spark, d).select("seq", date.alias("date"), time.alias("time"))


_SAID = """first_all AS (SELECT mmsi, arg_min(dim_a, seq) AS dim_a, arg_min(dim_b, seq) AS dim_b, arg_min(dim_c, seq) AS dim_c, arg_min(dim_d, seq) AS dim_d FROM pings GROUP BY 1),
first_in AS (SELECT mmsi, arg_min(name, seq) AS name, arg_min(kind, seq) AS kind, arg_min(destination, seq) AS destination FROM inside GROUP BY 1)"""


@query(with_tables("pings scene", _INSIDE + ", " + _SAID + """
SELECT mmsi, strftime(make_timestamp((floor(sar_s) * 1000000)::BIGINT), '%Y-%m-%d') AS date, strftime(make_timestamp((floor(sar_s) * 1000000)::BIGINT), '%H:%M:%S') AS time, round(lon1, 5) AS lon, round(lat1, 5) AS lat, cog, round(sog, 4) AS sog,
  first_in.name, first_in.kind, first_in.destination, first_all.dim_a, first_all.dim_b, first_all.dim_c, first_all.dim_d FROM moved JOIN first_all USING (mmsi) JOIN first_in USING (mmsi) WHERE mmsi <> 0"""))
def ais_synchronised(spark, d):
    out = tracks.synchronised(a.pings(spark, d), a.scene(spark))
    return out.select("mmsi", "date", "time", r(F.col("lon"), 5).alias("lon"), r(F.col("lat"), 5).alias("lat"), "cog", r(F.col("sog")).alias("sog"), "name", "kind", "destination", "dim_a", "dim_b", "dim_c", "dim_d")


_SHIFT = """ranged AS (SELECT *, 1 + (lon - min_lon) / (max_lon - min_lon) * (round_even(((max_lon + dlon) - min_lon) / dlon, 0) - 1) AS c FROM inside),
away AS (SELECT *, CASE WHEN trunc(c) BETWEEN 0 AND xsize - 1 THEN sog * sin(radians(cog - 349)) * ((788000 + (936000 - 788000) * trunc(c) / (xsize - 1)) * cos(radians(30 + (45 - 30) * trunc(c) / (xsize - 1)))) / 7600 END AS s FROM ranged)"""


@query(with_tables("pings scene", _INSIDE + ", " + _SHIFT + " SELECT seq, round(lat + s * cos(radians(349)) / 111000, 6) AS lat, round(lon + s * sin(radians(349)) / 111000, 6) AS lon FROM away"))
def ais_azimuth_offset(spark, d):
    inside = tracks.in_scene(a.pings(spark, d), a.scene(spark)).withColumn("sog", F.col("sog") * 0.5144)
    out = tracks.azimuth_shifted(inside.select("scene_id", "seq", "lon", "lat", "sog", "cog"), a.scene(spark))
    return out.select("seq", r(F.col("lat"), 6).alias("lat"), r(F.col("lon"), 6).alias("lon"))


@query("SELECT event_id, ts, user_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-10 06:00:00.5'")
def span_scan(spark, d):
    return tables.in_span(a.table(spark, d, "events"), "2024-01-10 00:00:00", "2024-01-10 06:00:00.5").select("event_id", "ts", "user_id")


# ---- pixels


@query(with_tables("pixels", "SELECT scene_id, round(avg(b5::FLOAT::DOUBLE) FILTER (b5 <> 97), 6) AS mean FROM pixels GROUP BY 1 HAVING count(b5) FILTER (b5 <> 97) > 0"))
def sst_mean(spark, d):
    return raster.scene_mean(a.pixels(spark, d), "b5", 97.0, single=True).select("scene_id", r(F.col("mean"), 6).alias("mean"))


_BT = "(1329.2405::DOUBLE / ln(799.0284::DOUBLE / (0.00038::DOUBLE * b10 + 0.1::DOUBLE) + 1))"
_NDVI = "CASE WHEN b5 + b4 = 0 THEN 0 ELSE (b5 - b4) / (b5 + b4) END"
_PV = "((i - 0.2::DOUBLE) / 0.3::DOUBLE) * ((i - 0.2::DOUBLE) / 0.3::DOUBLE)"
_EPS = f"CASE WHEN i < 0 THEN 0.991::DOUBLE WHEN i < 0.2::DOUBLE THEN 0.996::DOUBLE WHEN i >= 0.5::DOUBLE THEN 0.973::DOUBLE ELSE 0.996::DOUBLE * ({_PV}) + 0.973::DOUBLE * (1 - {_PV}) END"


@query(with_tables("pixels", f"SELECT scene_id, row, col, round({_BT}, 4) AS kelvin FROM pixels"))
def brightness_temp(spark, d):
    return a.pixels(spark, d).select("scene_id", "row", "col", r(rad.brightness_temperature(F.col("b10"))).alias("kelvin"))


@query(with_tables("pixels", f"-- more\nv AS (SELECT *, {_NDVI} AS i FROM pixels) SELECT scene_id, row, col, round(i, 6) AS ndvi, round({_EPS}, 6) AS emissivity FROM v"))
def ndvi_emissivity(spark, d):
    i = rad.ndvi(F.col("b4"), F.col("b5"))
    return a.pixels(spark, d).withColumn("i", i).select("scene_id", "row", "col", r(F.col("i"), 6).alias("ndvi"), r(rad.emissivity(F.col("i")), 6).alias("emissivity"))


@query(with_tables("pixels", f"""-- more
v AS (SELECT *, {_NDVI} AS i FROM pixels), w AS (SELECT *, {_BT} AS bt, {_EPS} AS e FROM v), t AS (SELECT *, bt / (1 + 0.00115::DOUBLE * bt / 1.4388::DOUBLE * ln(e)) - 273.15::DOUBLE AS c FROM w)
SELECT scene_id, row, col, CASE WHEN (qa & 24) = 0 AND c BETWEEN -50 AND 80 THEN round(c, 4) END AS celsius FROM t"""))
def surface_temp(spark, d):
    return raster.surface_temperature(a.pixels(spark, d)).select("scene_id", "row", "col", r(F.col("celsius")).alias("celsius"))


@query(with_tables("pixels", "SELECT scene_id, (qa & 24) <> 0 AS cloudy, count(*)::BIGINT AS n FROM pixels GROUP BY 1, 2"))
def cloud_mask(spark, d):
    return a.pixels(spark, d).groupBy("scene_id", rad.cloudy(F.col("qa")).alias("cloudy")).agg(F.count("*").alias("n"))


def _log(x: str) -> str:
    return f"ln(CASE WHEN {x} <= 0 THEN 1e-10 ELSE {x} END)"


_GAP = f"({_log('(vh * vv)')} - {_log('(vh2 * vv2)')} - 2 * {_log('((vh - vh2) * (vv - vv2))')} + 4 * ln(2))"


@query(with_tables("pixels", f"SELECT scene_id, row, col, round({_GAP}, 4) AS statistic, round({_GAP} * (-2 * 4.4::DOUBLE), 4) AS scaled FROM pixels"))
def log_ratio_stat(spark, d):
    pair = ((F.col("vh"), F.col("vv")), (F.col("vh2"), F.col("vv2")))
    return a.pixels(spark, d).select("scene_id", "row", "col", r(rad.log_ratio(*pair)).alias("statistic"), r(rad.log_ratio_scaled(*pair, 4.4)).alias("scaled"))


@query(with_tables("pixels", f"SELECT scene_id, row, col, round(({_log('(vh * vv)')} + {_log('(vh2 * vv2)')} - 2 * {_log('((vh + vh2) * (vv + vv2))')} + 4 * ln(2)) * (-2 * 4.4::DOUBLE), 4) AS q FROM pixels"))
def log_likelihood(spark, d):
    return a.pixels(spark, d).select("scene_id", "row", "col", r(rad.log_likelihood((F.col("vh"), F.col("vv")), (F.col("vh2"), F.col("vv2")), 4.4)).alias("q"))


@query(with_tables("pixels", "-- more\nm AS (SELECT scene_id, avg(vv) AS u, avg(vv2) AS v FROM pixels GROUP BY 1) SELECT scene_id, round(2 * 4.4::DOUBLE * ln(sqrt(u / v) + sqrt(v / u)) - 2 * 4.4::DOUBLE * ln(2), 6) AS ratio FROM m"))
def band_mean_ratio(spark, d):
    m = a.pixels(spark, d).groupBy("scene_id").agg(F.avg("vv").alias("u"), F.avg("vv2").alias("v"))
    return m.select("scene_id", r(rad.likelihood_of_means(F.col("u"), F.col("v"), 4.4), 6).alias("ratio"))


@query(with_tables("pixels", "SELECT scene_id, round(avg(vv / nullif(vv2, 0)), 6) AS mean FROM pixels GROUP BY 1"))
def ratio_mean(spark, d):
    return raster.ratio_mean(a.pixels(spark, d), "vv", "vv2").select("scene_id", r(F.col("mean"), 6).alias("mean"))


@query(with_tables("pixels", "SELECT scene_id, min(vh) AS least, max(vh) AS most, round(avg(vh), 6) AS mean, round(stddev_pop(vh), 6) AS std, round(100.0::DOUBLE * count(vh) / count(*), 4) AS valid_percent FROM pixels GROUP BY 1"))
def band_stats(spark, d):
    return raster.band_statistics(a.pixels(spark, d), "vh").select("scene_id", "least", "most", r(F.col("mean"), 6).alias("mean"), r(F.col("std"), 6).alias("std"), r(F.col("valid_percent")).alias("valid_percent"))


@query(with_tables("pixels", """-- more
q AS (SELECT scene_id, quantile_cont(b10, 0.01) AS lo, quantile_cont(b10, 0.99) AS hi FROM pixels GROUP BY 1)
SELECT scene_id, row, col, floor((least(greatest(b10, lo), hi) - lo) / (hi - lo) * 255)::BIGINT AS byte FROM pixels JOIN q USING (scene_id)"""))
def percentile_stretch(spark, d):
    return raster.stretched(a.pixels(spark, d), "b10").select("scene_id", "row", "col", n("byte").alias("byte"))


@query(with_tables("pixels", "SELECT scene_id, round(quantile_cont(vv, 0.5), 6) AS q0, round(quantile_cont(vv, 0.98), 6) AS q1 FROM pixels GROUP BY 1"))
def band_quantiles(spark, d):
    return raster.quantiles(a.pixels(spark, d), "vv", [0.5, 0.98]).select("scene_id", r(F.col("q0"), 6).alias("q0"), r(F.col("q1"), 6).alias("q1"))


@query(with_tables("pixels", """SELECT scene_id, row, col, round(least(greatest(vh, 0.0), 0.15::DOUBLE) / 0.15::DOUBLE, 6) AS unit, floor(least(greatest(vv, 0.1::DOUBLE), 0.4::DOUBLE) * (255 / 0.4::DOUBLE))::BIGINT AS byte,
  floor(least(greatest(vv, 0.1::DOUBLE), 0.4::DOUBLE) * ((255 - 0.1::DOUBLE) / (0.4::DOUBLE - 0.1::DOUBLE)))::BIGINT AS offset_byte FROM pixels WHERE vh IS NOT NULL"""))
def band_clip_scale(spark, d):
    rows = a.pixels(spark, d).where("vh is not null")
    return rows.select("scene_id", "row", "col", r(rad.clipped(F.col("vh"), 0.0, 0.15) / 0.15, 6).alias("unit"), n(rad.byte_scaled(F.col("vv"), 0.1, 0.4)).alias("byte"), n(rad.byte_scaled(F.col("vv"), 0.1, 0.4, offset=True)).alias("offset_byte"))


@query(with_tables("pixels", "SELECT scene_id, row, col, round(vv + vv2, 6) AS total, round(0.229::DOUBLE * vh2 + 0.587::DOUBLE * vv + 0.114::DOUBLE * vv2, 6) AS gray, round(vv * vv + vv2 * vv2, 6) AS squares, round(vh2 * vv, 6) AS product FROM pixels"))
def band_mix(spark, d):
    b = (F.col("vh2"), F.col("vv"), F.col("vv2"))
    return a.pixels(spark, d).select("scene_id", "row", "col", *(r(rad.mixed(m, *b), 6).alias(k) for m, k in (("vh+vv", "total"), ("grayscale", "gray"), ("vv^2+vh^2", "squares"), ("vv*vh", "product"))))


@query(with_tables("pixels", "SELECT scene_id, row, col, coalesce(round((vh / vv) * ((vv / (vh + vv)) * (10 * vh * vv)), 10), 0) AS pol FROM pixels"))
def pol_index(spark, d):
    return a.pixels(spark, d).select("scene_id", "row", "col", r(rad.polarimetric(F.col("vh"), F.col("vv")), 10).alias("pol"))


@query(with_tables("pixels", "SELECT scene_id, row, col, round(10 * ln(vv), 4) AS db, round(20 * ln(vv), 4) AS amplitude_db FROM pixels"))
def to_db(spark, d):
    return a.pixels(spark, d).select("scene_id", "row", "col", r(rad.to_db(F.col("vv"))).alias("db"), r(rad.to_db(F.col("vv"), True)).alias("amplitude_db"))


@query(with_tables("pixels", "SELECT scene_id, row, col, round(least(vv, 0.1::DOUBLE) / 0.1::DOUBLE, 6) AS c0, round(b5 / 60, 6) AS c1 FROM pixels"))
def spill_inputs(spark, d):
    c0, c1 = rad.oil_inputs(F.col("vv"), F.col("b5"))
    return a.pixels(spark, d).select("scene_id", "row", "col", r(c0, 6).alias("c0"), r(c1, 6).alias("c1"))


@query(with_tables("pixels", "SELECT p.scene_id, p.row, p.col, p.b4 - q.b4 AS gap FROM pixels p JOIN pixels q ON q.scene_id = p.scene_id + 1 AND q.row = p.row AND q.col = p.col"))
def pixel_join(spark, d):
    p = a.pixels(spark, d).select("scene_id", "row", "col", "b4")
    both = raster.aligned(p, p.withColumn("scene_id", F.col("scene_id") - 1))
    return both.select("scene_id", "row", "col", (F.col("b4") - F.col("b4_2")).alias("gap"))


@query(with_tables("pixels", "SELECT scene_id, row, col, round((b5 - min(b5) OVER w) / nullif(max(b5) OVER w - min(b5) OVER w, 0), 6) AS unit FROM pixels WINDOW w AS (PARTITION BY scene_id, row // 16)"))
def tile_normalise(spark, d):
    rows = a.pixels(spark, d).withColumn("band", F.floor(F.col("row") / 16))
    return raster.normalised(rows, "b5", ["scene_id", "band"]).select("scene_id", "row", "col", r(F.col("unit"), 6).alias("unit"))


@query(with_tables("pixels", """-- more
o AS (SELECT *, row * 128 + col AS k FROM pixels),
g AS (SELECT *, max(CASE WHEN vh IS NOT NULL THEN k END) OVER (PARTITION BY scene_id ORDER BY k) AS pk, min(CASE WHEN vh IS NOT NULL THEN k END) OVER (PARTITION BY scene_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fk FROM o)
SELECT g.scene_id, g.row, g.col, round(CASE WHEN g.vh IS NOT NULL THEN g.vh WHEN p.vh IS NULL THEN f.vh WHEN f.vh IS NULL THEN p.vh ELSE p.vh + (f.vh - p.vh) * (g.k - pk) / (fk - pk) END, 6) AS vh
FROM g LEFT JOIN o p ON p.scene_id = g.scene_id AND p.k = pk LEFT JOIN o f ON f.scene_id = g.scene_id AND f.k = fk"""))
def gap_fill(spark, d):
    filled = raster.gaps_filled(a.pixels(spark, d).withColumn("width", F.lit(128)), "vh")
    return filled.select("scene_id", "row", "col", r(F.col("vh"), 6).alias("vh"))


@query(with_tables("pixels", """-- more
h AS (SELECT *, CASE WHEN count(vv) OVER w = 3 THEN sum(vv) OVER w END AS s FROM pixels WINDOW w AS (PARTITION BY scene_id, row ORDER BY col ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
SELECT scene_id, row, col, round(CASE WHEN count(s) OVER v = 3 THEN sum(s) OVER v / 9 END, 6) AS smooth FROM h WINDOW v AS (PARTITION BY scene_id, col ORDER BY row ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""))
def boxcar_separable(spark, d):
    return raster.boxcar_inside(a.pixels(spark, d), "vv", 3).select("scene_id", "row", "col", r(F.col("smooth"), 6).alias("smooth"))


@query(with_tables("pixels", "SELECT scene_id, (row - 10) // 2 AS row, (col - 20) // 3 AS col, vv FROM pixels WHERE row >= 10 AND row < 60 AND (row - 10) % 2 = 0 AND col >= 20 AND col < 100 AND (col - 20) % 3 = 0"))
def scene_slice(spark, d):
    out = raster.sliced(a.pixels(spark, d), (10, 60, 2), (20, 100, 3))
    return out.select("scene_id", n("row").alias("row"), n("col").alias("col"), "vv")


_NODES = "nodes AS (SELECT s.scene_id, i * 40 AS node_row, j * 32 AS node_col, 1 + (i * 7 + j * 3 + s.scene_id) % 5 / 10.0::DOUBLE AS factor FROM (SELECT DISTINCT scene_id FROM pixels) s, range(4) t(i), range(5) u(j))"


@query(with_tables("pixels", f"""-- more
{_NODES},
f AS (SELECT p.*, a.factor AS f00, b.factor AS f01, c.factor AS f10, e.factor AS f11, p.row % 40 / 40.0::DOUBLE AS t, p.col % 32 / 32.0::DOUBLE AS u FROM pixels p
  JOIN nodes a ON a.scene_id = p.scene_id AND a.node_row = p.row // 40 * 40 AND a.node_col = p.col // 32 * 32 JOIN nodes b ON b.scene_id = p.scene_id AND b.node_row = p.row // 40 * 40 AND b.node_col = p.col // 32 * 32 + 32
  JOIN nodes c ON c.scene_id = p.scene_id AND c.node_row = p.row // 40 * 40 + 40 AND c.node_col = p.col // 32 * 32 JOIN nodes e ON e.scene_id = p.scene_id AND e.node_row = p.row // 40 * 40 + 40 AND e.node_col = p.col // 32 * 32 + 32)
SELECT scene_id, row, col, round(pow(vv / ((f00 * (1 - u) + f01 * u) * (1 - t) + (f10 * (1 - u) + f11 * u) * t), 2), 6) AS sigma FROM f"""))
def calibrated(spark, d):
    rows = a.pixels(spark, d)
    last = lambda c, step: F.floor(F.max(c) / step).cast("int") + 1  # noqa: E731  the nodes go on to the one past each scene's last pixel
    ends = rows.groupBy("scene_id").agg(last("row", 40).alias("last_i"), last("col", 32).alias("last_j"))
    nodes = ends.select("scene_id", "last_j", F.explode(F.sequence(F.lit(0), F.col("last_i"))).alias("i")).select("scene_id", "i", F.explode(F.sequence(F.lit(0), F.col("last_j"))).alias("j"))
    nodes = nodes.select("scene_id", n(F.col("i") * 40).alias("node_row"), n(F.col("j") * 32).alias("node_col"), (1 + (F.col("i") * 7 + F.col("j") * 3 + F.col("scene_id")) % 5 / 10).alias("factor"))
    return raster.calibrated(rows.select("scene_id", "row", "col", "vv"), nodes, "vv").select("scene_id", "row", "col", r(F.col("sigma"), 6).alias("sigma"))


@query("SELECT s.k * 40 AS node FROM range(10) s(k) WHERE s.k * 40 - 40 < 200 AND s.k * 40 + 40 > 0")
def node_margin(spark, d):
    nodes = spark.range(10).select(F.lit(0).alias("scene_id"), (F.col("id") * 40).alias("node"))
    return raster.with_margin(nodes, "node", 200, ["scene_id"]).select("node")


@query(with_tables("scene", """-- more
g AS (SELECT r AS grid_row, c AS grid_col, (r * 31 + c * 17) % 11 - 3.0::DOUBLE AS value FROM range(8) a(r), range(9) b(c)),
p AS (SELECT r AS row, c AS col, floor((min_lon + (c * 10 + 5) * dlon - 126.02::DOUBLE) / 0.05::DOUBLE) AS gc, floor((34.49::DOUBLE - (max_lat + (r * 10 + 5) * dlat)) / 0.05::DOUBLE) AS gr FROM scene, range(50) a(r), range(50) b(c))
SELECT row, col, coalesce(value, 0) AS value, (CASE WHEN coalesce(value, 0) > 0 THEN 0 ELSE 1 END)::BIGINT AS water FROM p LEFT JOIN g ON grid_row = gr AND grid_col = gc"""))
def dem_resample(spark, d):
    grid = spark.range(72).select((F.col("id") / 9).cast("long").alias("grid_row"), (F.col("id") % 9).alias("grid_col"))
    grid = grid.select("*", ((F.col("grid_row") * 31 + F.col("grid_col") * 17) % 11 - F.lit(3.0)).alias("value"), F.lit(126.02).alias("lon0"), F.lit(34.49).alias("lat0"), F.lit(0.05).alias("step"))
    scenes = a.scene(spark).select("scene_id", F.lit(50).alias("height"), F.lit(50).alias("width"), "min_lon", (F.col("dlon") * 10).alias("dlon"), "max_lat", (F.col("dlat") * 10).alias("dlat"))
    return raster.resampled(scenes, grid).select(n("row").alias("row"), n("col").alias("col"), "value", n("water").alias("water"))


@query(with_tables("scene edges", """-- more
p AS (SELECT r AS row, c AS col, min_lon + (c + 0.5) * 0.01::DOUBLE AS x, max_lat - (r + 0.5) * 0.01::DOUBLE AS y FROM scene, range(50) a(r), range(50) b(c)),
h AS (SELECT row, col, zone FROM p JOIN edges ON (ay > y) <> (b_y > y) AND x < (bx - ax) * (y - ay) / (b_y - ay) + ax GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)
SELECT row, col, (CASE WHEN EXISTS (SELECT 1 FROM h WHERE h.row = p.row AND h.col = p.col) THEN 1 ELSE 0 END)::BIGINT AS land FROM p"""))
def land_mask(spark, d):
    scenes = a.scene(spark).select("scene_id", F.lit(50).alias("height"), F.lit(50).alias("width"), "min_lon", F.lit(0.01).alias("dlon"), "max_lat", F.lit(-0.01).alias("dlat"))
    return products.burnt(scenes, a.zones(spark, d)).select(n("row").alias("row"), n("col").alias("col"), n("land").alias("land"))


@query(with_tables("pixels", """SELECT scene_id, row, col, round(CASE WHEN vv = 0 THEN 0 ELSE 2 * least(vv, 0.1::DOUBLE) / 0.1::DOUBLE + b5 / 60 END, 6) AS output FROM pixels"""))
def spill_pixels(spark, d):
    rows = a.pixels(spark, d).select("scene_id", "row", "col", F.col("vv").alias("b1"), F.col("b5").alias("b2"))
    return products.spills(rows, lambda x: 2 * x[0] + x[1], 64).select("scene_id", "row", "col", r(F.col("output"), 6).alias("output"))


@query(with_tables("scene", "SELECT round(126.0::DOUBLE - 0.5::DOUBLE / 50, 8) AS x0, round(0.5::DOUBLE / 50, 8) AS dx, round(34.5::DOUBLE + 0.5::DOUBLE / 40 / 2, 8) AS y0, round(-(0.5::DOUBLE / 40), 8) AS dy, 96::BIGINT AS multiple, round((1 - cos(25 * pi() / 100)) / 2 * 0.9::DOUBLE + 0.1::DOUBLE, 8) AS ramp FROM scene"))
def quickview_transform(spark, d):
    t = products.transform_of((F.col("min_lon"), F.col("min_lat"), F.col("max_lon"), F.col("max_lat")), F.lit(40), F.lit(50))
    return a.scene(spark).select(r(t[0], 8).alias("x0"), r(t[1], 8).alias("dx"), r(t[3], 8).alias("y0"), r(t[5], 8).alias("dy"), products.divisible(F.lit(70), 32).alias("multiple"), r(products.cosine_ramp(F.lit(25), 100, 0.1, 1.0), 8).alias("ramp"))


@query(with_tables("ships", """-- more
p AS (SELECT id, 34.5::DOUBLE - Lat AS a, Lon - 126.0::DOUBLE AS b FROM ships),
q AS (SELECT id, (0.001::DOUBLE * a - 0.0001::DOUBLE * b) / (0.001::DOUBLE * 0.001::DOUBLE - 0.0001::DOUBLE * 0.0002::DOUBLE) AS r, (0.001::DOUBLE * b - 0.0002::DOUBLE * a) / (0.001::DOUBLE * 0.001::DOUBLE - 0.0001::DOUBLE * 0.0002::DOUBLE) AS c FROM p)
SELECT 0::BIGINT AS scene_id, id, CASE WHEN r BETWEEN 0 AND 350 AND c BETWEEN 0 AND 480 THEN round(r, 4) + 0.0::DOUBLE END AS row, CASE WHEN r BETWEEN 0 AND 350 AND c BETWEEN 0 AND 480 THEN round(c, 4) + 0.0::DOUBLE END AS col FROM q"""))
def image_index(spark, d):
    nodes = spark.range(72).select(F.lit(0).cast("long").alias("scene_id"), (F.floor(F.col("id") / 9) * 50).alias("node_row"), (F.col("id") % 9 * 60).alias("node_col"))
    nodes = nodes.withColumns({"lat": 34.5 - F.col("node_row") * 0.001 - F.col("node_col") * 0.0001, "lon": 126.0 + F.col("node_col") * 0.001 + F.col("node_row") * 0.0002})
    points = a.ships(spark, d).select(F.lit(0).cast("long").alias("scene_id"), "id", F.col("Lat").alias("lat"), F.col("Lon").alias("lon"))
    return products.index_of(points, nodes).select("scene_id", "id", r(F.col("row")).alias("row"), r(F.col("col")).alias("col"))


@query()
def coregister(spark, d):
    rows = a.dense(spark, d)
    first, second = (rows.select("scene_id", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(c).alias("v")) for c in ("first", "second"))
    return products.coregistered(first, second, "v", patch=32, degree=1, tile=128)


@query("""SELECT epoch(time_bucket(INTERVAL 1 DAY, ts))::BIGINT AS start_s, (user_id % 10)::BIGINT AS mmsi, count(*) AS n, round(avg((event_id * 7 % 30)::DOUBLE), 6) AS mean_sog FROM events GROUP BY 1, 2""")
def stream_activity(spark, d):
    """The streaming aggregation run over files to their end."""
    from ..streaming import tracks as live

    schema = a.table(spark, d, "events").schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    stream = live.reports(spark, f"{d}/events*.parquet", schema).withColumns({"ts": F.col("ts").cast("timestamp"), "mmsi": F.col("user_id") % 10, "sog": (F.col("event_id") * 7 % 30).cast("double")})
    at = _at(spark, "activity")
    q = live.activity(stream, window="1 day").writeStream.foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{at}/table")).outputMode("complete").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{at}/table").select(n(F.col("start").cast("double")).alias("start_s"), n("mmsi").alias("mmsi"), "n", r(F.col("mean_sog"), 6).alias("mean_sog"))


# ---- tiles


def _scenes(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return a.table(spark, d, "customer").select(k.cast("long").alias("scene_id"), (k * 37 % 3000 + 700).cast("int").alias("height"), (k * 53 % 3000 + 700).cast("int").alias("width"))


_SCENES = "scenes AS (SELECT c_custkey::BIGINT AS scene_id, c_custkey * 37 % 3000 + 700 AS height, c_custkey * 53 % 3000 + 700 AS width FROM customer)"


def _overlap_sql(axis: str) -> str:
    return f"""SELECT scene_id, s FROM (SELECT scene_id, s, max(s) OVER (PARTITION BY scene_id) AS m, row_number() OVER (PARTITION BY scene_id ORDER BY s) AS k, count(*) OVER (PARTITION BY scene_id) AS c FROM (
  SELECT scene_id, CASE WHEN i = ({axis} - 1) // 440 THEN {axis} - 640 ELSE i * 440 END AS s FROM scenes, range(10) t(i) WHERE i * 440 < {axis})) WHERE k < c"""


@query(f"WITH {_SCENES}, ys AS ({_overlap_sql('height')}), xs AS ({_overlap_sql('width')}) SELECT scene_id, xs.s::BIGINT AS x1, ys.s::BIGINT AS y1, (xs.s + 640)::BIGINT AS x2, (ys.s + 640)::BIGINT AS y2 FROM ys JOIN xs USING (scene_id)")
def tile_starts_overlap(spark, d):
    return tiles.overlapping_tiles(_scenes(spark, d)).select("scene_id", *(n(c).alias(c) for c in ("x1", "y1", "x2", "y2")))


def _div_sql(axis: str) -> str:
    return f"""SELECT scene_id, a, CASE WHEN b = m THEN {axis} ELSE b END AS b FROM (SELECT scene_id, {axis}, i * ({axis} // 5) AS a, (i + 1) * ({axis} // 5) AS b, ({axis} - 1) // ({axis} // 5) * ({axis} // 5) AS m FROM scenes, range(7) t(i)) WHERE b <= m"""


@query(f"WITH {_SCENES}, ys AS ({_div_sql('height')}), xs AS ({_div_sql('width')}) SELECT scene_id, xs.a::BIGINT AS x1, ys.a::BIGINT AS y1, xs.b::BIGINT AS x2, ys.b::BIGINT AS y2 FROM ys JOIN xs USING (scene_id)")
def tile_starts_div(spark, d):
    return tiles.divided_tiles(_scenes(spark, d)).select("scene_id", *(n(c).alias(c) for c in ("x1", "y1", "x2", "y2")))


@query(f"WITH {_SCENES} SELECT scene_id, (j * 1024)::BIGINT AS x1, (i * 1024)::BIGINT AS y1 FROM scenes, range(4) t(i), range(4) u(j) WHERE i * 1024 < height AND j * 1024 < width")
def tile_starts_padded(spark, d):
    return tiles.padded_tiles(_scenes(spark, d), 1024).select("scene_id", n("x1").alias("x1"), n("y1").alias("y1"))


@query(with_tables("pixels", "SELECT scene_id, row, col, x * 24 AS x1, y * 24 AS y1 FROM pixels, range(30) s(x), range(60) t(y) WHERE col >= x * 24 AND col < x * 24 + 32 AND row >= y * 24 AND row < y * 24 + 32"))
def tile_pixels(spark, d):
    return tiles.dealt_pixels(a.pixels(spark, d).select("scene_id", "row", "col"), 32, 24).select("scene_id", "row", "col", n("x1").alias("x1"), n("y1").alias("y1"))


@query(with_tables("pixels", "SELECT scene_id, col // 32 * 32 AS x1, row // 32 * 32 AS y1, count(b4) AS n, round(avg(b4 - 10), 6) AS mean FROM pixels GROUP BY 1, 2, 3 HAVING avg(b4 - 10) <> 0"))
def tile_nonempty(spark, d):
    rows = a.pixels(spark, d).withColumn("v", F.col("b4") - 10)
    return tiles.filled_tiles(rows, "v", 32).select("scene_id", n("x1").alias("x1"), n("y1").alias("y1"), "n", r(F.col("mean"), 6).alias("mean"))


@query(with_tables("detections", "SELECT image_id, det_id, s.x * 100 AS tx, t.y * 100 AS ty FROM detections, range(6) s(x), range(6) t(y) WHERE x1 BETWEEN s.x * 100 AND s.x * 100 + 100 AND y1 BETWEEN t.y * 100 AND t.y * 100 + 100"))
def tile_assign(spark, d):
    images = a.detections(spark, d).select(F.col("image_id").alias("scene_id")).distinct().withColumns({"height": F.lit(600), "width": F.lit(600)})
    boxes = a.detections(spark, d).select(F.col("image_id").alias("scene_id"), F.col("det_id").alias("box_id"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    out = tiles.boxes_in_tiles(boxes, tiles.padded_tiles(images, 100))
    return out.select(F.col("scene_id").alias("image_id"), F.col("box_id").alias("det_id"), n("x1").alias("tx"), n("y1").alias("ty"))


# ---- boxes

_PAIRS = """-- more
pairs AS (SELECT a.image_id, a.det_id AS ida, b.det_id AS idb, a.conf AS ca, b.conf AS cb, a.cls AS cla, b.cls AS clb, a.x2 - a.x1 AS w1, a.y2 - a.y1 AS h1, b.x2 - b.x1 AS w2, b.y2 - b.y1 AS h2,
  (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS i, greatest(a.x2, b.x2) - least(a.x1, b.x1) AS cw, greatest(a.y2, b.y2) - least(a.y1, b.y1) AS ch,
  (pow(b.x1 + b.x2 - a.x1 - a.x2, 2) + pow(b.y1 + b.y2 - a.y1 - a.y2, 2)) / 4 AS rho
  FROM detections a JOIN detections b ON a.image_id = b.image_id AND a.det_id < b.det_id AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2),
m AS (SELECT *, i / (w1 * h1 + w2 * h2 - i) AS iou, w1 * h1 + w2 * h2 - i AS u FROM pairs)
"""
_E = "1e-7::DOUBLE"
_SOFT = _PAIRS + f", s AS (SELECT *, i / (w1 * (h1 + {_E}) + w2 * (h2 + {_E}) - i + {_E}) AS si, 4 / pow(pi(), 2) * pow(atan(w2 / (h2 + {_E} + {_E})) - atan(w1 / (h1 + {_E} + {_E})), 2) AS v FROM m) "


def _measured(spark, d, **measures) -> DataFrame:
    pairs = det.overlapping_pairs(a.detections(spark, d))
    return pairs.select("image_id", F.col("a_det_id").alias("ida"), F.col("b_det_id").alias("idb"), *(r(f(*det.pair_boxes())).alias(k) for k, f in measures.items()))


@query(with_tables("detections", _PAIRS + "SELECT image_id, ida, idb, (round(iou, 4) + 0.0::DOUBLE) AS iou, (round(i / least(w1 * h1, w2 * h2), 4) + 0.0::DOUBLE) AS smaller, (round(least(w1, w2) * least(h1, h2) / (w1 * h1 + w2 * h2 - least(w1, w2) * least(h1, h2)), 4) + 0.0::DOUBLE) AS sizes FROM m"))
def box_iou_pairs(spark, d):
    return _measured(spark, d, iou=bx.iou, smaller=bx.over_smaller, sizes=lambda p, q: bx.size_iou(p.width, p.height, q.width, q.height))


@query(with_tables("detections", _PAIRS + "SELECT image_id, ida, idb, (round(iou - (cw * ch - u) / (cw * ch), 4) + 0.0::DOUBLE) AS giou, (round(iou - rho / (cw * cw + ch * ch), 4) + 0.0::DOUBLE) AS diou FROM m"))
def box_giou_diou(spark, d):
    return _measured(spark, d, giou=bx.giou, diou=bx.diou)


@query(with_tables("detections", _SOFT + f"SELECT image_id, ida, idb, (round(si, 4) + 0.0::DOUBLE) AS iou, (round(si - rho / (cw * cw + ch * ch + {_E}), 4) + 0.0::DOUBLE) AS diou, (round(si - (rho / (cw * cw + ch * ch + {_E}) + v * (v / (v - si + (1 + {_E})))), 4) + 0.0::DOUBLE) AS ciou FROM s"))
def box_ciou(spark, d):
    return _measured(spark, d, iou=bx.soft_iou, diou=lambda p, q: bx.soft_iou(p, q, "diou"), ciou=lambda p, q: bx.soft_iou(p, q, "ciou"))


@query(with_tables("detections", _PAIRS + """, s AS (SELECT *, i / (w1 * (h1 + 1e-9::DOUBLE) + w2 * (h2 + 1e-9::DOUBLE) - i + 1e-9::DOUBLE) AS q, pow(i / (w1 * (h1 + 1e-9::DOUBLE) + w2 * (h2 + 1e-9::DOUBLE) - i + 1e-9::DOUBLE) + 1e-9::DOUBLE, 2) AS si FROM m)
SELECT image_id, ida, idb, (round(si, 4) + 0.0::DOUBLE) AS iou, (round(si - pow(rho, 2) / (pow(cw * cw + ch * ch, 2) + 1e-9::DOUBLE), 4) + 0.0::DOUBLE) AS diou FROM s"""))
def box_alpha_iou(spark, d):
    return _measured(spark, d, iou=bx.alpha_iou, diou=lambda p, q: bx.alpha_iou(p, q, kind="diou"))


@query(with_tables("detections", _PAIRS + """, s AS (SELECT *, pow(2 * acos(least(1.0::DOUBLE, (w1 * w2 + h1 * h2) / (sqrt(w1 * w1 + h1 * h1) * sqrt(w2 * w2 + h2 * h2)))) / pi(), 2) AS v FROM m)
SELECT image_id, ida, idb, (round(iou - rho / (cw * cw + ch * ch) - CASE WHEN iou >= 0.5 AND 1 - iou + v <> 0 THEN v / (1 - iou + v) * v ELSE 0 END, 4) + 0.0::DOUBLE) AS ciou FROM s"""))
def box_cosine_ciou(spark, d):
    return _measured(spark, d, ciou=bx.cosine_ciou)


@query(with_tables("detections", _PAIRS + "SELECT DISTINCT image_id, CASE WHEN ca >= cb THEN idb ELSE ida END AS det_id FROM m WHERE cla = clb AND iou > 0.3::DOUBLE"))
def suppressed_by_stronger(spark, d):
    return det.outdone(a.detections(spark, d)).select("image_id", "det_id")


@query(with_tables("detections", "SELECT image_id, det_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, det_id) AS rank FROM detections) WHERE rank <= 10"))
def topk_conf(spark, d):
    return det.top(a.detections(spark, d), 10).select("image_id", "det_id", "rank")


@query(with_tables("detections", "SELECT cls::BIGINT AS cls, count(*) AS n FROM detections WHERE conf > 0.05::DOUBLE AND cls IN (0, 2, 3) GROUP BY 1"))
def class_counts(spark, d):
    kept = a.detections(spark, d).where((F.col("conf") > 0.05) & F.col("cls").isin(0, 2, 3))
    return det.class_counts(kept).select(n("cls").alias("cls"), "n")


@query("SELECT vec_id, list_max(embedding)::DOUBLE AS best, (list_position(embedding, list_max(embedding)) - 1)::BIGINT AS at FROM embeddings")
def class_argmax(spark, d):
    most, at = det.best_class(F.col("embedding"))
    return a.table(spark, d, "embeddings").select("vec_id", most.cast("double").alias("best"), n(at).alias("at"))


@query("""WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings)
SELECT vec_id, round(max(exp(v)) / sum(exp(v)), 6) AS top, round(min(1 / (1 + exp(-v))), 6) AS least FROM e GROUP BY 1""")
def softmax_sigmoid(spark, d):
    part = F.transform("embedding", lambda v: v.cast("double"))
    return a.table(spark, d, "embeddings").select("vec_id", r(F.array_max(rad.softmax(part)), 6).alias("top"), r(F.array_min(F.transform(part, rad.sigmoid)), 6).alias("least"))


@query(with_tables("detections", "SELECT image_id, det_id, least(greatest(x1, 0), 500)::DOUBLE AS x1, least(greatest(y1, 0), 450)::DOUBLE AS y1, least(greatest(x2, 0), 500)::DOUBLE AS x2, least(greatest(y2, 0), 450)::DOUBLE AS y2 FROM detections"))
def clip_boxes(spark, d):
    return det.clipped_to_image(a.detections(spark, d), F.lit(500.0), F.lit(450.0)).select("image_id", "det_id", "x1", "y1", "x2", "y2")


@query(with_tables("detections", """-- more
c AS (SELECT image_id, det_id, least(x1, 500) AS x1, least(y1, 450) AS y1, least(x2, 500) AS x2, least(y2, 450) AS y2 FROM detections)
SELECT image_id, det_id FROM c WHERE (y1 = 450 AND y2 = 450) OR (x1 = 500 AND x2 = 500) OR (y1 = 0 AND y2 = 0) OR (x1 = 0 AND x2 = 0)"""))
def degenerate_boxes(spark, d):
    clipped = det.clipped_to_image(a.detections(spark, d), F.lit(500.0), F.lit(450.0))
    return clipped.where(bx.collapsed(bx.Box.of(), F.lit(500.0), F.lit(450.0))).select("image_id", "det_id")


@query(with_tables("detections", """-- more
c AS (SELECT *, least(x2, 500) - least(x1, 500) AS w, least(y2, 450) - least(y1, 450) AS h FROM detections)
SELECT image_id, det_id FROM c WHERE w > 2 AND h > 2 AND w * h / ((x2 - x1) * (y2 - y1) + 1e-16) > 0.1 AND greatest(w / (h + 1e-16), h / (w + 1e-16)) < 20"""))
def box_candidates(spark, d):
    old = bx.Box.of()
    new = bx.clipped(old, F.lit(500.0), F.lit(450.0))
    return a.detections(spark, d).where(bx.plausible(old, new)).select("image_id", "det_id")


@query(with_tables("detections", """SELECT image_id, det_id, round((x1 + x2) / 2 / 640, 8) AS cx, round((y2 - y1) / 640, 8) AS h, round(700 - x2, 4) AS flipped_x1, round((x1 + x2) / 2 - ((x2 - x1) * 1.02::DOUBLE + 10) / 2, 4) AS wide_x1 FROM detections"""))
def box_transforms(spark, d):
    b = bx.Box.of()
    cx, _, _, h = bx.to_shares(b, 640, 640)
    return a.detections(spark, d).select("image_id", "det_id", r(cx, 8).alias("cx"), r(h, 8).alias("h"), r(bx.flipped(b, F.lit(700.0)).x1).alias("flipped_x1"), r(bx.widened(b).x1).alias("wide_x1"))


@query(with_tables("detections", """-- more
s AS (SELECT *, 1 / (1 + exp(-(conf * 4 - 2))) AS t FROM detections)
SELECT image_id, det_id, round((2 * t - 0.5::DOUBLE + cls) * 8, 4) AS cx7, round(pow(2 * t, 2) * 12, 4) AS w7, round((t + cls) / 76 - exp(conf) * 3 / 76 / 2, 6) AS x4 FROM s"""))
def decode_outputs(spark, d):
    t = rad.sigmoid(F.col("conf") * 4 - 2)
    rows = a.detections(spark, d).withColumn("t", t).withColumn("g", F.col("cls").cast("double"))
    t, g = F.col("t"), F.col("g")
    cx, _, w, _ = bx.decoded_v7(t, t, t, t, g, g, F.lit(8.0), F.lit(12.0), F.lit(12.0))
    v4 = bx.decoded_v4(t, t, F.col("conf"), F.col("conf"), g, g, F.lit(3.0), F.lit(3.0), F.lit(76.0), F.lit(76.0))
    return rows.select("image_id", "det_id", r(cx).alias("cx7"), r(w).alias("w7"), r(v4.x1, 6).alias("x4"))


def _water(row: Column, col: Column) -> Column:
    return F.when((F.floor(row / 50) + F.floor(col / 60) + F.col("image_id")) % 4 == 0, 0).otherwise(1)


def _mask(touched: DataFrame) -> DataFrame:
    """The mask's pixels (image_id, row, col, water) that boxes of any image touch."""
    return touched.select("image_id", "row", "col").distinct().withColumn("water", _water(F.col("row"), F.col("col")))


_WATER = "(CASE WHEN (row // 50 + col // 60 + image_id) % 4 = 0 THEN 0 ELSE 1 END)"


@query(with_tables("detections", f"""-- more
c AS (SELECT image_id, det_id, unnest([x1, x2, x1, x2])::BIGINT AS col, unnest([y1, y1, y2, y2])::BIGINT AS row FROM detections)
SELECT image_id, det_id FROM c GROUP BY 1, 2 HAVING min({_WATER}) = 1"""))
def corner_landmask(spark, d):
    boxes = a.detections(spark, d)
    corner = lambda x, y: F.struct(F.floor(F.col(y)).cast("int").alias("row"), F.floor(F.col(x)).cast("int").alias("col"))
    touched = boxes.select("image_id", F.inline(F.array(corner("x1", "y1"), corner("x2", "y1"), corner("x1", "y2"), corner("x2", "y2"))))
    return det.on_water(boxes, _mask(touched)).select("image_id", "det_id")


@query(with_tables("detections", f"""-- more
c AS (SELECT image_id, det_id, (x1 + floor((x2 - x1) / 2))::BIGINT AS col, (y1 + floor((y2 - y1) / 2))::BIGINT AS row FROM detections)
SELECT image_id, det_id FROM c WHERE {_WATER} = 1"""))
def shore_filter(spark, d):
    boxes = a.detections(spark, d)
    middle = lambda p, q: (F.col(p) + F.floor((F.col(q) - F.col(p)) / 2)).cast("int")
    touched = boxes.select("image_id", middle("y1", "y2").alias("row"), middle("x1", "x2").alias("col"))
    return det.off_shore(boxes, _mask(touched).where("water = 0")).select("image_id", "det_id")


_TRAIN = "train AS (SELECT l_linenumber::BIGINT AS image_id, l_orderkey::BIGINT AS box_id, l_orderkey * 7 % 100 AS x, l_orderkey * 11 % 80 AS y, l_orderkey % 6 + 3 AS w, l_orderkey % 5 + 3 AS h FROM lineitem GROUP BY ALL)"


@query(with_tables("pixels", f"""-- more
{_TRAIN}, q AS (SELECT scene_id, quantile_cont(b4, 0.5) AS level FROM pixels GROUP BY 1),
m AS (SELECT image_id, box_id, avg(b4) AS mean FROM train JOIN pixels ON scene_id = image_id AND col >= x AND col < x + w AND row >= y AND row < y + h GROUP BY 1, 2)
SELECT t.image_id, t.box_id FROM train t LEFT JOIN m USING (image_id, box_id) LEFT JOIN q ON q.scene_id = t.image_id WHERE x > 0 AND NOT coalesce(mean < level, false)"""))
def train_box_filter(spark, d):
    k = F.col("l_orderkey")
    boxes = a.table(spark, d, "lineitem").select(n("l_linenumber").alias("image_id"), n(k).alias("box_id"), (k * 7 % 100).alias("x"), (k * 11 % 80).alias("y"), (k % 6 + 3).alias("w"), (k % 5 + 3).alias("h")).distinct()
    pixels = a.pixels(spark, d).select(F.col("scene_id").alias("image_id"), "row", "col", F.col("b4").alias("value"))
    return det.bright_boxes(boxes, pixels).select("image_id", "box_id")


@query(with_tables("detections", """-- more
o AS (SELECT image_id, det_id, w, h, least(w, aw) * least(h, ah) / (w * h + aw * ah - least(w, aw) * least(h, ah)) AS v, k FROM (SELECT image_id, det_id, x2 - x1 AS w, y2 - y1 AS h FROM detections), (VALUES (0, 12, 16), (1, 19, 36), (2, 40, 28)) t(k, aw, ah))
SELECT image_id, det_id, arg_min(k, -v * 1000000 + k * 1e-9)::BIGINT AS anchor, round(max(v), 6) AS overlap FROM o GROUP BY 1, 2"""))
def anchor_best(spark, d):
    truth = a.detections(spark, d).select("image_id", "det_id", (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"))
    out = det.best_anchor(truth, [(12, 16), (19, 36), (40, 28)])
    return out.select("image_id", "det_id", n("anchor").alias("anchor"), r(F.col("anchor_iou"), 6).alias("overlap"))


@query(with_tables("detections", "SELECT least(greatest(floor((x1 + x2) / 2 / 70) + 1, 0), 11)::BIGINT AS bx, least(greatest(floor((y1 + y2) / 2 / 70) + 1, 0), 11)::BIGINT AS by, count(*) AS n FROM detections GROUP BY 1, 2"))
def box_histogram(spark, d):
    cx, cy, _, _ = bx.to_centre(bx.Box.of())
    return lookup.bin_counts(a.detections(spark, d), cx, cy, (0, 700, 0, 700), 10).select(n("bx").alias("bx"), n("by").alias("by"), "n")


# ---- lookups and text


@query(with_tables("pings", "SELECT mmsi, floor(min(lat))::BIGINT AS south, ceil(max(lat))::BIGINT AS north, floor(min(lon))::BIGINT AS west, ceil(max(lon))::BIGINT AS east FROM pings GROUP BY 1"))
def footprint_bbox(spark, d):
    return lookup.footprint(a.pings(spark, d), ["mmsi"])


@query(with_tables("pings", """-- more
b AS (SELECT mmsi % 3 AS g, floor(min(lat))::BIGINT AS south, ceil(max(lat))::BIGINT AS north, floor(min(lon))::BIGINT AS west, ceil(max(lon))::BIGINT AS east FROM pings GROUP BY 1)
SELECT g, lat, lon FROM b, range(30, 40) t(lat), range(120, 130) u(lon) WHERE lat BETWEEN south AND north AND lon BETWEEN west AND east"""))
def degree_grid(spark, d):
    bounds = lookup.footprint(a.pings(spark, d).withColumn("g", F.col("mmsi") % 3), ["g"])
    return lookup.degree_grid(bounds, ["g"])


@query("""WITH s AS (SELECT o_orderkey AS scene_id, o_orderdate + to_seconds(o_orderkey * 977 % 86400) AS seen FROM orders),
o AS (SELECT 'P' || lpad(o_orderkey::VARCHAR, 8, '0') AS name, o_orderdate::DATE AS day, o_orderkey FROM orders WHERE o_orderkey % 7 = 0),
h AS (SELECT 'R' || lpad(o_orderkey::VARCHAR, 8, '0') AS name, o_orderdate + to_seconds(o_orderkey * 541 % 86400) AS a FROM orders WHERE o_orderkey % 3 = 0),
p AS (SELECT scene_id, min(name) AS name FROM s JOIN o ON s.seen::DATE = o.day GROUP BY 1), r AS (SELECT scene_id, min(name) AS name FROM s JOIN h ON a < seen AND seen < a + INTERVAL 100 MINUTE GROUP BY 1)
SELECT s.scene_id, coalesce(p.name, r.name) AS orbit FROM s LEFT JOIN p USING (scene_id) LEFT JOIN r USING (scene_id)""")
def orbit_interval(spark, d):
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    o = a.table(spark, d, "orders")
    after = lambda factor: day + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k * factor % 86400).cast("decimal(18,6)"))
    name = lambda p: F.concat(F.lit(p), F.lpad(k.cast("string"), 8, "0"))
    scenes = o.select(k.alias("scene_id"), after(977).alias("at"))
    precise = o.where(k % 7 == 0).select(name("P").alias("name"), F.date_sub(day.cast("date"), 1).alias("start"), F.date_add(day.cast("date"), 1).alias("end"))
    other = o.where(k % 3 == 0).select(name("R").alias("name"), after(541).alias("start"), (after(541) + F.expr("INTERVAL 100 MINUTE")).alias("end"))
    return lookup.orbit_of(scenes, precise, other).select("scene_id", "orbit")


@query("""SELECT p_partkey, CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'SHIPD' WHEN 'blue' THEN 'OILSP' ELSE '-1' END AS code, regexp_replace(p_brand, '[|@#!¡·$€%&()=?¿^*;:,¨´><+]', '_', 'g') AS brand, length(p_name) = strlen(p_name) AS ascii FROM part""")
def target_code(spark, d):
    word = F.split("p_name", " ")[0]
    named = F.when(word == "red", F.lit("Ship")).when(word == "blue", F.lit("OilSpill")).otherwise(word)
    return a.table(spark, d, "part").select("p_partkey", strings.target_code(named).alias("code"), strings.cleaned(F.col("p_brand")).alias("brand"), strings.is_ascii(F.col("p_name")).alias("ascii"))


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders)
WHERE k = CASE WHEN round_even(c / 2.0::DOUBLE, 0) = 0 THEN c ELSE round_even(c / 2.0::DOUBLE, 0) END""")
def median_scene(spark, d):
    return lookup.middle_of_sorted(a.table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"thresholdEstimationValue\":' || CAST(value AS VARCHAR) || '}' AS alert FROM events WHERE value < 100")
def alert_json(spark, d):
    rows = tables.alert(a.table(spark, d, "events").where("value < 100"), F.col("value"))
    return rows.select("event_id", n(F.get_json_object("props", "$.k")).alias("k"), "alert")


@query("""WITH t AS (SELECT event_id, 'S1A_IW_GRDH_1SDV_' || strftime(ts, '%Y%m%dT%H%M%S') || '_' || strftime(ts + INTERVAL 25 SECOND, '%Y%m%dT%H%M%S') || '_X' AS name, ts FROM events)
SELECT event_id, epoch(date_trunc('second', ts))::DOUBLE AS start_s, epoch(date_trunc('second', ts + INTERVAL 25 SECOND))::DOUBLE AS end_s FROM t""")
def scene_name_times(spark, d):
    at = F.col("ts").cast("timestamp")
    said = lambda c: F.date_format(c, "yyyyMMdd'T'HHmmss")
    name = F.concat(F.lit("S1A_IW_GRDH_1SDV_"), said(at), F.lit("_"), said(at + F.expr("INTERVAL 25 SECOND")), F.lit("_X"))
    start, end = strings.scene_times(name)
    return a.table(spark, d, "events").select("event_id", start.cast("double").alias("start_s"), end.cast("double").alias("end_s"))


@query("""SELECT k AS id, CASE WHEN k % 3 = 0 THEN [k, k + 1, k + 2, k + 3]::DOUBLE[] WHEN k % 3 = 1 THEN [k - 0.02, k + 1 - 0.02, k + 0.02, k + 1 + 0.02]::DOUBLE[] END AS box FROM range(30) t(k)""")
def bbox_parse(spark, d):
    k = F.col("id").cast("string")
    plus = lambda i: (F.col("id") + i).cast("string")
    text = F.when(F.col("id") % 3 == 0, F.concat_ws(", ", k, plus(1), plus(2), plus(3))).when(F.col("id") % 3 == 1, F.concat_ws(" ", k, plus(1))).otherwise(F.lit("1,2,x"))
    return spark.range(30).select("id", F.transform(strings.box_or_point(text), lambda v: F.round(v, 6)).alias("box"))


# ---- filters, bags and columns of detections


@query(with_tables("detections", "SELECT image_id, det_id FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY det_id) AS k FROM detections WHERE cls >= 0 AND cls < 3) WHERE k <= 100"))
def class_range(spark, d):
    return det.in_classes(a.detections(spark, d), 3, most=100).select("image_id", "det_id")


def _outputs(spark, d) -> DataFrame:
    """Raw detector outputs: centre, size, objectness and a score for each of three classes."""
    k, c = F.col("det_id"), F.col("conf")
    return a.detections(spark, d).select(
        "image_id", "det_id", ((F.col("x1") + F.col("x2")) / 2).alias("cx"), ((F.col("y1") + F.col("y2")) / 2).alias("cy"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"), c.alias("obj"),
        F.array(*(((k * m % 101) / F.lit(100.0)) for m in (7, 13, 29))).alias("scores"),
    )


_SCORED = "outputs AS (SELECT *, [conf * ((det_id * 7 % 101) / 100.0::DOUBLE), conf * ((det_id * 13 % 101) / 100.0::DOUBLE), conf * ((det_id * 29 % 101) / 100.0::DOUBLE)] AS s FROM detections WHERE conf > 0.25::DOUBLE)"


@query(with_tables("detections", f"""-- more
{_SCORED}, b AS (SELECT *, list_max(s) AS best, list_position(s, list_max(s)) - 1 AS c FROM outputs)
SELECT image_id, det_id, c::BIGINT AS cls, round(best, 6) AS conf, x1, y1, x2, y2 FROM b WHERE best > 0.25::DOUBLE AND c IN (0, 2)"""))
def best_candidates(spark, d):
    out = det.candidates(_outputs(spark, d), 0.25, [0, 2])
    return out.select("image_id", "det_id", n("cls").alias("cls"), r(F.col("conf"), 6).alias("conf"), *bx.Box._fields)


@query(with_tables("detections", f"""-- more
{_SCORED}, b AS (SELECT image_id, det_id, unnest(s) AS conf, generate_subscripts(s, 1) - 1 AS cls FROM outputs)
SELECT image_id, det_id, cls::BIGINT AS cls, round(conf, 6) AS conf FROM b WHERE conf > 0.25::DOUBLE"""))
def all_candidates(spark, d):
    out = det.candidates(_outputs(spark, d), 0.25, multi_label=True)
    return out.select("image_id", "det_id", n("cls").alias("cls"), r(F.col("conf"), 6).alias("conf"))


@query(with_tables("detections", "SELECT * FROM (SELECT 0::BIGINT AS source, image_id, det_id FROM detections WHERE cls < 2 UNION ALL SELECT 1, image_id, det_id FROM detections WHERE conf > 0.5::DOUBLE UNION ALL SELECT 2, image_id, det_id FROM detections)"))
def pooled_predictions(spark, d):
    rows = a.detections(spark, d).select("image_id", "det_id", "cls", "conf")
    return det.pooled(rows.where("cls < 2"), rows.where("conf > 0.5D"), rows).select("source", "image_id", "det_id")


@query(with_tables("facilities confirmed", _CENTRES + "SELECT coalesce(f.id, o.id) AS id, round(f.lon, 6) AS lon, o.id AS other FROM f FULL JOIN (SELECT id + 100 AS id FROM k) o ON o.id = f.id"))
def joined_columns(spark, d):
    f = pipe.centres(a.facilities(spark, d)).select("id", r(F.col("lon"), 6).alias("lon"))
    k = pipe.centres(a.confirmed(spark, d)).select((F.col("id") + 100).alias("id"), (F.col("id") + 100).alias("other"))
    return det.beside(f, k, "id").select("id", "lon", "other")


@query(with_tables("detections", "SELECT image_id, list(det_id ORDER BY det_id DESC)[1]::BIGINT AS first, count(*)::BIGINT AS n FROM detections GROUP BY 1"))
def reversed_detections(spark, d):
    rows = det.reversed_order(a.detections(spark, d).select("image_id", "det_id"))
    placed = rows.withColumn("k", F.row_number().over(Window.partitionBy("image_id").orderBy(F.col("det_id").desc())))
    return placed.groupBy("image_id").agg(F.min_by("det_id", "k").alias("first"), F.count("*").alias("n"))


@query(with_tables("pings", "SELECT DISTINCT mmsi, kind FROM pings"))
def unique_ships(spark, d):
    return lookup.unique(a.pings(spark, d), "mmsi", "kind")


@query(with_tables("detections scene", """SELECT image_id AS image, x1 AS X, y1 AS Y, x2 - x1 AS W, y2 - y1 AS H, round(min_lon + dlon * ((x1 + x2) / 2), 8) AS Lon, round(max_lat + dlat * ((y1 + y2) / 2), 8) AS Lat FROM detections, scene WHERE image_id = scene_id"""))
def ships_of(spark, d):
    out = pipe.ships_of(a.detections(spark, d), a.scene(spark))
    return out.select("image", "X", "Y", "W", "H", r(F.col("Lon"), 8).alias("Lon"), r(F.col("Lat"), 8).alias("Lat"))


_TILED = """-- more
raw AS (SELECT image_id % 3 AS image_id, image_id AS tile_id, det_id, x1, y1, x2 + 60 AS x2, y2 + 60 AS y2, conf, [conf * ((det_id * 7 % 101) / 100.0::DOUBLE), conf * ((det_id * 13 % 101) / 100.0::DOUBLE), conf * ((det_id * 29 % 101) / 100.0::DOUBLE)] AS s FROM detections WHERE conf > 0.25::DOUBLE),
cand AS (SELECT image_id, tile_id, det_id, x1, y1, x2, y2, list_max(s) AS conf, list_position(s, list_max(s)) - 1 AS cls FROM raw),
o AS (SELECT *, row_number() OVER (PARTITION BY tile_id, cls ORDER BY conf DESC, det_id) AS k FROM cand WHERE conf > 0.25::DOUBLE),
beats AS (SELECT b.tile_id, b.cls, b.k, list(a.k) AS stronger FROM o a JOIN o b ON a.tile_id = b.tile_id AND a.cls = b.cls AND a.k < b.k AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2
  WHERE (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)) / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1))) > 0.3::DOUBLE GROUP BY 1, 2, 3),
walk AS (SELECT tile_id, cls, 1::BIGINT AS k, [1::BIGINT] AS kept FROM o WHERE k = 1
  UNION ALL SELECT w.tile_id, w.cls, o.k, CASE WHEN coalesce(list_has_any(w.kept, s.stronger), false) THEN w.kept ELSE list_append(w.kept, o.k) END
  FROM walk w JOIN o ON o.tile_id = w.tile_id AND o.cls = w.cls AND o.k = w.k + 1 LEFT JOIN beats s ON s.tile_id = o.tile_id AND s.cls = o.cls AND s.k = o.k),
ends AS (SELECT tile_id, cls, unnest(arg_max(kept, k)) AS k FROM walk GROUP BY 1, 2),
kept AS (SELECT o.* FROM o JOIN ends USING (tile_id, cls, k) QUALIFY row_number() OVER (PARTITION BY o.image_id, o.tile_id ORDER BY o.conf DESC, o.det_id) <= 300),
placed AS (SELECT kept.image_id, kept.cls, kept.x1 + kept.tile_id * 10 AS x1, kept.y1 + 20 AS y1, kept.x2 + kept.tile_id * 10 AS x2, kept.y2 + 20 AS y2 FROM kept)
SELECT image_id, round(max_lat + dlat * y2, 8) AS LatMin, round(min_lon + dlon * x1, 8) AS LonMin, round(max_lat + dlat * y1, 8) AS LatMax, round(min_lon + dlon * x2, 8) AS LonMax, ['buoy', 'farm', 'cage'][cls + 1] AS Class FROM placed, scene"""


@query(with_tables("detections scene", _TILED).replace("WITH ", "WITH RECURSIVE ", 1))
def facilities_of(spark, d):
    """Raw outputs of tiles to facility boxes: candidates, suppression by tile and class, placing in the scene, degrees."""
    raw = _outputs(spark, d).withColumns({"tile_id": F.col("image_id"), "x0": F.col("image_id") * 10.0, "y0": F.lit(20.0), "w": F.col("w") + 60, "h": F.col("h") + 60, "cx": F.col("cx") + 30, "cy": F.col("cy") + 30}).withColumn("image_id", F.col("image_id") % 3)
    scenes = a.scene(spark).drop("scene_id").crossJoin(F.broadcast(spark.range(3).withColumnRenamed("id", "scene_id")))  # one scene, three names
    out = pipe.facilities_of(raw, scenes, {0: "buoy", 1: "farm", 2: "cage"}, detector=config.Detector(conf=0.25))
    return out.select("image_id", *(r(F.col(c), 8).alias(c) for c in ("LatMin", "LonMin", "LatMax", "LonMax")), "Class")


# ---- sources and sinks: written to the shared folder and read back


def _at(spark, name: str) -> str:
    import uuid

    from ..shared import folder

    return f"{folder(spark)}/files/{name}-{uuid.uuid4().hex}"


@query(with_tables("pings", "SELECT mmsi, epoch, lon, lat, sog, cog, name, kind, destination, dim_a, dim_b, dim_c, dim_d FROM pings"))
def reports_csv(spark, d):
    """Position reports out to CSV and in again, with the product's headers."""
    date, time = strings.date_and_time(F.col("epoch"))
    rows = a.pings(spark, d).select(
        F.col("mmsi").alias("MMSI"), date.alias("Date"), time.alias("Time"), F.col("lon").alias("Lon"), F.col("lat").alias("Lat"), F.col("sog").alias("SOG"), F.col("cog").alias("COG"), F.col("name").alias("VesselName"),
        F.col("kind").alias("VesselType"), *(F.col(f"dim_{c.lower()}").alias(f"Dim{c}") for c in "ABCD"), F.lit("ok").alias("Status"), F.col("destination").alias("ToPortof"),
    )
    tables.to_csv(rows, at := _at(spark, "reports"), one_file=False)
    return tables.reports(spark, at).drop("seq", "status")


@query(with_tables("facilities ships", "SELECT 'facility' AS kind, LatMin AS a, LonMin AS b, LatMax AS c, LonMax AS d FROM facilities UNION ALL SELECT 'ship', X, Y, Lon, Lat FROM ships"))
def boxes_csv(spark, d):
    """Facility boxes and ships out to CSV and in again; the ships' file calls its image imageName."""
    tables.to_csv(a.facilities(spark, d).drop("id").withColumn("Class", F.lit("farm")), one := _at(spark, "facilities"))
    tables.to_csv(a.ships(spark, d).drop("id").withColumn("imageName", F.lit("scene.tif")), two := _at(spark, "ships"))
    four = lambda df, kind, *c: df.select(F.lit(kind).alias("kind"), *(F.col(x).cast("double").alias(y) for x, y in zip(c, "abcd", strict=True)))
    return four(tables.facilities(spark, one).where("Class = 'farm'"), "facility", "LatMin", "LonMin", "LatMax", "LonMax").union(four(tables.ships(spark, two).where("image = 'scene.tif'"), "ship", "X", "Y", "Lon", "Lat"))


@query("SELECT c_custkey::VARCHAR AS key, c_name AS name, c_acctbal::DOUBLE AS balance FROM customer")
def csv_as_json(spark, d):
    """A table out to CSV, that to JSON with all values as text, and in again."""
    tables.to_csv(a.table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")), one := _at(spark, "customers"))
    tables.csv_to_json(spark, one, two := _at(spark, "customers-json"))
    raw = spark.read.json(two)
    assert {kind for _, kind in raw.dtypes} == {"string"}
    return raw.select("key", "name", F.col("balance").cast("double").alias("balance"))


@query(with_tables("facilities", "SELECT id, round(0.5 * (LonMin + LonMax), 6) AS lon, round(0.5 * (LatMin + LatMax), 6) AS lat FROM facilities"))
def results_json(spark, d):
    tables.to_json(pipe.centres(a.facilities(spark, d)).select("id", r(F.col("lon"), 6).alias("lon"), r(F.col("lat"), 6).alias("lat")), at := _at(spark, "results"))
    return spark.read.schema("id long, lon double, lat double").json(at)


@query(with_tables("pixels", "SELECT scene_id::VARCHAR AS scene_id, row::INTEGER AS row, col::INTEGER AS col, vv::FLOAT::DOUBLE AS b1, vh::FLOAT::DOUBLE AS b2 FROM pixels WHERE vv IS NOT NULL"))
def geotiff_pixels(spark, d):
    """Two bands of each scene as the bytes of a GeoTIFF, in strips, and read again; places without a pixel have the no-data value."""
    rows = a.pixels(spark, d).select(F.col("scene_id").cast("string").alias("scene_id"), "row", "col", "vv", "vh")
    return geotiff.decoded(geotiff.images(rows, ["vv", "vh"]), bands=2).where("b1 is not null")


@query(with_tables("detections", "SELECT 'i' || image_id || '.tif' AS image, x1::INTEGER AS x1, y1::INTEGER AS y1, x2::INTEGER AS x2, y2::INTEGER AS y2, cls FROM detections"))
def label_text(spark, d):
    """Label lines, a line an image, out to text and in again."""
    box = F.concat_ws(",", *(F.col(c).cast("int") for c in (*bx.Box._fields, "cls")))
    lines = a.detections(spark, d).groupBy("image_id").agg(F.concat_ws(" ", F.collect_list(box)).alias("boxes")).select(F.concat(F.lit("i"), "image_id", F.lit(".tif "), "boxes").alias("value"))
    lines.write.text(at := _at(spark, "labels"))
    return tables.label_lines(spark, at)


@query("SELECT 'R' || n_nationkey AS roi_id, '2024010' || (n_nationkey % 9 + 1) || '000000' AS timestamp FROM nation UNION ALL SELECT 'Unknown', 'Unknown'")
def region_files(spark, d):
    """Region files, one a region, and one that doesn't parse."""
    at = _at(spark, "regions")
    k = F.col("n_nationkey")
    named = a.table(spark, d, "nation").select(k.alias("part"), F.to_json(F.struct(F.concat(F.lit("R"), k).alias("ROI_ID"), F.concat(F.lit("2024010"), k % 9 + 1, F.lit("000000")).alias("Timestamp"))).alias("value"))
    broken = spark.range(1).select(F.lit(-1).alias("part"), F.lit("{not json").alias("value"))
    named.union(broken).write.partitionBy("part").text(at)
    return tables.roi(spark, f"{at}/*").drop("file")


@query(with_tables("pixels", "SELECT scene_id, count(*) AS n, round(sum(vv), 4) AS total FROM pixels GROUP BY 1 UNION ALL SELECT -1, 12, 480.0::DOUBLE"))
def saved_product(spark, d):
    """A product's tables saved and loaded: pixels, and the nodes of an axis cut to the image and one more on either side."""
    nodes = spark.range(100).select(F.lit(0).cast("long").alias("scene_id"), (F.floor(F.col("id") / 10) * 40).alias("node_row"), (F.col("id") % 10 * 40).alias("node_col"))
    products.save(at := _at(spark, "product"), pixels=a.pixels(spark, d), nodes=products.cropped_nodes(nodes, 60, 100))
    got = products.load(spark, at, "pixels", "nodes")
    n_total = got["pixels"].groupBy("scene_id").agg(F.count("*").alias("n"), r(F.sum("vv")).alias("total"))
    grid = got["nodes"].groupBy(F.lit(-1).cast("long").alias("scene_id")).agg(F.count("*").alias("n"), F.sum(F.col("node_row")).cast("double").alias("total"))
    return n_total.union(grid)


# ---- kernels and whole flows

_NMS = """-- more
crowded AS (SELECT * REPLACE (x2 + 60 AS x2, y2 + 60 AS y2) FROM detections),
o AS (SELECT *, row_number() OVER (PARTITION BY image_id, cls ORDER BY conf DESC, det_id) AS k FROM crowded),
beats AS (SELECT b.image_id, b.cls, b.k, list(a.k) AS stronger FROM o a JOIN o b ON a.image_id = b.image_id AND a.cls = b.cls AND a.k < b.k AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2
  WHERE (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)) / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1))) > 0.3::DOUBLE GROUP BY 1, 2, 3),
walk AS (SELECT image_id, cls, 1::BIGINT AS k, [1::BIGINT] AS kept FROM o WHERE k = 1
  UNION ALL SELECT w.image_id, w.cls, o.k, CASE WHEN coalesce(list_has_any(w.kept, s.stronger), false) THEN w.kept ELSE list_append(w.kept, o.k) END
  FROM walk w JOIN o ON o.image_id = w.image_id AND o.cls = w.cls AND o.k = w.k + 1 LEFT JOIN beats s ON s.image_id = o.image_id AND s.cls = o.cls AND s.k = o.k),
ends AS (SELECT image_id, cls, unnest(arg_max(kept, k)) AS k FROM walk GROUP BY 1, 2)
SELECT image_id, det_id, cls::BIGINT AS cls FROM ends JOIN o USING (image_id, cls, k)"""


def _crowded(spark, d) -> DataFrame:
    """Boxes large enough to overlap others of their class."""
    return a.detections(spark, d).withColumns({"x2": F.col("x2") + 60, "y2": F.col("y2") + 60})


@query(with_tables("detections", _NMS + " QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, det_id) <= 300").replace("WITH ", "WITH RECURSIVE ", 1))
def nms_greedy(spark, d):
    return det.suppressed(_crowded(spark, d)).select("image_id", "det_id", n("cls").alias("cls"))


@query(with_tables("detections", _NMS).replace("WITH ", "WITH RECURSIVE ", 1))
def nms_unbounded(spark, d):
    """Suppression with no bound on the boxes that go in or come out."""
    return det.suppressed(_crowded(spark, d), most_in=None, most_out=None).select("image_id", "det_id", n("cls").alias("cls"))


#: The smallest number of a blob walks from pixel to pixel until it has reached all of them.
_BLOBS = """run(scene_id, row, col, blob) USING KEY (scene_id, row, col) AS (SELECT scene_id, row, col, row * 4294967296 + col FROM flags
  UNION SELECT scene_id, row, col, min(blob) FROM (SELECT f.scene_id, f.row, f.col, w.blob FROM run w, range(-1, 2) s(i), range(-1, 2) t(j), recurring.run f
    WHERE f.scene_id = w.scene_id AND f.row = w.row + i AND f.col = w.col + j AND w.blob < f.blob) GROUP BY 1, 2, 3)"""


@query(with_tables("pixels", f"-- more\nflags AS (SELECT scene_id, row, col FROM pixels WHERE qa < 40), {_BLOBS} SELECT scene_id, blob, count(*) AS n FROM run GROUP BY 1, 2").replace("WITH ", "WITH RECURSIVE ", 1))
def components(spark, d):
    flags = a.pixels(spark, d).where("qa < 40").select("scene_id", "row", "col")
    return raster.components(flags, tile=64).groupBy("scene_id", "blob").agg(F.count("*").alias("n"))


def _chi2(x: str) -> str:
    """Chi-squared of 500 degrees of freedom, an even number: a finite sum."""
    return f"(CASE WHEN {x} = 0 THEN 0 WHEN {x} > 0 THEN 1 - list_sum(list_transform(range(250), lambda i: exp(-({x}) / 2 + i * ln(({x}) / 2) - lgamma(i + 1.0::DOUBLE)))) END)"


_FLAGGED = f"""-- more
f AS (SELECT scene_id, avg(vv / nullif(vv2, 0)) * 4.4::DOUBLE * 4.4::DOUBLE AS f FROM pixels GROUP BY 1),
beta AS (SELECT scene_id, 10 * f AS p, 2 * f AS q, k / 200000.0::DOUBLE AS z FROM f, range(1, 200000) t(k)),
steps AS (SELECT scene_id, p, q, z, sum(exp((p - 1) * ln(z) + (q - 1) * ln(1 - z) + lgamma(p + q) - lgamma(p) - lgamma(q))) OVER (PARTITION BY scene_id ORDER BY z) / 200000 AS cdf FROM beta),
level AS (SELECT scene_id, arg_min(q * z / (p * (1 - z)), z) / 10 AS level FROM steps WHERE cdf >= 0.001::DOUBLE GROUP BY 1),
scored AS (SELECT scene_id, row, col, {_GAP} AS x, level FROM pixels LEFT JOIN level USING (scene_id)),
judged AS (SELECT scene_id, row, col, coalesce({_chi2('x')} < level, false) AS flag FROM scored),
flags AS (SELECT scene_id, row, col FROM judged WHERE flag), {_BLOBS},
big AS (SELECT scene_id, blob FROM run GROUP BY 1, 2 HAVING count(*) >= 30)
SELECT j.scene_id, j.row, j.col, j.flag, (CASE WHEN big.blob IS NULL THEN 1 ELSE 0 END)::BIGINT AS written_mask FROM judged j LEFT JOIN run USING (scene_id, row, col) LEFT JOIN big ON big.scene_id = run.scene_id AND big.blob = run.blob"""


@query(with_tables("pixels", _FLAGGED).replace("WITH ", "WITH RECURSIVE ", 1))
def change_mask(spark, d):
    return pipe.change_mask(a.pixels(spark, d)).select("scene_id", "row", "col", "flag", n("written_mask").alias("written_mask"))


# the second raster is the first one, moved by a row and two columns: that is what alignment has to find


@query("SELECT 0::BIGINT AS scene_id, (o_orderkey // 4096)::BIGINT AS patch_row, (o_orderkey % 128 // 32)::BIGINT AS patch_col, 1.0::DOUBLE AS shift_row, 2.0::DOUBLE AS shift_col FROM orders GROUP BY 1, 2, 3 HAVING count(*) = 1024")
def phase_shift(spark, d):
    out = alignment.patch_shifts(a.dense(spark, d), "first", "second", patch=32, upsample=10)
    return out.select("scene_id", "patch_row", "patch_col", r(F.col("shift_row"), 1).alias("shift_row"), r(F.col("shift_col"), 1).alias("shift_col"))


@query("SELECT 0::BIGINT AS scene_id, 1.0::DOUBLE AS shift_row, 2.0::DOUBLE AS shift_col FROM (SELECT 1 FROM orders GROUP BY o_orderkey // 2048, o_orderkey % 128 // 16 HAVING count(*) = 256) HAVING count(*) > 0")
def scene_shift(spark, d):
    out = alignment.scene_shift(alignment.patch_shifts(a.dense(spark, d), "first", "second", patch=16, upsample=10), degree=2)
    return out.select("scene_id", r(F.col("shift_row"), 1).alias("shift_row"), r(F.col("shift_col"), 1).alias("shift_col"))


@query(with_tables("pixels", """-- more
w AS (SELECT k, exp(-0.5::DOUBLE * k * k) / (SELECT sum(exp(-0.5::DOUBLE * j * j)) FROM range(-4, 5) t(j)) AS w FROM range(-4, 5) u(k)),
h AS (SELECT p.scene_id, p.row, p.col, CASE WHEN count(q.vv) = 9 THEN sum(q.vv * w) END AS s FROM pixels p CROSS JOIN w LEFT JOIN pixels q ON q.scene_id = p.scene_id AND q.row = p.row + k AND q.col = p.col GROUP BY 1, 2, 3)
SELECT p.scene_id, p.row, p.col, round(CASE WHEN count(q.s) = 9 THEN sum(q.s * w) END, 6) AS smooth FROM h p CROSS JOIN w LEFT JOIN h q ON q.scene_id = p.scene_id AND q.row = p.row AND q.col = p.col + k GROUP BY 1, 2, 3"""))
def gaussian_smooth(spark, d):
    out = raster.by_tile(a.pixels(spark, d), "vv", lambda x: kernels.gaussian(x, 1.0), reach=5, tile=64)
    return out.select("scene_id", "row", "col", r(F.when(~F.isnan("out"), F.col("out")), 6).alias("smooth"))


@query(with_tables("pixels", """-- more
m AS (SELECT scene_id, row + i AS row, col + j AS col, median(b5 * 2) AS m FROM pixels, range(-2, 3) s(i), range(-2, 3) t(j) GROUP BY 1, 2, 3)
SELECT p.scene_id, p.row, p.col, (min(m) > 60)::INTEGER::DOUBLE AS shore FROM pixels p JOIN m ON m.scene_id = p.scene_id AND m.col = p.col AND m.row BETWEEN p.row - 5 AND p.row GROUP BY 1, 2, 3"""))
def shore_mask(spark, d):
    rows = a.pixels(spark, d).withColumn("v", F.col("b5") * 2.0)
    return raster.by_tile(rows, "v", lambda x: kernels.shore(x, level=60.0), reach=16, tile=64, out="shore")


@query(with_tables("pixels", f"-- more\nx AS (SELECT scene_id, row, col, 100 * {_GAP} AS x FROM pixels) SELECT scene_id, row, col, round({_chi2('x')}, 6) + 0.0::DOUBLE AS p FROM x"))
def chi2_p_value(spark, d):
    rows = a.pixels(spark, d).select("scene_id", "row", "col", rad.log_ratio((F.col("vh"), F.col("vv")), (F.col("vh2"), F.col("vv2"))).alias("x"))
    return rows.select("scene_id", "row", "col", r(statistics.chi2_cdf(F.col("x") * 100, 500.0), 6).alias("p"))


_ELLIPSOID = "1 / 298.257223563::DOUBLE"


@query(with_tables("facilities confirmed", _CENTRES + f""",
g AS (SELECT f.id, radians(k.lon - f.lon) AS l, atan((1 - {_ELLIPSOID}) * tan(radians(f.lat))) AS u, atan((1 - {_ELLIPSOID}) * tan(radians(k.lat))) AS v FROM f JOIN k ON k.id = f.id % 50),
it AS (SELECT id, l, u, v, l AS lam, 0 AS n FROM g
  UNION ALL SELECT id, l, u, v, l + (1 - c) * f * sa * (sg + c * ss * (m + c * cs * (2 * m * m - 1))), n + 1 FROM (SELECT *, f / 16 * ca * (4 + f * (4 - 3 * ca)) AS c FROM (
    SELECT *, {_ELLIPSOID} AS f, CASE WHEN ca = 0 THEN 0 ELSE cs - 2 * sin(u) * sin(v) / ca END AS m FROM (SELECT *, 1 - sa * sa AS ca FROM (SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cos(u) * cos(v) * sin(lam) / ss END AS sa, atan2(ss, cs) AS sg FROM (
      SELECT *, sqrt(pow(cos(v) * sin(lam), 2) + pow(cos(u) * sin(v) - sin(u) * cos(v) * cos(lam), 2)) AS ss, sin(u) * sin(v) + cos(u) * cos(v) * cos(lam) AS cs FROM it WHERE n < 12)))))),
z AS (SELECT *, CASE WHEN ca = 0 THEN 0 ELSE cs - 2 * sin(u) * sin(v) / ca END AS m, ca * (1 / pow(1 - {_ELLIPSOID}, 2) - 1) AS w FROM (SELECT *, 1 - sa * sa AS ca FROM (SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cos(u) * cos(v) * sin(lam) / ss END AS sa, atan2(ss, cs) AS sg FROM (
  SELECT *, sqrt(pow(cos(v) * sin(lam), 2) + pow(cos(u) * sin(v) - sin(u) * cos(v) * cos(lam), 2)) AS ss, sin(u) * sin(v) + cos(u) * cos(v) * cos(lam) AS cs FROM it WHERE n = 12)))),
y AS (SELECT *, 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))) AS big, w / 1024 * (256 + w * (-128 + w * (74 - 47 * w))) AS small FROM z)
SELECT id, round(CASE WHEN ss = 0 THEN 0 ELSE 6378137 * (1 - {_ELLIPSOID}) * big * (sg - small * ss * (m + small / 4 * (cs * (2 * m * m - 1) - small / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3)))) END, 3) AS metres FROM y""").replace("WITH ", "WITH RECURSIVE ", 1))
def geodesic(spark, d):
    f, k = pipe.centres(a.facilities(spark, d)), pipe.centres(a.confirmed(spark, d))
    rows = f.alias("f").join(k.alias("k"), F.col("k.id") == F.col("f.id") % 50)
    return rows.select("f.id", r(geo.geodesic_m(F.col("f.lat"), F.col("f.lon"), F.col("k.lat"), F.col("k.lon")), 3).alias("metres"))


@query(with_tables("pixels", """-- more
x AS (SELECT scene_id, (col - 64) / 64.0::DOUBLE AS x, b5 AS y FROM pixels),
s AS (SELECT scene_id, count(*) AS s0, sum(x) AS s1, sum(pow(x, 2)) AS s2, sum(pow(x, 3)) AS s3, sum(pow(x, 4)) AS s4, sum(pow(x, 5)) AS s5, sum(pow(x, 6)) AS s6, sum(y) AS t0, sum(x * y) AS t1, sum(pow(x, 2) * y) AS t2, sum(pow(x, 3) * y) AS t3 FROM x GROUP BY 1),
a1 AS (SELECT *, sqrt(s0) AS l11 FROM s), a2 AS (SELECT *, s1 / l11 AS l21, s2 / l11 AS l31, s3 / l11 AS l41 FROM a1), a3 AS (SELECT *, sqrt(s2 - l21 * l21) AS l22 FROM a2),
a4 AS (SELECT *, (s3 - l31 * l21) / l22 AS l32, (s4 - l41 * l21) / l22 AS l42 FROM a3), a5 AS (SELECT *, sqrt(s4 - l31 * l31 - l32 * l32) AS l33 FROM a4), a6 AS (SELECT *, (s5 - l41 * l31 - l42 * l32) / l33 AS l43 FROM a5),
a7 AS (SELECT *, sqrt(s6 - l41 * l41 - l42 * l42 - l43 * l43) AS l44, t0 / l11 AS y1 FROM a6), a8 AS (SELECT *, (t1 - l21 * y1) / l22 AS y2 FROM a7), a9 AS (SELECT *, (t2 - l31 * y1 - l32 * y2) / l33 AS y3 FROM a8),
b3 AS (SELECT *, (t3 - l41 * y1 - l42 * y2 - l43 * y3) / l44 / l44 AS c3 FROM a9), b2 AS (SELECT *, (y3 - l43 * c3) / l33 AS c2 FROM b3), b1 AS (SELECT *, (y2 - l32 * c2 - l42 * c3) / l22 AS c1 FROM b2)
SELECT scene_id, round((y1 - l21 * c1 - l31 * c2 - l41 * c3) / l11, 6) + 0.0::DOUBLE AS c0, round(c1, 6) + 0.0::DOUBLE AS c1, round(c2, 6) + 0.0::DOUBLE AS c2, round(c3, 6) + 0.0::DOUBLE AS c3 FROM b1"""))
def shift_polynomial(spark, d):
    rows = a.pixels(spark, d).withColumn("x", (F.col("col") - 64) / 64)
    return lookup.polynomial(rows, ["scene_id"], "x", "b5", 3).select("scene_id", *(r(F.col(f"c{k}"), 6).alias(f"c{k}") for k in range(4)))
