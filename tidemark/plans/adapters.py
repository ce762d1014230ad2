"""The engine's tables made from the driver's star schema, once as DataFrames and once as SQL for the oracle.

Positions come from whole-number arithmetic on keys, with other multipliers for each table, so both engines see the same doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LON, LAT = 126.0, 34.0
#: 2024-01-10 00:00:00 and 2024-01-12 00:00:00 UTC: the span in which the scene is seen.
START_S, END_S = 1_704_844_800.0, 1_705_017_600.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(key: Column, factor: int, modulus: int, low: float, width: float) -> Column:
    """A value between low and low + width from a key."""
    return F.lit(low) + (key * factor % modulus) / F.lit(float(modulus)) * F.lit(width)


def _spread_sql(key: str, factor: int, modulus: int, low: float, width: float) -> str:
    return f"({low} + ({key} * {factor} % {modulus}) / {float(modulus)}::DOUBLE * {width}::DOUBLE)"


def _boxes(df: DataFrame, key: str, size: Column, lon: tuple[int, int], lat: tuple[int, int]) -> DataFrame:
    k = F.col(key)
    rows = df.select(k.cast("long").alias("id"), spread(k, *lon, LON, 0.5).alias("lon"), spread(k, *lat, LAT, 0.5).alias("lat"), (size * F.lit(0.0001)).alias("half"))
    return rows.select("id", (F.col("lat") - F.col("half")).alias("LatMin"), (F.col("lon") - F.col("half")).alias("LonMin"), (F.col("lat") + F.col("half")).alias("LatMax"), (F.col("lon") + F.col("half")).alias("LonMax"))


def _boxes_sql(name: str, source: str, key: str, size: str, lon: tuple[int, int], lat: tuple[int, int]) -> str:
    return f"""{name}_c AS (SELECT {key}::BIGINT AS id, {_spread_sql(key, *lon, LON, 0.5)} AS lon, {_spread_sql(key, *lat, LAT, 0.5)} AS lat, {size} * 0.0001::DOUBLE AS half FROM {source}),
{name} AS (SELECT id, lat - half AS LatMin, lon - half AS LonMin, lat + half AS LatMax, lon + half AS LonMax FROM {name}_c)"""


def facilities(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of detected facilities."""
    return _boxes(table(spark, d, "part"), "p_partkey", F.col("p_size").cast("double"), (7919, 10007), (104729, 10009))


def confirmed(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of known facilities."""
    return _boxes(table(spark, d, "supplier"), "s_suppkey", (F.col("s_suppkey") % 9 + 3).cast("double"), (6007, 9973), (5003, 9967))


def ships(spark: SparkSession, d: str) -> DataFrame:
    """Detected ships."""
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.cast("long").alias("id"), (k * 37 % 500).cast("long").alias("X"), (k * 53 % 500).cast("long").alias("Y"), (k % 7 + 5).cast("long").alias("W"), (k % 11 + 5).cast("long").alias("H"), spread(k, 4001, 9949, LON, 0.5).alias("Lon"), spread(k, 3001, 9941, LAT, 0.5).alias("Lat"))


def pings(spark: SparkSession, d: str) -> DataFrame:
    """Position reports, some outside the scene."""
    e, u = F.col("event_id"), F.col("user_id")
    epoch = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("double")
    return table(spark, d, "events").select(
        e.cast("long").alias("seq"), u.cast("long").alias("mmsi"), epoch.alias("epoch"), spread(u * 331 + e * 17, 1, 9973, LON - 0.05, 0.6).alias("lon"), spread(u * 211 + e * 13, 1, 9967, LAT - 0.05, 0.6).alias("lat"),
        (e * 7 % 30).cast("double").alias("sog"), (e * 37 % 360).cast("double").alias("cog"), F.concat(F.lit("V"), u % 40).alias("name"), F.col("event_type").alias("kind"), F.concat(F.lit("P"), e % 9).alias("destination"),
        (u % 50 + e % 3).cast("double").alias("dim_a"), (u % 40).cast("double").alias("dim_b"), (u % 9).cast("double").alias("dim_c"), (u % 7).cast("double").alias("dim_d"),
    )


def scene(spark: SparkSession) -> DataFrame:
    """One radar scene of 501 by 501 pixels."""
    return spark.sql(f"SELECT 0L AS scene_id, {LON}D AS min_lon, 0.001D AS dlon, {LON + 0.5}D AS max_lon, {LAT + 0.5}D AS max_lat, {LAT}D AS min_lat, -0.001D AS dlat, 501 AS xsize, 501 AS ysize, {START_S}D AS start_s, {END_S}D AS end_s, true AS ascending")


def zones(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping triangles in degrees, numbered by region key (0 among them)."""
    r = F.col("r_regionkey")
    at = lambda dx, y: F.struct((F.lit(LON) + 0.08 * r + F.lit(dx)).alias("x"), F.lit(y).alias("y"))
    return table(spark, d, "region").select(r.cast("int").alias("zone_ord"), r.cast("int").alias("zone_no"), F.array(F.array(at(0.0, 34.0), at(0.2, 34.05), at(0.1, 34.45))).alias("rings"))


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """Seven rasters of order keys, 128 columns wide, with bands, a quality word, and some missing pixels."""
    k = F.col("l_orderkey")
    rows = table(spark, d, "lineitem").groupBy("l_linenumber", "l_orderkey").agg(F.max("l_quantity").alias("q1"), F.min("l_quantity").alias("q0"), F.max("l_extendedprice").alias("p1"), F.max("l_partkey").alias("part"), F.max("l_suppkey").alias("supp"))
    return rows.select(
        F.col("l_linenumber").cast("long").alias("scene_id"), F.floor(k / 128).cast("long").alias("row"), (k % 128).cast("long").alias("col"),
        (F.col("q1") + 10).alias("b4"), (F.col("part") % 97 + 1).cast("double").alias("b5"), (F.col("p1") + 20000).alias("b10"), (F.col("part") % 64).cast("long").alias("qa"),
        F.when(F.col("part") % 13 != 0, F.col("q1") / 100).alias("vh"), ((F.col("supp") % 50 + 1) / 100).alias("vv"), (F.col("q0") / 50).alias("vh2"), ((F.col("part") % 50 + 1) / 90).alias("vv2"),
    )


def dense(spark: SparkSession, d: str) -> DataFrame:
    """One raster without gaps, 128 columns wide, and the same one moved by a row and two columns."""
    k = F.col("o_orderkey")
    value = lambda c: (c * c * 31 + c * 7919) % 1009
    return table(spark, d, "orders").select(F.lit(0).cast("long").alias("scene_id"), F.floor(k / 128).cast("long").alias("row"), (k % 128).cast("long").alias("col"), value(k).cast("double").alias("first"), value(k + 130).cast("double").alias("second"))


def detections(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of five classes, some 500 an image."""
    k = F.col("o_orderkey")
    x, y = (k * 37 % 600).cast("double"), (k * 53 % 600).cast("double")
    return table(spark, d, "orders").select(
        F.floor(k / 500).cast("long").alias("image_id"), k.cast("long").alias("det_id"), x.alias("x1"), y.alias("y1"), (x + 10 + k % 50).alias("x2"), (y + 8 + k * 7 % 40).alias("y2"),
        ((k * 7919 % 10007) / F.lit(10007.0)).alias("conf"), (k % 5).cast("int").alias("cls"),
    )


SQL = {
    "facilities": _boxes_sql("facilities", "part", "p_partkey", "p_size::DOUBLE", (7919, 10007), (104729, 10009)),
    "confirmed": _boxes_sql("confirmed", "supplier", "s_suppkey", "(s_suppkey % 9 + 3)::DOUBLE", (6007, 9973), (5003, 9967)),
    "ships": f"""ships AS (SELECT c_custkey::BIGINT AS id, c_custkey * 37 % 500 AS X, c_custkey * 53 % 500 AS Y, c_custkey % 7 + 5 AS W, c_custkey % 11 + 5 AS H,
  {_spread_sql("c_custkey", 4001, 9949, LON, 0.5)} AS Lon, {_spread_sql("c_custkey", 3001, 9941, LAT, 0.5)} AS Lat FROM customer)""",
    "pings": f"""pings AS (SELECT event_id::BIGINT AS seq, user_id::BIGINT AS mmsi, floor(epoch_us(ts) / 1000000)::DOUBLE AS epoch,
  {_spread_sql("(user_id * 331 + event_id * 17)", 1, 9973, LON - 0.05, 0.6)} AS lon, {_spread_sql("(user_id * 211 + event_id * 13)", 1, 9967, LAT - 0.05, 0.6)} AS lat,
  (event_id * 7 % 30)::DOUBLE AS sog, (event_id * 37 % 360)::DOUBLE AS cog, 'V' || (user_id % 40) AS name, event_type AS kind, 'P' || (event_id % 9) AS destination,
  (user_id % 50 + event_id % 3)::DOUBLE AS dim_a, (user_id % 40)::DOUBLE AS dim_b, (user_id % 9)::DOUBLE AS dim_c, (user_id % 7)::DOUBLE AS dim_d FROM events)""",
    "scene": f"""scene AS (SELECT 0::BIGINT AS scene_id, {LON}::DOUBLE AS min_lon, 0.001::DOUBLE AS dlon, {LON + 0.5}::DOUBLE AS max_lon, {LAT + 0.5}::DOUBLE AS max_lat, {LAT}::DOUBLE AS min_lat,
  -0.001::DOUBLE AS dlat, 501 AS xsize, 501 AS ysize, {START_S}::DOUBLE AS start_s, {END_S}::DOUBLE AS end_s, true AS ascending)""",
    "edges": f"""corners AS (SELECT r_regionkey AS zone, {LON}::DOUBLE + 0.08::DOUBLE * r_regionkey AS o FROM region),
edges AS (SELECT zone, o AS ax, 34.0::DOUBLE AS ay, o + 0.2::DOUBLE AS bx, 34.05::DOUBLE AS b_y FROM corners
  UNION ALL SELECT zone, o + 0.2::DOUBLE, 34.05::DOUBLE, o + 0.1::DOUBLE, 34.45::DOUBLE FROM corners
  UNION ALL SELECT zone, o + 0.1::DOUBLE, 34.45::DOUBLE, o, 34.0::DOUBLE FROM corners)""",
    "pixels": """pixels_g AS (SELECT l_linenumber, l_orderkey, max(l_quantity) AS q1, min(l_quantity) AS q0, max(l_extendedprice) AS p1, max(l_partkey) AS part, max(l_suppkey) AS supp FROM lineitem GROUP BY 1, 2),
pixels AS (SELECT l_linenumber::BIGINT AS scene_id, (l_orderkey // 128)::BIGINT AS row, (l_orderkey % 128)::BIGINT AS col, q1 + 10 AS b4, (part % 97 + 1)::DOUBLE AS b5, p1 + 20000 AS b10, (part % 64)::BIGINT AS qa,
  CASE WHEN part % 13 <> 0 THEN q1 / 100 END AS vh, (supp % 50 + 1)::DOUBLE / 100 AS vv, q0 / 50 AS vh2, (part % 50 + 1)::DOUBLE / 90 AS vv2 FROM pixels_g)""",
    "detections": """detections_x AS (SELECT o_orderkey AS k, (o_orderkey * 37 % 600)::DOUBLE AS x, (o_orderkey * 53 % 600)::DOUBLE AS y FROM orders),
detections AS (SELECT (k // 500)::BIGINT AS image_id, k::BIGINT AS det_id, x AS x1, y AS y1, x + 10 + k % 50 AS x2, y + 8 + k * 7 % 40 AS y2, (k * 7919 % 10007) / 10007.0::DOUBLE AS conf, (k % 5)::INTEGER AS cls FROM detections_x)""",
}


def with_tables(names: str, body: str) -> str:
    """SQL over some of the tables above."""
    return "WITH " + ",\n".join(SQL[n] for n in names.split()) + (",\n" if body.lstrip().startswith("-- more\n") else "\n") + body.lstrip().removeprefix("-- more\n")
