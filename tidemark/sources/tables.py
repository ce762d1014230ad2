"""Tables of reports, boxes and metadata from CSV, JSON, text and databases; and the writers of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_REPORT = "MMSI bigint, Date string, Time string, Lon double, Lat double, SOG double, COG double, VesselName string, VesselType string, DimA string, DimB string, DimC string, DimD string, Status string, ToPortof string"
_BOXES = "LatMin double, LonMin double, LatMax double, LonMax double, Class string"
_SHIPS = "image string, X int, Y int, W int, H int, Lon double, Lat double"


def _csv(spark: SparkSession, path, schema: str) -> DataFrame:
    """A CSV with a header, its columns found by name, case aside; columns that the file lacks are NULL.

    Values come as text and are cast, so that a bad one is NULL and its row stays.
    """
    raw = spark.read.csv(path, header=True)
    have = {c.lower(): c for c in raw.columns}
    want = T.StructType.fromDDL(schema)
    aliases = {"image": ("imagename",)}
    columns = []
    for f in want:
        name = next((have[n] for n in (f.name.lower(), *aliases.get(f.name.lower(), ())) if n in have), None)
        columns.append((F.col(f"`{name}`").try_cast(f.dataType) if name else F.lit(None).cast(f.dataType)).alias(f.name))
    return raw.select(*columns)


def epoch(date: Column, time: Column) -> Column:
    """Seconds since 1970 of 'yyyy-MM-dd' and 'HH:mm:ss...' by place, fractions cut; 0 where they don't read as a time.

    The session's time zone counts (UTC by default here).
    """
    said = F.concat_ws(" ", F.concat_ws("-", F.substring(date, 1, 4), F.substring(date, 6, 2), F.substring(date, 9, 2)), F.concat_ws(":", F.substring(time, 1, 2), F.substring(time, 4, 2), F.substring(time, 7, 2)))
    return F.coalesce(F.try_to_timestamp(said, F.lit("yyyy-MM-dd HH:mm:ss")).cast("double"), F.lit(0.0))


def reports(spark: SparkSession, path) -> DataFrame:
    """Position reports in any of the three header styles as seq, mmsi, epoch, lon, lat, sog, cog, name, kind, status, destination, dim_a..dim_d.

    seq gives the order of rows within a file (and of files); a dimension that isn't a number is 0.
    """
    return as_reports(_csv(spark, path, _REPORT).withColumn("seq", F.monotonically_increasing_id()))


def as_reports(raw: DataFrame) -> DataFrame:
    dim = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    return raw.select(
        "seq", F.col("MMSI").alias("mmsi"), epoch(F.col("Date"), F.col("Time")).alias("epoch"), F.col("Lon").alias("lon"), F.col("Lat").alias("lat"), F.col("SOG").alias("sog"), F.col("COG").alias("cog"),
        F.col("VesselName").alias("name"), F.col("VesselType").alias("kind"), F.col("Status").alias("status"), F.col("ToPortof").alias("destination"),
        dim("DimA").alias("dim_a"), dim("DimB").alias("dim_b"), dim("DimC").alias("dim_c"), dim("DimD").alias("dim_d"),
    )


def facilities(spark: SparkSession, path) -> DataFrame:
    """Facility boxes: LatMin, LonMin, LatMax, LonMax, Class; columns that a file lacks are NULL."""
    return _csv(spark, path, _BOXES)


def ships(spark: SparkSession, path) -> DataFrame:
    """Detected ships: image, X, Y, W, H, Lon, Lat, by whichever of its names the image column goes."""
    return _csv(spark, path, _SHIPS)


def database(spark: SparkSession, url: str, table: str, start: str, end: str, at: str = "ts", partitions: int = 1, **options) -> DataFrame:
    """A table over JDBC, with the rows of a closed time span; the filter on the timestamp column is pushed down.

    With partitions > 1, the span is read in as many slices.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partitions > 1:
        reader = reader.options(partitionColumn=at, lowerBound=start, upperBound=end, numPartitions=str(partitions))
    return in_span(reader.load(), start, end, at)


def in_span(rows: DataFrame, start: str, end: str, at: str = "ts") -> DataFrame:
    """Rows of a closed span, given to the second or to the microsecond."""
    kind = dict(rows.dtypes)[at]
    return rows.where(F.col(at).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def roi(spark: SparkSession, path) -> DataFrame:
    """(file, roi_id, timestamp) of region files; 'Unknown' for what is missing or doesn't parse."""
    raw = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").schema("ROI_ID string, Timestamp string").json(path)
    said = lambda c: F.coalesce(F.col(c), F.lit("Unknown"))
    return raw.select(F.col("_metadata.file_name").alias("file"), said("ROI_ID").alias("roi_id"), said("Timestamp").alias("timestamp"))


def thermal_constants(spark: SparkSession, path) -> DataFrame:
    """(file, radiance_mult, radiance_add, k1, k2) of thermal metadata files."""
    names = {"RADIANCE_MULT_BAND_10": "radiance_mult", "RADIANCE_ADD_BAND_10": "radiance_add", "K1_CONSTANT_BAND_10": "k1", "K2_CONSTANT_BAND_10": "k2"}
    raw = spark.read.option("multiLine", True).schema(", ".join(f"{c} double" for c in names)).json(path)
    return raw.select(F.col("_metadata.file_name").alias("file"), *(F.col(c).alias(n) for c, n in names.items()))


def files(spark: SparkSession, path, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """(path, name, stem, length, modified) of files, contents unread."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return raw.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "length", F.col("modificationTime").alias("modified"))


def key_values(spark: SparkSession, path, keys: list[str]) -> DataFrame:
    """One row a file: the text after 'key:' lines; keys end before a bracket, as in 'Bperp (average): 1.5'."""
    lines = spark.read.text(path).select(F.input_file_name().alias("path"), F.trim(F.regexp_extract("value", r"^([^:(]+)", 1)).alias("k"), F.trim(F.regexp_extract("value", r":(.*)$", 1)).alias("v"))
    return lines.groupBy("path").pivot("k", keys).agg(F.first("v"))


def label_lines(spark: SparkSession, path) -> DataFrame:
    """(image, x1, y1, x2, y2, cls) from lines 'image x1,y1,x2,y2,cls x1,...'; an image without boxes has no row."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select(parts[0].alias("image"), F.explode(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).alias("b"))
    n = F.split("b", ",")
    return rows.select("image", *(F.get(n, F.lit(k)).try_cast("int").alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2", "cls"))))


def label_shapes(spark: SparkSession, path) -> DataFrame:
    """(image, x, y, w, h) from annotation files with shapes of two points; x is swapped if it runs backwards, other shapes are skipped."""
    schema = "shapes array<struct<label: string, points: array<array<double>>>>"
    raw = spark.read.option("multiLine", True).schema(schema).json(path)
    image = F.concat(F.regexp_replace(F.col("_metadata.file_name"), r"\..*$", ""), F.lit(".tif"))
    p = F.col("s.points")
    rows = raw.select(image.alias("image"), F.explode("shapes").alias("s")).where(F.size(p) == 2)
    at = lambda i, j: p[i][j]
    x1, x2 = F.least(at(0, 0), at(1, 0)).cast("int"), F.greatest(at(0, 0), at(1, 0)).cast("int")
    y1, y2 = at(0, 1).cast("int"), at(1, 1).cast("int")
    return rows.select("image", x1.alias("x"), y1.alias("y"), (x2 - x1).alias("w"), (y2 - y1).alias("h"))


def label_files(spark: SparkSession, path, one_row_is_unread: bool = False) -> DataFrame:
    """(image, x, y, w, h) of text files with a box a line; with one_row_is_unread, files of one line are skipped."""
    rows = spark.read.text(path).select(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("stem"), F.split(F.trim("value"), r"[,\s]+").alias("n")).where(F.size("n") >= 4)
    if one_row_is_unread:
        rows = rows.join(rows.groupBy("stem").agg(F.count("*").alias("k")).where("k > 1").select("stem"), "stem", "left_semi")
    return rows.select(F.concat("stem", F.lit(".tif")).alias("image"), *(F.col("n")[k].try_cast("int").alias(c) for k, c in enumerate("xywh")))


def to_csv(df: DataFrame, path: str, one_file: bool = True) -> None:
    """CSV with a header; one_file puts a result small enough for that into one part."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(path, header=True)


def to_json(df: DataFrame, path: str, one_file: bool = True) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").json(path)


def csv_to_json(spark: SparkSession, source: str, path: str) -> None:
    """All values stay text."""
    spark.read.csv(source, header=True).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def alert(values: DataFrame, threshold: Column) -> DataFrame:
    """values with the text that an alerting system compares: {"thresholdEstimationValue": ...}."""
    return values.withColumn("alert", F.to_json(F.struct(threshold.cast("double").alias("thresholdEstimationValue"))))
