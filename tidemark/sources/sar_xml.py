"""Radar product metadata from XML, by element name whatever its prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def texts(spark: SparkSession, path) -> DataFrame:
    """(path, xml) of whole files."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("xml"))


def _all(name: str, xml: str = "xml") -> Column:
    return F.xpath(F.col(xml), F.lit(f"//*[name()='{name}' or substring-after(name(), ':')='{name}']/text()"))


def _one(name: str) -> Column:
    """The text of the only element of that name, else NULL."""
    found = _all(name)
    return F.when(F.size(found) == 1, found[0])


def _path(path: str) -> Column:
    found = F.xpath(F.col("xml"), F.lit(f"{path}/text()"))
    return F.when(F.size(found) > 0, found[0])


def annotation(documents: DataFrame) -> DataFrame:
    """(path, start_s, end_s, ascending) of product annotations; times to the second."""
    at = lambda name: F.try_to_timestamp(F.substring(F.replace(_path(f"/product/adsHeader/{name}"), F.lit("T"), F.lit(" ")), 1, 19), F.lit("yyyy-MM-dd HH:mm:ss")).cast("double")
    return documents.select("path", at("startTime").alias("start_s"), at("stopTime").alias("end_s"), (_path("/product/generalAnnotation/productInformation/pass") == "Ascending").alias("ascending"))


def _numbers(c: Column, kind: str = "double") -> Column:
    return F.transform(F.split(F.trim(c), r"\s+"), lambda x: x.cast(kind))


def calibration(documents: DataFrame) -> DataFrame:
    """(path, pol, abs_const, line, azimuth_time, pixel, sigma_0, beta_0, gamma, dn): a row for each calibration vector, values as arrays."""
    at = lambda tag: F.xpath(F.col("xml"), F.lit(f"//calibrationVector/{tag}/text()"))
    tags = {"azimuthTime": "azimuth_time", "line": "line", "pixel": "pixel", "sigmaNought": "sigma_0", "betaNought": "beta_0", "gamma": "gamma", "dn": "dn"}
    zipped = F.arrays_zip(*(at(t).alias(n) for t, n in tags.items()))
    rows = documents.select("path", _path("//adsHeader/polarisation").alias("pol"), _path("//absoluteCalibrationConstant").cast("double").alias("abs_const"), F.explode(zipped).alias("v"))
    number = lambda n: _numbers(F.col(f"v.{n}"), "int" if n == "pixel" else "double").alias(n)
    return rows.select("path", "pol", "abs_const", F.col("v.line").cast("int").alias("line"), F.col("v.azimuth_time").cast("timestamp_ntz").alias("azimuth_time"), *(number(n) for n in ("pixel", "sigma_0", "beta_0", "gamma", "dn")))


def calibration_nodes(vectors: DataFrame, which: str = "sigma_0") -> DataFrame:
    """(path, pol, node_row, node_col, factor): one row for each node of the calibration grid."""
    return vectors.select("path", "pol", F.col("line").alias("node_row"), F.explode(F.arrays_zip("pixel", which)).alias("n")).select("path", "pol", "node_row", F.col("n.pixel").alias("node_col"), F.col(f"n.{which}").alias("factor"))


def geolocation(documents: DataFrame) -> DataFrame:
    """(path, azimuth_time, slant_range_time, row, column, latitude, longitude, height, incidence_angle, elevation_angle)."""
    tags = {"azimuthTime": "azimuth_time", "slantRangeTime": "slant_range_time", "line": "row", "pixel": "column", "latitude": "latitude", "longitude": "longitude", "height": "height", "incidenceAngle": "incidence_angle", "elevationAngle": "elevation_angle"}
    at = lambda tag: F.xpath(F.col("xml"), F.lit(f"//geolocationGridPoint/{tag}/text()"))
    rows = documents.select("path", F.explode(F.arrays_zip(*(at(t).alias(n) for t, n in tags.items()))).alias("p"))
    kind = {"azimuth_time": "timestamp_ntz", "row": "int", "column": "int"}
    return rows.select("path", *(F.col(f"p.{n}").cast(kind.get(n, "double")).alias(n) for n in tags.values()))


# Element names of a product manifest, the column each fills, its type, and how many there must be (None: any).
MANIFEST = (
    ("nssdcIdentifier", "nssdc_identifier", "string", 1), ("orbitNumber", "orbit_number", "int", 2), ("relativeOrbitNumber", "relative_orbit_number", "int", 2), ("cycleNumber", "cycle_number", "int", 1),
    ("phaseIdentifier", "phase_identifier", "int", 1), ("startTime", "start_time", "timestamp_ntz", 1), ("stopTime", "stop_time", "timestamp_ntz", 1), ("pass", "pass", "string", 1),
    ("ascendingNodeTime", "ascending_node_time", "timestamp_ntz", 1), ("startTimeANX", "start_time_anx", "double", 1), ("stopTimeANX", "stop_time_anx", "double", 1), ("mode", "mode", "string", 1),
    ("swath", "swath", "string", None), ("instrumentConfigurationID", "instrument_config", "int", 1), ("missionDataTakeID", "mission_data_id", "string", 1), ("transmitterReceiverPolarisation", "polarisation", "string", None),
    ("productClass", "product_class", "string", 1), ("productComposition", "product_composition", "string", 1), ("productType", "product_type", "string", 1), ("productTimelinessCategory", "product_timeliness", "string", 1),
    ("sliceProductFlag", "slice_product_flag", "string", 1), ("segmentStartTime", "segment_start_time", "timestamp_ntz", 1), ("sliceNumber", "slice_number", "int", 1), ("totalSlices", "total_slices", "int", 1), ("coordinates", "footprint", "string", 1),
)


def _cast_to(kind: str):
    return lambda x: x.try_cast(kind)


def manifest(documents: DataFrame) -> DataFrame:
    """One row a product: mission and the fields of MANIFEST, arrays where there may be several, and `error` with the names of those missing."""
    rows = documents
    for tag, name, _, _ in (("familyName", "_family", "", 0), ("number", "_number", "", 0), *MANIFEST):
        rows = rows.withColumn(f"_{name}", _all(tag))
    columns = [F.when((F.size("__family") > 0) & (F.size("__number") == 1), F.concat(F.col("__family")[0], F.col("__number")[0])).alias("mission")]
    for _, name, kind, count in MANIFEST:
        found = F.col(f"_{name}")
        if count == 1:
            columns.append(F.when(F.size(found) == 1, found[0].try_cast(kind)).alias(name))
        else:
            sound = F.size(found) > 0 if count is None else F.size(found) == count
            columns.append(F.when(sound, F.transform(found, _cast_to(kind))).alias(name))
    out = rows.select("path", *columns)
    names = ["mission", *(name for _, name, _, _ in MANIFEST)]
    missing = F.filter(F.array(*(F.when(F.col(n).isNull(), F.lit(n)) for n in names)), lambda x: x.isNotNull())
    return out.withColumn("error", missing)


def image_properties(documents: DataFrame) -> DataFrame:
    """(path, name, value) of the property elements of an image description."""
    names, values = F.xpath(F.col("xml"), F.lit("//property[value]/@name")), F.xpath(F.col("xml"), F.lit("//property[value]/value/text()"))
    return documents.select("path", F.explode(F.arrays_zip(names.alias("name"), values.alias("value"))).alias("p")).select("path", "p.name", "p.value")


def band_statistics(documents: DataFrame) -> DataFrame:
    """(path, band, least, mean, most, std, valid_percent) from a raster's side file."""
    fields = {"STATISTICS_MINIMUM": "least", "STATISTICS_MEAN": "mean", "STATISTICS_MAXIMUM": "most", "STATISTICS_STDDEV": "std", "STATISTICS_VALID_PERCENT": "valid_percent"}
    bands = F.xpath(F.col("xml"), F.lit("//PAMRasterBand/@band"))
    rows = documents.select("path", "xml", F.explode(bands).alias("band"))
    at = lambda key: F.call_function("xpath_string", F.col("xml"), F.concat(F.lit("//PAMRasterBand[@band='"), F.col("band"), F.lit(f"']/Metadata/MDI[@key='{key}']")))
    out = rows
    for key, name in fields.items():
        values = F.xpath(F.col("xml"), F.lit(f"//PAMRasterBand/Metadata/MDI[@key='{key}']/text()"))
        out = out.withColumn(name, F.get(values, F.array_position(bands, F.col("band")).cast("int") - 1).try_cast("double"))
    return out.select("path", F.col("band").cast("int").alias("band"), *fields.values())


def footprint_points(texts_: DataFrame, column: str = "kml") -> DataFrame:
    """(path, lon, lat) of the first coordinates element of map overlays."""
    body = F.regexp_extract(F.col(column), r"(?s)<coordinates>(.*?)</coordinates>", 1)
    pairs = F.regexp_extract_all(body, F.lit(r"(-?[0-9.]+),(-?[0-9.]+)"), F.lit(0))
    return texts_.select("path", F.explode(pairs).alias("p")).select("path", F.split("p", ",")[0].cast("double").alias("lon"), F.split("p", ",")[1].cast("double").alias("lat"))


def overlays(spark: SparkSession, path) -> DataFrame:
    """(path, kml): the map overlays inside zipped products; a product without one has no row."""
    import io
    import zipfile

    import pandas as pd

    def run(batches):
        for pdf in batches:
            out = []
            for name, content in zip(pdf.path, pdf.content, strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    out += [(name, z.read(n).decode()) for n in z.namelist() if n.endswith("preview/map-overlay.kml")]
            yield pd.DataFrame(out, columns=["path", "kml"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content").mapInPandas(run, "path string, kml string")
