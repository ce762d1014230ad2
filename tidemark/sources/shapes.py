"""Polygon shapefiles and their attribute tables."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ZONE = "file string, zone_ord int, zone_no int, rings array<array<struct<x: double, y: double>>>"


def polygons(raw: bytes) -> list[list[list[tuple[float, float]]]]:
    """The rings of each record of a .shp file (types 5, 15 and 25; others have none)."""
    out, at = [], 100
    while at + 8 <= len(raw):
        size = struct.unpack(">i", raw[at + 4 : at + 8])[0] * 2
        body = raw[at + 8 : at + 8 + size]
        at += 8 + size
        rings = []
        if len(body) >= 44 and struct.unpack("<i", body[:4])[0] in (5, 15, 25):
            parts, points = struct.unpack("<ii", body[36:44])
            starts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), points]
            flat = struct.unpack(f"<{2 * points}d", body[44 + 4 * parts : 44 + 4 * parts + 16 * points])
            xy = list(zip(flat[::2], flat[1::2], strict=True))
            rings = [xy[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        out.append(rings)
    return out


def attributes(raw: bytes, encoding: str = "utf-8") -> list[dict[str, str]]:
    """The records of a .dbf file, values as trimmed text."""
    n, head, size = struct.unpack("<IHH", raw[4:12])
    fields, at = [], 32
    while raw[at] != 0x0D:
        fields.append((raw[at : at + 11].split(b"\0")[0].decode(encoding), raw[at + 16]))
        at += 32
    out = []
    for k in range(n):
        row, place = {}, head + k * size + 1
        for name, width in fields:
            row[name] = raw[place : place + width].decode(encoding, "replace").strip("\0 ")
            place += width
        out.append(row)
    return out


def zones(spark: SparkSession, path, key: str = "HAEGU_NO", encoding: str = "utf-8") -> DataFrame:
    """(file, zone_ord, zone_no, rings) of the .shp and .dbf files of a folder, in file order; a number that doesn't read as one is NULL."""
    read = lambda kind: spark.read.format("binaryFile").option("pathGlobFilter", f"*.{kind}").load(path).select(F.regexp_extract("path", r"([^/]+)\.[^.]+$", 1).alias("file"), F.col("content").alias(kind))

    def run(batches):
        for pdf in batches:
            rows = []
            for name, shp, dbf in zip(pdf.file, pdf.shp, pdf.dbf, strict=True):
                for k, (rings, row) in enumerate(zip(polygons(shp), attributes(dbf, encoding), strict=False)):
                    try:
                        number = int(float(row.get(key, "")))
                    except ValueError:
                        number = None
                    rows.append((name, k, number, [[{"x": x, "y": y} for x, y in r] for r in rings]))
            out = pd.DataFrame(rows, columns=["file", "zone_ord", "zone_no", "rings"])
            yield out.assign(zone_no=out.zone_no.astype("Int32"))

    return read("shp").join(read("dbf"), "file").mapInPandas(run, _ZONE)
