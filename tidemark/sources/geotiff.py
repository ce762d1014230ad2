"""GeoTIFF rasters, read and written with numpy alone.

Files are read by Spark (any store it knows) and decoded on executors, strip by strip or tile by tile, into
pixel rows.  Uncompressed, Deflate, LZW and PackBits data, whole numbers and floats, both byte orders, and both plane orders are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sizes in bytes and struct letters of the field types of a TIFF directory.
_FIELD = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q")}


def _directory(raw: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    if order is None or struct.unpack(f"{order}H", raw[2:4])[0] != 42:
        raise ValueError("not a TIFF file")
    at = struct.unpack(f"{order}I", raw[4:8])[0]
    tags = {}
    for k in range(struct.unpack(f"{order}H", raw[at : at + 2])[0]):
        tag, kind, n, _ = struct.unpack(f"{order}HHII", raw[at + 2 + 12 * k : at + 14 + 12 * k])
        if kind not in _FIELD:
            continue
        size, letter = _FIELD[kind]
        place = at + 10 + 12 * k if size * n <= 4 else struct.unpack(f"{order}I", raw[at + 10 + 12 * k : at + 14 + 12 * k])[0]
        data = raw[place : place + size * n]
        tags[tag] = (data.rstrip(b"\0").decode("latin-1"),) if kind == 2 else struct.unpack(f"{order}{letter * n if len(letter) == 2 else f'{n}{letter}'}", data)
    return order, tags


def _unpacked_bits(data: bytes) -> bytes:
    out, k = bytearray(), 0
    while k < len(data):
        n = data[k]
        if n < 128:
            out += data[k + 1 : k + 2 + n]
            k += n + 2
        elif n > 128:
            out += data[k + 1 : k + 2] * (257 - n)
            k += 2
        else:
            k += 1
    return bytes(out)


def _unlzw(data: bytes) -> bytes:
    bits = int.from_bytes(data, "big")
    total, at, width = len(data) * 8, 0, 9
    table: list[bytes] = []
    out, before = [], b""
    while at + width <= total:
        code = bits >> (total - at - width) & ((1 << width) - 1)
        at += width
        if code == 257:
            break
        if code == 256:
            table, width, before = [bytes([k]) for k in range(256)] + [b"", b""], 9, b""
            continue
        entry = table[code] if code < len(table) else before + before[:1]
        out.append(entry)
        if before:
            table.append(before + entry[:1])
        before = entry
        width = max(9, (len(table) + 1).bit_length())
    return b"".join(out)


class Tiff:
    """One image of a file's bytes."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.order, t = _directory(raw)
        one = lambda tag, default=None: t[tag][0] if tag in t else default
        self.width, self.height, self.bands = one(256), one(257), one(277, 1)
        self.compression, self.predictor, self.planar = one(259, 1), one(317, 1), one(284, 1)
        kind = {1: "u", 2: "i", 3: "f"}[one(339, 1)]
        self.dtype = np.dtype(f"{self.order}{kind}{one(258, 8) // 8}")
        tiled = 322 in t
        self.block_width, self.block_height = (one(322), one(323)) if tiled else (self.width, one(278, self.height))
        self.offsets, self.counts = (t[324], t[325]) if tiled else (t[273], t[279])
        self.tiled = tiled
        nodata = one(42113)
        self.nodata = float(nodata) if nodata not in (None, "") else None
        if 34264 in t:
            m = t[34264]
            self.transform = (m[3], m[0], m[1], m[7], m[4], m[5])
        elif 33550 in t and 33922 in t:
            (sx, sy, _), (i, j, _, x, y, _) = t[33550][:3], t[33922][:6]
            self.transform = (x - i * sx, sx, 0.0, y + j * sy, 0.0, -sy)
        else:
            self.transform = (0.0, 1.0, 0.0, 0.0, 0.0, 1.0)

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first row, first column, array of (bands, rows, columns)); planes that are stored apart are read together."""
        across, down = -(-self.width // self.block_width), -(-self.height // self.block_height)
        for b in range(across * down):
            if self.planar == 2:
                array = np.concatenate([self._block(b + k * across * down, 1) for k in range(self.bands)])
            else:
                array = self._block(b, self.bands)
            row, col = b // across * self.block_height, b % across * self.block_width
            yield row, col, array[:, : self.height - row, : self.width - col]

    def _block(self, b: int, bands: int) -> np.ndarray:
        data = self.raw[self.offsets[b] : self.offsets[b] + self.counts[b]]
        data = {1: bytes, 5: _unlzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: _unpacked_bits}[self.compression](data)
        width = self.block_width
        rows = self.block_height if self.tiled else len(data) // (width * bands * self.dtype.itemsize)
        if self.predictor == 3:
            size = self.dtype.itemsize
            flat = np.frombuffer(data, np.uint8).reshape(rows, size, width * bands)
            flat = np.cumsum(flat.reshape(rows, -1).reshape(rows, size * width, bands), axis=1, dtype=np.uint8).reshape(rows, size, width * bands)
            array = np.ascontiguousarray(np.moveaxis(flat, 1, 2)).view(f">{self.dtype.str[1:]}").reshape(rows, width, bands)
        else:
            array = np.frombuffer(data, self.dtype, rows * width * bands).reshape(rows, width, bands)
            if self.predictor == 2:
                array = np.cumsum(array, axis=1, dtype=self.dtype)
        return np.moveaxis(array, 2, 0)


def encoded(bands: np.ndarray, transform=(0.0, 1.0, 0.0, 0.0, 0.0, -1.0), nodata: float | None = None, deflate: bool = True, rows_a_strip: int = 64) -> bytes:
    """The bytes of a GeoTIFF of an array (bands, rows, columns)."""
    bands = np.ascontiguousarray(np.atleast_3d(bands) if bands.ndim == 3 else bands[None])
    n, height, width = bands.shape
    kind = {"u": 1, "i": 2, "f": 3}[bands.dtype.kind]
    little = np.moveaxis(bands, 0, 2).astype(bands.dtype.newbyteorder("<"))
    strips = [little[r : r + rows_a_strip].tobytes() for r in range(0, height, rows_a_strip)]
    strips = [zlib.compress(s) for s in strips] if deflate else strips
    offsets, at = [], 8
    for s in strips:
        offsets.append(at)
        at += len(s) + len(s) % 2
    xo, a, b, yo, d, e = transform
    fields = [
        (256, 4, [width]), (257, 4, [height]), (258, 3, [bands.dtype.itemsize * 8] * n), (259, 3, [8 if deflate else 1]), (262, 3, [1]), (273, 4, offsets), (277, 3, [n]), (278, 4, [rows_a_strip]),
        (279, 4, [len(s) for s in strips]), (284, 3, [1]), (339, 3, [kind] * n),
    ]
    fields += [(33550, 12, [a, -e, 0.0]), (33922, 12, [0.0, 0.0, 0.0, xo, yo, 0.0])] if b == d == 0 else [(34264, 12, [a, b, 0.0, xo, d, e, 0.0, yo, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0])]
    if nodata is not None:
        fields.append((42113, 2, f"{nodata:g}\0".encode()))
    fields.sort()
    place = at + 2 + 12 * len(fields) + 4
    entries, extra = b"", b""
    for tag, kind_, values in fields:
        data = values if kind_ == 2 else struct.pack(f"<{len(values)}{_FIELD[kind_][1]}", *values)
        if len(data) <= 4:
            value = data.ljust(4, b"\0")
        else:
            value = struct.pack("<I", place + len(extra))
            extra += data + b"\0" * (len(data) % 2)
        entries += struct.pack("<HHI", tag, kind_, len(values)) + value
    body = b"".join(s + b"\0" * (len(s) % 2) for s in strips)
    return struct.pack("<2sHI", b"II", 42, at) + body + struct.pack("<H", len(fields)) + entries + b"\0\0\0\0" + extra


def _files(spark: SparkSession, path, pattern: str) -> DataFrame:
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return raw.select(F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), r"\.[^.]*$", "").alias("scene_id"), "content")


def scenes(spark: SparkSession, path, pattern: str = "*.tif") -> DataFrame:
    """(scene_id, xsize, ysize, bands, min_lon, dlon, max_lon, max_lat, min_lat, dlat, nodata): bounds as positions of the outer pixels."""

    def run(batches):
        for pdf in batches:
            out = []
            for name, content in zip(pdf.scene_id, pdf.content, strict=True):
                t = Tiff(content)
                xo, a, _, yo, _, e = t.transform
                out.append((name, t.width, t.height, t.bands, xo, a, xo + a * (t.width - 1), yo, yo + e * (t.height - 1), e, t.nodata))
            yield pd.DataFrame(out, columns=["scene_id", "xsize", "ysize", "bands", "min_lon", "dlon", "max_lon", "max_lat", "min_lat", "dlat", "nodata"])

    return _files(spark, path, pattern).mapInPandas(run, "scene_id string, xsize int, ysize int, bands int, min_lon double, dlon double, max_lon double, max_lat double, min_lat double, dlat double, nodata double")


def pixels(spark: SparkSession, path, bands: int = 1, pattern: str = "*.tif") -> DataFrame:
    """(scene_id, row, col, b1, ...): a row for each pixel; NaN and the file's no-data value are NULL.  A file with fewer bands has NULL for the rest."""
    return decoded(_files(spark, path, pattern), bands)


def decoded(files: DataFrame, bands: int = 1) -> DataFrame:
    """pixels() of a table of files (scene_id: string, content: the bytes of a GeoTIFF)."""

    def run(batches):
        for pdf in batches:
            for name, content in zip(pdf.scene_id, pdf.content, strict=True):
                t = Tiff(content)
                for row, col, block in t.blocks():
                    r, c = np.indices(block.shape[1:])
                    out = {"scene_id": name, "row": (r + row).ravel().astype(np.int32), "col": (c + col).ravel().astype(np.int32)}
                    for k in range(bands):
                        v = block[k].astype(float).ravel() if k < len(block) else np.full(r.size, np.nan)
                        out[f"b{k + 1}"] = np.where(v == t.nodata, np.nan, v) if t.nodata is not None else v
                    yield pd.DataFrame(out)

    found = files.select("scene_id", "content").mapInPandas(run, "scene_id string, row int, col int, " + ", ".join(f"b{k + 1} double" for k in range(bands)))
    return found.select("scene_id", "row", "col", *(F.when(~F.isnan(f"b{k + 1}"), F.col(f"b{k + 1}")).alias(f"b{k + 1}") for k in range(bands)))


def images(rasters: DataFrame, bands: list[str], transform=(0.0, 1.0, 0.0, 0.0, 0.0, -1.0), nodata: float = -9999.0) -> DataFrame:
    """(scene_id, content): the bytes of a GeoTIFF of 32-bit floats for each scene; missing pixels get the no-data value.

    One image is one value, so a scene must fit a task; larger ones are to be written as Parquet pixels.
    """
    kind = dict(rasters.dtypes)["scene_id"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        array = np.full((len(bands), int(pdf.row.max()) + 1, int(pdf.col.max()) + 1), nodata, np.float32)
        for k, b in enumerate(bands):
            array[k, pdf.row, pdf.col] = pdf[b].fillna(nodata)
        return pd.DataFrame({"scene_id": pdf.scene_id.iloc[:1], "content": [encoded(array, transform, nodata)]})

    return rasters.select("scene_id", "row", "col", *bands).groupBy("scene_id").applyInPandas(run, f"scene_id {kind}, content binary")
