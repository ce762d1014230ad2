"""Rasters as tables of pixels (scene_id, row, col, bands): statistics, stretches, lookups, windows, and kernels by tile.

Per-pixel and per-scene work is done by expressions and aggregates.  Kernels that look at neighbours run on square tiles: every pixel
goes to its tile and, within the kernel's reach of a border, to the tiles beyond it; each tile is one bounded group.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import radiometry as rad
from ..shared import written
from . import linked


def scene_mean(pixels: DataFrame, value: str, nodata: float | None = None, single: bool = False) -> DataFrame:
    """(scene_id, mean) over known pixels; a scene without any has no row.  With single, values count as 32-bit floats."""
    v = rad.known(F.col(value).cast("float").cast("double") if single else F.col(value).cast("double"), nodata)
    return pixels.groupBy("scene_id").agg(F.avg(v).alias("mean"), F.count(v).alias("_n")).where("_n > 0").drop("_n")


def ratio_mean(pixels: DataFrame, a: str, b: str) -> DataFrame:
    """(scene_id, mean) of a / b; pixels with b = 0 don't count."""
    return pixels.groupBy("scene_id").agg(F.avg(F.try_divide(rad.known(F.col(a)), rad.known(F.col(b)))).alias("mean"))


def band_statistics(pixels: DataFrame, value: str, nodata: float | None = None) -> DataFrame:
    """(scene_id, least, most, mean, std, valid_percent): population deviation, share of known pixels."""
    v = rad.known(F.col(value), nodata)
    return pixels.groupBy("scene_id").agg(F.min(v).alias("least"), F.max(v).alias("most"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), (100 * F.count(v) / F.count("*")).alias("valid_percent"))


#: Accuracy of the sketch that brackets a quantile: between its bounds lie some 6 / BRACKET of a scene's pixels.
BRACKET = 2000


def quantiles(pixels: DataFrame, value: str, shares: list[float], exact: bool = True, keys: tuple[str, ...] = ("scene_id",)) -> DataFrame:
    """(scene_id, q0, q1, ...): interpolated quantiles; with exact false, sketched ones.

    Exact ones take two passes: a mergeable sketch brackets each quantile, then values below the bracket are counted
    and only those inside it, each distinct one once, are put in order.  A scene is never sorted in one task.  A scene without values has NULL.
    """
    if not exact:
        q = F.percentile_approx(rad.known(F.col(value)), shares, 100_000)
        return pixels.groupBy(*keys).agg(q.alias("q")).select(*keys, *(F.col("q")[k].alias(f"q{k}") for k in range(len(shares))))
    rows = pixels.select(*keys, rad.known(F.col(value)).cast("double").alias("v"))
    near = [min(max(s + d * 3 / BRACKET, 0.0), 1.0) for s in shares for d in (-1, 1)]
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("v", near, BRACKET).alias("near"), F.min("v").alias("least"), F.max("v").alias("most"), F.count("v").alias("n"))
    small = F.col("n") < 2 * BRACKET  # a bracket has to hold the two values that a quantile lies between
    low = lambda k: F.when(small | F.lit(near[2 * k] == 0.0), F.col("least")).otherwise(F.col("near")[2 * k])
    high = lambda k: F.when(small | F.lit(near[2 * k + 1] == 1.0), F.col("most")).otherwise(F.col("near")[2 * k + 1])
    bounds = sketch.select(*keys, "n", F.array(*(F.struct(F.lit(k).alias("k"), F.lit(float(s)).alias("share"), low(k).alias("low"), high(k).alias("high")) for k, s in enumerate(shares))).alias("bounds"))
    bounds = written(bounds, "bounds")
    known = rows.where("v is not null")
    placed = known.join(bounds, [*keys]).select(*keys, "n", "v", F.inline("bounds")).where("v <= high")
    below = F.col("v") < F.col("low")
    counts = placed.groupBy(*keys, "n", "k", "share", F.when(~below, F.col("v")).alias("v")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*keys, "k").orderBy(F.col("v").asc_nulls_first()))  # the count below the bracket comes first
    at = (F.col("n") - 1) * F.col("share")
    ranked = counts.withColumns({"upto": upto, "at": at}).withColumn("from", F.col("upto") - F.col("c"))
    holds = lambda place: F.max(F.when((F.col("from") <= place) & (place < F.col("upto")), F.col("v")))
    two = ranked.groupBy(*keys, "k").agg(holds(F.floor("at")).alias("a"), holds(F.ceil("at")).alias("b"), F.first("at").alias("at"))
    mixed = F.when(F.ceil("at") == F.floor("at"), F.col("a")).otherwise((F.ceil("at") - F.col("at")) * F.col("a") + (F.col("at") - F.floor("at")) * F.col("b"))
    found = two.groupBy(*keys).agg(*(F.max(F.when(F.col("k") == k, mixed)).alias(f"q{k}") for k in range(len(shares))))
    return bounds.select(*keys).join(found, [*keys], "left")


def stretched(pixels: DataFrame, value: str, low: float = 0.01, high: float = 0.99, exact: bool = True) -> DataFrame:
    """pixels with `byte`: the value clipped to two quantiles of its scene and scaled to whole numbers 0..255; NULL in a scene of one value."""
    bounds = quantiles(pixels, value, [low, high], exact)
    v = rad.clipped(F.col(value), F.col("q0"), F.col("q1"))
    return pixels.join(bounds, "scene_id").withColumn("byte", F.floor(F.try_divide(v - F.col("q0"), F.col("q1") - F.col("q0")) * 255).cast("int")).drop("q0", "q1")


def normalised(pixels: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """pixels with `unit`: (value - least) / (most - least) within each group; as it is where most is 0, NULL where all are equal."""
    w = Window.partitionBy(*keys)
    least, most = F.min(value).over(w), F.max(value).over(w)
    return pixels.withColumn("unit", F.when(most != 0, F.try_divide(F.col(value) - least, most - least)).otherwise(F.col(value)))


def aligned(a: DataFrame, b: DataFrame, suffix: str = "_2") -> DataFrame:
    """Pixels of two rasters that stand at the same place; the second's bands get a suffix."""
    keys = ["scene_id", "row", "col"]
    return a.join(b.select(*keys, *(F.col(c).alias(f"{c}{suffix}") for c in b.columns if c not in keys)), keys)


def surface_temperature(pixels: DataFrame) -> DataFrame:
    """(scene_id, row, col, celsius) from bands b4, b5, b10 and quality words qa; NULL under cloud or out of range."""
    eps = rad.emissivity(rad.ndvi(F.col("b4"), F.col("b5")))
    value = rad.surface_temperature(rad.brightness_temperature(F.col("b10")), eps)
    return pixels.select("scene_id", "row", "col", rad.masked(value, ~rad.cloudy(F.col("qa"))).alias("celsius"))


def resampled(scenes: DataFrame, elevation: DataFrame) -> DataFrame:
    """(scene_id, row, col, value, water): the elevation cell at the centre of each pixel of scenes (scene_id, height, width, min_lon, dlon,
    max_lat, dlat); 0 where the elevation grid (grid_row, grid_col, value, lon0, lat0, step) has none; water is 1 where it isn't positive."""
    at = scenes.select("*", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("row")).select("*", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("col"))
    origin = elevation.agg(F.first("lon0").alias("lon0"), F.first("lat0").alias("lat0"), F.first("step").alias("step"))
    lon, lat = F.col("min_lon") + (F.col("col") + 0.5) * F.col("dlon"), F.col("max_lat") + (F.col("row") + 0.5) * F.col("dlat")
    at = at.crossJoin(F.broadcast(origin))  # one row
    at = at.withColumn("grid_col", F.floor((lon - F.col("lon0")) / F.col("step"))).withColumn("grid_row", F.floor((F.col("lat0") - lat) / F.col("step")))
    found = at.join(elevation.select("grid_row", "grid_col", "value"), ["grid_row", "grid_col"], "left")
    value = F.coalesce(F.col("value"), F.lit(0.0))
    return found.select("scene_id", "row", "col", value.alias("value"), F.when(value > 0, 0).otherwise(1).alias("water"))


def gaps_filled(pixels: DataFrame, value: str, width: str = "width") -> DataFrame:
    """pixels with missing values filled along the scene read row by row: linear between the known neighbours, held constant at the ends.

    Neighbours are found within each row by running windows (both ways, so that no frame is read again), and across rows
    from one summary a row; a scene is never one partition.
    """
    at = F.col("row").cast("long") * F.col(width) + F.col("col")
    rows = pixels.withColumn("_at", at).withColumn("_v", rad.known(F.col(value)))
    rows = rows.withColumn("_m", F.when(F.col("_v").isNotNull(), F.struct(F.col("_at").alias("at"), F.col("_v").alias("v"))))
    ends = rows.groupBy("scene_id", "row").agg(F.min("_m").alias("first"), F.max("_m").alias("last"))
    above = Window.partitionBy("scene_id").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("scene_id").orderBy(F.col("row").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("scene_id", "row", F.last("last", ignorenulls=True).over(above).alias("_above"), F.last("first", ignorenulls=True).over(below).alias("_below"))
    run = lambda order: F.last("_m", ignorenulls=True).over(Window.partitionBy("scene_id", "row").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"_p": run(F.col("_at")), "_f": run(F.col("_at").desc())}).join(ends, ["scene_id", "row"])
    p, f = F.coalesce("_p", "_above"), F.coalesce("_f", "_below")
    between = p["v"] + (f["v"] - p["v"]) * (F.col("_at") - p["at"]) / (f["at"] - p["at"])
    filled = F.coalesce(F.col("_v"), F.when(p.isNotNull() & f.isNotNull(), between), p["v"], f["v"])
    return rows.withColumn(value, filled).select(*pixels.columns)


def boxcar_inside(pixels: DataFrame, value: str, k: int) -> DataFrame:
    """pixels with `smooth`: the mean of the k by k pixels around, by two one-way windows; NULL where the square isn't whole."""
    half = k // 2
    back = half if k % 2 else half - 1
    w = lambda a, b: Window.partitionBy("scene_id", a).orderBy(b).rowsBetween(-half, back)
    rows = pixels.withColumn("_s", F.when(F.count(value).over(w("row", "col")) == k, F.sum(value).over(w("row", "col"))))
    rows = rows.withColumn("smooth", F.when(F.count("_s").over(w("col", "row")) == k, F.sum("_s").over(w("col", "row")) / (k * k)))
    return rows.drop("_s")


def by_tile(pixels: DataFrame, value: str, kernel: Callable[[np.ndarray], np.ndarray], reach: int, tile: int = 512, out: str = "out") -> DataFrame:
    """(scene_id, row, col, out): a kernel over 2-D arrays, applied tile by tile with `reach` pixels of surroundings.

    The kernel gets an array with NaN where the scene has no pixel, and returns one of that shape.
    """
    around = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / tile), F.floor((F.col(c) + reach) / tile)))
    dealt = pixels.select("scene_id", "row", "col", F.col(value).cast("double").alias("v")).withColumn("tr", around("row")).withColumn("tc", around("col")).where("tr >= 0 and tc >= 0")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(pdf.tr.iloc[0]) * tile - reach, int(pdf.tc.iloc[0]) * tile - reach
        r, c = pdf.row.to_numpy() - r0, pdf.col.to_numpy() - c0
        array = np.full((tile + 2 * reach, tile + 2 * reach), np.nan)
        array[r, c] = pdf.v
        result = kernel(array)
        own = (r >= reach) & (r < reach + tile) & (c >= reach) & (c < reach + tile)
        return pd.DataFrame({"scene_id": pdf.scene_id[own], "row": pdf.row[own], "col": pdf.col[own], out: result[r[own], c[own]]})

    kind = dict(pixels.dtypes)
    return dealt.groupBy("scene_id", "tr", "tc").applyInPandas(run, f"scene_id {kind['scene_id']}, row {kind['row']}, col {kind['col']}, {out} double")


def _labelled(r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """For each of the pixels (sorted by row and column), the first one of its 8-connected component: hooking and pointer jumping."""
    at = np.full((int(r.max()) + 2, int(c.max()) + 3), -1)
    at[r, c + 1] = np.arange(len(r))
    pairs = [(at[:, :-1], at[:, 1:]), (at[:-1], at[1:]), (at[:-1, :-1], at[1:, 1:]), (at[:-1, 1:], at[1:, :-1])]
    u, v = (np.concatenate([p[k][(p[0] >= 0) & (p[1] >= 0)] for p in pairs]) for k in (0, 1))
    label = np.arange(len(r))
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return label
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(further := label[label], label):
            label = further


def components(flags: DataFrame, tile: int = 512) -> DataFrame:
    """(scene_id, row, col, blob): 8-connected components of the pixels (scene_id, row, col) given; blob is the smallest (row, col) number in it.

    Tiles are labelled one by one; labels that touch across borders are then joined by rounds of star contraction, so
    no scene or component is gathered in one task.
    """
    kind = dict(flags.dtypes)
    placed = flags.select("scene_id", "row", "col", F.floor(F.col("row") / tile).alias("tr"), F.floor(F.col("col") / tile).alias("tc"))

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "col"], kind="stable")
        r, c = pdf.row.to_numpy(np.int64), pdf.col.to_numpy(np.int64)
        least = _labelled(r - r.min(), c - c.min())
        return pd.DataFrame({"scene_id": pdf.scene_id, "row": pdf.row, "col": pdf.col, "blob": ((r << 32) + c)[least]})

    local = written(placed.groupBy("scene_id", "tr", "tc").applyInPandas(label, f"scene_id {kind['scene_id']}, row {kind['row']}, col {kind['col']}, blob long"), "blobs")
    edge = local.where((F.col("row") % tile).isin(0, tile - 1) | (F.col("col") % tile).isin(0, tile - 1))
    near = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]
    to = edge.select("scene_id", F.col("blob").alias("a"), "row", "col", F.explode(F.array(*near)).alias("d")).select("scene_id", "a", (F.col("row") + F.col("d.i")).alias("row"), (F.col("col") + F.col("d.j")).alias("col"))
    links = to.join(edge.select("scene_id", F.col("row").cast(dict(to.dtypes)["row"]).alias("row"), F.col("col").cast(dict(to.dtypes)["col"]).alias("col"), F.col("blob").alias("b")), ["scene_id", "row", "col"]).where("a != b").select("scene_id", "a", "b")
    merged = linked.components(links, ["scene_id"]).select("scene_id", F.col("node").alias("blob"), F.col("component").alias("to"))
    return local.join(merged, ["scene_id", "blob"], "left").select("scene_id", "row", "col", F.coalesce("to", "blob").alias("blob"))


def large_blobs(flags: DataFrame, least: int = 30, tile: int = 512) -> DataFrame:
    """The pixels of components of at least `least` pixels."""
    marked = components(flags, tile)
    sizes = marked.groupBy("scene_id", "blob").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return marked.join(sizes, ["scene_id", "blob"], "left_semi").select("scene_id", "row", "col")


def calibrated(pixels: DataFrame, vectors: DataFrame, value: str) -> DataFrame:
    """pixels with `sigma`: (value / calibration)**2, the calibration bilinear between the nodes (scene_id, node_row, node_col, factor) around the pixel.

    Pixels outside the grid of nodes get NULL.
    """
    from .products import on_grid

    ratio = F.col(value) / F.col("factor")
    return on_grid(pixels, vectors, ["factor"]).withColumn("sigma", ratio * ratio).drop("factor")


def sliced(pixels: DataFrame, rows: tuple[int, int, int], cols: tuple[int, int, int]) -> DataFrame:
    """Every step-th pixel of a window (first, end, step), numbered from 0 again."""
    keep = lambda c, s: (F.col(c) >= s[0]) & (F.col(c) < s[1]) & ((F.col(c) - s[0]) % s[2] == 0)
    number = lambda c, s: ((F.col(c) - s[0]) / s[2]).cast("int")
    return pixels.where(keep("row", rows) & keep("col", cols)).withColumns({"row": number("row", rows), "col": number("col", cols)})


def with_margin(nodes: DataFrame, at: str, length: int, keys: list[str]) -> DataFrame:
    """The nodes of an axis strictly within 0..length, and the next one on either side of them."""
    w = Window.partitionBy(*keys).orderBy(at)
    kept = (F.col(at) > 0) & (F.col(at) < length)
    near = F.coalesce(F.lag(kept).over(w), F.lit(False)) | F.coalesce(F.lead(kept).over(w), F.lit(False))
    return nodes.withColumn("_k", kept | near).where("_k").drop("_k")
