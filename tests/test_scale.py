"""Operators that must not gather a scene, a coast or all reports in one task: results on hard inputs, and plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import detections as det
from tidemark.operators import linked, lookup, products, raster, tracks, zones


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("values", ["random", "ties", "outliers", "one", "few"])
def test_exact_quantiles(spark, values):
    rng = np.random.default_rng(1)
    v = {"random": rng.normal(size=9000), "ties": rng.integers(0, 4, 9000).astype(float), "outliers": np.r_[rng.normal(size=8990), [3.4e38] * 5, [-3.4e38] * 5], "one": np.full(500, 7.0), "few": np.array([3.0, 1.0, 2.0])}[values]
    rows = [(0, float(x)) for x in v] + [(1, None), (1, float("nan"))] + [(2, 5.0)]
    df = spark.createDataFrame(rows, "scene_id long, v double").repartition(4)
    shares = [0.0, 0.01, 0.25, 0.5, 0.98, 1.0]
    got = {r.scene_id: [r[f"q{k}"] for k in range(len(shares))] for r in raster.quantiles(df, "v", shares).collect()}
    assert np.allclose(got[0], np.quantile(v, shares), rtol=1e-12, atol=0)
    assert got[1] == [None] * 6 and got[2] == [5.0] * 6


def test_quantiles_sort_no_scene(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("scene_id"), F.col("id").cast("double").alias("v"))
    assert "percentile(" not in plan(raster.quantiles(df, "v", [0.5])) and "percentile(" not in plan(raster.stretched(df.withColumn("row", F.col("id") if "id" in df.columns else F.lit(0)), "v"))


def crossing(x, y, rings):
    odd, on = False, False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            turn = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
            on |= turn == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by)
            odd ^= (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return odd and not on


def test_zones_with_long_coasts_and_holes(spark):
    rng = random.Random(2)
    coast = [(50 * np.cos(t) * (1 + 0.2 * np.sin(17 * t)), 50 * np.sin(t)) for t in np.linspace(0, 2 * np.pi, 400, endpoint=False).tolist()]
    shapes = {0: [[(float(x), float(y)) for x, y in coast], [(-5.0, -5.0), (5.0, -5.0), (5.0, 5.0), (-5.0, 5.0)]], 1: [[(0.0, 0.0), (40.0, 0.0), (40.0, 40.0), (0.0, 40.0)]], 2: []}
    table = spark.createDataFrame([(k, 10 + k, [[{"x": x, "y": y} for x, y in r] for r in rings]) for k, rings in shapes.items()], "zone_ord int, zone_no int, rings array<array<struct<x:double,y:double>>>")
    points = [(k, float(rng.randint(-70, 70)), float(rng.randint(-70, 70))) for k in range(3000)] + [(3000, 40.0, 20.0), (3001, 0.0, 0.0), (3002, 5.0, 1.0)]
    df = spark.createDataFrame(points, "id long, x double, y double").repartition(3)
    want = {k: next((10.0 + z for z, rings in shapes.items() if rings and crossing(x, y, rings)), -1.0) for k, x, y in points}
    for cell, bands in ((20.0, 16), (7.0, 1), (500.0, 64)):
        out = zones.zone_of(df, table, cell, bands)
        assert {r.id: r.zone for r in out.collect()} == want
    assert len(set(want.values())) == 3


def test_places_without_one_window_over_all(spark):
    rng = random.Random(3)
    seq = rng.sample(range(10**6), 5000)
    out = tracks.numbered(spark.createDataFrame([(s,) for s in seq], "seq long").repartition(7), "seq")
    assert {r.seq: r.place for r in out.collect()} == {s: k + 1 for k, s in enumerate(sorted(seq))}
    assert tracks.numbered(spark.createDataFrame([], "seq long"), "seq").count() == 0


def test_grids_are_joined_once(spark):
    nodes = spark.range(12).select(F.lit(0).alias("scene_id"), (F.floor(F.col("id") / 4) * 10).alias("node_row"), (F.col("id") % 4 * 5).alias("node_col"))
    nodes = nodes.withColumn("v", F.col("node_row") * 2.0 + F.col("node_col") * 3.0)
    pixels = spark.range(25 * 18).select(F.lit(0).alias("scene_id"), (F.floor(F.col("id") / 18) - 1).alias("row"), (F.col("id") % 18 - 1).alias("col"))
    out = products.on_grid(pixels, nodes, ["v"])
    assert set(out.columns) == {"scene_id", "row", "col", "v"}
    for r in out.collect():
        inside = 0 <= r.row <= 20 and 0 <= r.col <= 15
        assert r.v == pytest.approx(r.row * 2 + r.col * 3) if inside else r.v is None


def test_tie_points_by_cell(spark):
    """A turned and bent grid: positions of known places are found again."""
    place = lambda r, c: (34 + r * 1e-3 - c * 2e-4 + r * c * 1e-7, 126 + c * 1e-3 + r * 3e-4)
    nodes = spark.createDataFrame([(0, r, c, *place(r, c)) for r in range(0, 401, 40) for c in range(0, 501, 50)], "scene_id long, node_row long, node_col long, lat double, lon double")
    rng = random.Random(5)
    known = {k: (rng.uniform(0, 400), rng.uniform(0, 500)) for k in range(300)}

    def bent(r, c):  # bilinear within its cell
        r0, c0 = min(r // 40, 9) * 40, min(c // 50, 9) * 50
        t, u = (r - r0) / 40, (c - c0) / 50
        four = [place(r0 + i, c0 + j) for i in (0, 40) for j in (0, 50)]
        return [(a * (1 - u) + b * u) * (1 - t) + (d * (1 - u) + e * u) * t for a, b, d, e in zip(*four)]

    points = spark.createDataFrame([(0, k, *bent(*rc)) for k, rc in known.items()] + [(0, 900, 10.0, 10.0), (1, 901, 34.1, 126.1)], "scene_id long, id long, lat double, lon double").repartition(3)
    got = {r.id: (r.row, r.col) for r in products.index_of(points, nodes).collect()}
    assert got.pop(900) == got.pop(901) == (None, None)
    assert all(got[k] == pytest.approx(known[k], abs=1e-5) for k in known)


def test_components_of_several_graphs(spark):
    edges = [(g, a + 1, a) for g in (1, 2) for a in range(60)] + [(1, 200, 100), (2, 100, 200), (2, 60, 100), (3, 5, 5)]
    out = linked.components(spark.createDataFrame(edges, "g int, a long, b long").repartition(3), ["g"])
    got = {(r.g, r.node): r.component for r in out.collect()}
    want = {(g, k): 0 for g in (1, 2) for k in range(1, 61)} | {(1, 200): 100, (2, 100): 0, (2, 200): 0}
    assert got == want


def test_class_range_pool_and_columns(spark):
    boxes = spark.createDataFrame([(0, k, k % 5 - 1, float(k)) for k in range(20)], "image_id long, det_id long, cls int, conf double")
    assert sorted(r.det_id for r in det.in_classes(boxes, 2).collect()) == [k for k in range(20) if k % 5 - 1 in (0, 1)]
    assert sorted(r.det_id for r in det.in_classes(boxes, 2, most=3).collect()) == [1, 2, 6]
    assert det.pooled(boxes, boxes.limit(0), boxes.where("det_id < 3")).groupBy("source").count().orderBy("source").collect() == [(0, 20), (2, 3)]
    assert [r.det_id for r in det.reversed_order(boxes).collect()] == list(range(19, -1, -1))
    assert [r.cls for r in lookup.unique(boxes, "cls").collect()] == [-1, 0, 1, 2, 3]
    both = det.beside(boxes.select("det_id", "conf"), spark.createDataFrame([(19, "x"), (40, "y")], "det_id long, t string"), "det_id").collect()
    assert len(both) == 21 and {r.t: r.conf for r in both if r.t} == {"x": 19.0, "y": None}


def test_suppression_takes_one_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("image_id"), F.col("id").alias("det_id"), F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), F.lit(1.0).alias("x2"), F.lit(1.0).alias("y2"), F.lit(0.5).alias("conf"), (F.col("id") % 2).cast("int").alias("cls"))
    out = det.suppressed(rows)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted((r.image_id, r.det_id) for r in out.collect()) == sorted({(k % 3, min(j for j in range(100) if j % 3 == k % 3 and j % 2 == k % 2)) for k in range(100)})
