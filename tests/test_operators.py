import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import alignment, lookup, products, proximity, raster, tiles, tracks, zones
from tidemark.operators import detections as det
from tidemark.plans import pipelines as pipe

DEGREE = math.degrees(1 / 6_371_000)  # of a metre


def points(spark, rows):
    return spark.createDataFrame([(i, float(lon), float(lat)) for i, lon, lat in rows], "id long, lon double, lat double")


def ids(df, name="id"):
    return sorted(r[name] for r in df.select(name).collect())


# ---- proximity


def test_threshold_is_strict(spark):
    left = points(spark, [(1, 129, 35), (2, 129.5, 35), (3, 130, 35)])
    right = points(spark, [(1, 129, 35 + 199.99 * DEGREE), (2, 129.5, 35 + 200.01 * DEGREE), (3, 130, 35)])
    assert ids(proximity.not_near(left, right)) == [2] and ids(proximity.near(left, right)) == [1, 3]
    near = {r.left_id: r for r in proximity.nearest(left, right).collect()}
    assert near[3].metres == 0 and near[1].metres == pytest.approx(199.99, abs=1e-3)
    exact = proximity.pairs_within(left.where("id = 1"), right.where("id = 1"), 1e9).first().metres
    assert ids(proximity.not_near(left.where("id = 1"), right.where("id = 1"), exact)) == [1]


def test_nearest_takes_the_smaller_id_of_equals(spark):
    left = points(spark, [(1, 0, 0)])
    right = points(spark, [(7, 0.001, 0), (4, -0.001, 0), (9, 0.0005, 5)])
    assert proximity.nearest(left, right, 500).first().right_id == 4


def test_empty_and_null_sides(spark):
    left = spark.createDataFrame([(1, 129.0, 35.0), (2, None, 35.0)], "id long, lon double, lat double")
    assert ids(proximity.not_near(left, left.limit(0))) == [1, 2] and ids(proximity.not_near(left, left)) == [2]


@pytest.mark.parametrize("metres", [50.0, 900.0, 40_000.0, 3_000_000.0])
def test_grid_equals_nested_loop_everywhere(spark, metres):
    rng = random.Random(int(metres))
    where = [(rng.uniform(-180, 180), rng.choice([rng.uniform(-90, 90), 89.99, -89.99, 0.0])) for _ in range(150)]
    where += [(180 - 1e-5, 10.0), (-180 + 1e-5, 10.0), (180.0, -45.0), (-180.0, -45.0), (0.0, 90.0), (90.0, 90.0)]
    shift = metres * DEGREE
    near = [(lon + rng.uniform(-1.2, 1.2) * shift / max(0.01, math.cos(math.radians(lat))), max(-90, min(90, lat + rng.uniform(-1.2, 1.2) * shift))) for lon, lat in where]
    near = [((lon + 180) % 360 - 180, lat) for lon, lat in near]
    left, right = points(spark, [(k, *p) for k, p in enumerate(where)]), points(spark, [(k, *p) for k, p in enumerate(near)])
    assert ids(proximity.not_near(left, right, metres)) == ids(proximity.not_near_by_nested_loop(left, right, metres))


# ---- zones


def ring(*xy):
    return [{"x": float(x), "y": float(y)} for x, y in xy]


def test_zones(spark):
    square = lambda a, b: ring((a, a), (b, a), (b, b), (a, b))
    rows = [(0, 11, [square(0, 10)]), (1, 12, [square(5, 15)]), (2, 0, [square(20, 30)]), (3, 14, [square(40, 60), square(45, 55)]), (4, None, [square(70, 80)])]
    zs = spark.createDataFrame(rows, "zone_ord int, zone_no int, rings array<array<struct<x: double, y: double>>>")
    at = [(1, 2, 2, 11), (2, 7, 7, 11), (3, 12, 12, 12), (4, 10, 12, 12), (5, 0, 5, -1), (6, 5, 0, -1), (7, 25, 25, -1), (8, 42, 42, 14), (9, 50, 50, -1), (10, 45, 50, -1), (11, 75, 75, -1), (12, 99, 99, -1), (13, 10, 10, 12), (14, 0, 0, -1)]
    ps = spark.createDataFrame([(i, float(x), float(y)) for i, x, y, _ in at], "id long, x double, y double")
    for cell in (3.0, 50_000.0):
        assert {r.id: r.zone for r in zones.zone_of(ps, zs, cell).collect()} == {i: float(z) for i, _, _, z in at}
    turned = zs.withColumn("rings", F.transform("rings", lambda r: F.concat(F.slice(r, 3, 2), F.slice(r, 1, 2))))
    assert {r.id: r.zone for r in zones.zone_of(ps, turned).collect()} == {i: float(z) for i, _, _, z in at}


# ---- tracks

SCENE = "SELECT 1L scene_id, 126.0D min_lon, 0.01D dlon, 126.5D max_lon, 34.5D max_lat, 34.0D min_lat, -0.01D dlat, 51 xsize, 51 ysize, 1000.0D start_s, 1100.0D end_s, {up} ascending"
PING = "seq long, mmsi long, epoch double, lon double, lat double, sog double, cog double, name string, kind string, destination string, dim_a double, dim_b double, dim_c double, dim_d double"


def ping(seq, mmsi, epoch=1050.0, lon=126.2, lat=34.2, sog=10.0, cog=0.0, dim=1.0):
    return (seq, mmsi, float(epoch), float(lon), float(lat), float(sog), float(cog), f"n{seq}", f"k{seq}", f"d{seq}", dim, 0.0, 0.0, 0.0)


def test_scene_filter_ends_are_inside(spark):
    rows = [ping(1, 1, 400), ping(2, 1, 1700), ping(3, 1, 399), ping(4, 1, 1701), ping(5, 1, lon=126.0, lat=34.0), ping(6, 1, lon=126.5, lat=34.5), ping(7, 1, lon=126.51), ping(8, 1, 0)]
    got = tracks.in_scene(spark.createDataFrame(rows, PING), spark.sql(SCENE.format(up="true")))
    assert ids(got, "seq") == [1, 2, 5, 6]
    zero = spark.createDataFrame([ping(1, 1, lon=0, lat=0)], PING)
    wide = spark.sql("SELECT 1L scene_id, -1D min_lon, 1D max_lon, -1D min_lat, 1D max_lat, 1000D start_s, 1100D end_s")
    assert tracks.in_scene(zero, wide).count() == 0 and tracks.in_scene(zero, wide, zero_is_missing=False).count() == 1


@pytest.mark.parametrize("n, k", [(1, 0), (2, 1), (3, 2), (4, 2), (5, 2), (6, 3), (7, 4)])
def test_middle_row(spark, n, k):
    df = spark.createDataFrame([(7, s, 100 - s) for s in range(n)], "mmsi long, seq long, epoch long")
    assert tracks.middle_row(df, ["mmsi"]).first().seq == k


def test_synchronised(spark):
    rows = [ping(1, 5, 2, dim=9.0), ping(2, 5, 1050, lat=34.25, sog=10, cog=90), ping(3, 0), ping(4, 8, lat=34.0, lon=126.1, cog=0)]
    df, up, down = spark.createDataFrame(rows, PING), spark.sql(SCENE.format(up="true")), spark.sql(SCENE.format(up="false"))
    got = {r.mmsi: r for r in tracks.synchronised(df, up).collect()}
    assert set(got) == {5}  # 0 is no ship, and 8 lies on a line that the scene doesn't have
    r = got[5]
    assert r.sar_s == pytest.approx(1100 - 100 * 26 / 50) and r.dim_a == 9.0 and r["name"] == "n2"
    assert r.lat == pytest.approx(34.25) and r.lon == pytest.approx(126.2 + (r.sar_s - 1050) * 5.144 / 111_000) and (r.date, r.time) == ("1970-01-01", "00:17:28")
    assert {x.mmsi: x.sar_s for x in tracks.synchronised(df, down).collect()}[5] == pytest.approx(1000 + 100 * 26 / 50)
    assert {x.mmsi: x["name"] for x in tracks.synchronised(df, up, shifted_lookup=True).collect()} == {5: "n1"}


def test_azimuth_shift(spark):
    ship = spark.createDataFrame([(1, 126.2, 34.2, 5.0, 79.0), (1, 126.5, 34.2, 5.0, 79.0)], "scene_id long, lon double, lat double, sog double, cog double")
    a, gone = tracks.azimuth_shifted(ship, spark.sql(SCENE.format(up="true"))).collect()
    share = 21 / 50
    away = 5 * math.sin(math.radians(79 - 349)) * (788_000 + 148_000 * share) * math.cos(math.radians(30 + 15 * share)) / 7600
    assert a.lat == pytest.approx(34.2 + away * math.cos(math.radians(349)) / 111_000) and a.lon == pytest.approx(126.2 + away * math.sin(math.radians(349)) / 111_000)
    assert gone.lat is None
    left = tracks.azimuth_shifted(ship, spark.sql(SCENE.format(up="true")), right_looking=False).first()
    assert left.lat - 34.2 == pytest.approx(34.2 - a.lat)


# ---- tiles


@pytest.mark.parametrize("length, want", [(640, [0]), (1080, [0]), (1081, [0, 440]), (2000, [0, 440, 880, 1320])])
def test_overlapping_starts(spark, length, want):
    inside, every = spark.range(1).select(tiles.overlapping_starts(F.lit(length)), tiles.overlapping_starts(F.lit(length), cover_edges=True)).first()
    starts = list(range(0, length, 440))
    starts[-1] = length - 640
    assert every == sorted(starts) and inside == sorted(starts)[:-1]
    assert len(want) <= len(inside) + 1


@pytest.mark.parametrize("length", [100, 101, 104, 99])
def test_divided_tiles_cover(spark, length):
    scenes = spark.createDataFrame([(1, length, length)], "scene_id long, height int, width int")
    rows = tiles.divided_tiles(scenes, 5).collect()
    area = sum((r.x2 - r.x1) * (r.y2 - r.y1) for r in rows)
    assert area == length * length and max(r.x2 for r in rows) == length


def test_padded_and_dealt(spark):
    scenes = spark.createDataFrame([(1, 100, 65)], "scene_id long, height int, width int")
    assert sorted((r.x1, r.y1) for r in tiles.padded_tiles(scenes, 64).collect()) == [(0, 0), (0, 64), (64, 0), (64, 64)]
    px = spark.createDataFrame([(1, 5, 63, 0.0), (1, 5, 64, 2.0)], "scene_id long, row int, col int, v double")
    assert sorted((r.col, r.x1) for r in tiles.dealt_pixels(px, 64, 32).collect()) == [(63, 0), (63, 32), (64, 32), (64, 64)]
    assert [(r.x1, r.n) for r in tiles.filled_tiles(px, "v", 64).collect()] == [(64, 1)]


def test_corner_on_a_shared_edge_counts_twice(spark):
    ts = tiles.padded_tiles(spark.createDataFrame([(1, 100, 200)], "scene_id long, height int, width int"), 100)
    box = spark.createDataFrame([(1, 1, 100.0, 50.0)], "scene_id long, box_id long, x double, y double")
    assert sorted(r.x1 for r in tiles.boxes_in_tiles(box, ts).collect()) == [0, 100]


# ---- rasters


def grid(spark, array, **more):
    rows = [(1, r, c, None if math.isnan(v) else float(v)) for (r, c), v in np.ndenumerate(np.asarray(array, float))]
    return spark.createDataFrame(rows, "scene_id long, row int, col int, v double")


def back(df, shape, name):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r.row, r.col] = math.nan if r[name] is None else r[name]
    return out


def test_means(spark):
    rows = [(1, 1.0), (1, -9.0), (1, math.nan), (1, None), (1, 3.0), (2, -9.0), (3, None)]
    df = spark.createDataFrame(rows, "scene_id long, v double")
    assert {r.scene_id: r.mean for r in raster.scene_mean(df, "v", -9.0).collect()} == {1: 2.0}
    assert {r.scene_id: r.mean for r in raster.scene_mean(df, "v").collect()} == {1: pytest.approx(-5 / 3), 2: -9.0}
    two = spark.createDataFrame([(1, 4.0, 2.0), (1, 1.0, 0.0), (1, None, 1.0)], "scene_id long, a double, b double")
    assert raster.ratio_mean(two, "a", "b").first().mean == 2
    s = {r.scene_id: r for r in raster.band_statistics(df, "v", -9.0).collect()}
    assert s[1].valid_percent == 40 and s[1].std == 1 and s[2].mean is None


def test_gaps(spark):
    a = np.array([[math.nan, 1, math.nan], [math.nan, 4, math.nan]])
    got = back(raster.gaps_filled(grid(spark, a).withColumn("width", F.lit(3)), "v"), a.shape, "v")
    assert np.allclose(got, [[1, 1, 2], [3, 4, 4]])
    nothing = raster.gaps_filled(grid(spark, np.full((2, 2), math.nan)).withColumn("width", F.lit(2)), "v")
    assert all(r.v is None for r in nothing.collect())


def test_stretch_and_normalise(spark):
    df = grid(spark, np.arange(101.0)[None])
    got = back(raster.stretched(df, "v", 0.0, 1.0), (1, 101), "byte")[0]
    assert got[0] == 0 and got[100] == 255 and got[50] == 127
    assert {r.byte for r in raster.stretched(grid(spark, np.ones((2, 2))), "v").collect()} == {None}
    assert {r.unit for r in raster.normalised(grid(spark, np.zeros((2, 2))), "v", ["scene_id"]).collect()} == {0.0}


def test_windows_and_tiles_agree_with_whole_arrays(spark):
    from tidemark.functions import kernels

    a = np.random.default_rng(2).random((23, 31))
    inner = back(raster.boxcar_inside(grid(spark, a), "v", 3), a.shape, "smooth")
    whole = kernels.boxcar(a, 3)
    assert np.allclose(inner[1:-1, 1:-1], whole[1:-1, 1:-1]) and np.isnan(inner[0]).all()
    tiled = back(raster.by_tile(grid(spark, a), "v", lambda x: kernels.gaussian(np.nan_to_num(x), 1.0), 6, tile=8), a.shape, "out")
    assert np.allclose(tiled[6:-6, 6:-6], kernels.gaussian(a, 1.0)[6:-6, 6:-6])


@pytest.mark.parametrize("tile", [4, 7, 64])
def test_components(spark, tile):
    rng = np.random.default_rng(tile)
    a = rng.random((40, 37)) < 0.38
    a[3, :] = True
    label, todo = np.zeros(a.shape, int), [tuple(p) for p in np.argwhere(a)]
    for p in todo:
        if not label[p]:
            stack, label[p] = [p], p[0] * 1000 + p[1] + 1
            while stack:
                r, c = stack.pop()
                for i in range(max(0, r - 1), min(40, r + 2)):
                    for j in range(max(0, c - 1), min(37, c + 2)):
                        if a[i, j] and not label[i, j]:
                            label[i, j] = label[p]
                            stack.append((i, j))
    flags = spark.createDataFrame([(1, int(r), int(c)) for r, c in todo], "scene_id long, row int, col int")
    got = {(r.row, r.col): r.blob for r in raster.components(flags, tile).collect()}
    groups = {}
    for p, b in got.items():
        groups.setdefault(b, set()).add(p)
    want = {}
    for p in todo:
        want.setdefault(int(label[p]), set()).add(tuple(map(int, p)))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    large = {(r.row, r.col) for r in raster.large_blobs(flags, 30, tile).collect()}
    assert large == set().union(*(g for g in want.values() if len(g) >= 30))
    assert raster.components(flags.limit(0), tile).count() == 0


def test_calibration_slices_and_margins(spark):
    nodes = spark.createDataFrame([(1, r, c, 1.0 + r + c) for r in (0, 4) for c in (0, 2, 6)], "scene_id long, node_row int, node_col int, factor double")
    px = grid(spark, np.arange(40.0).reshape(5, 8))
    got = back(raster.calibrated(px, nodes, "v"), (5, 8), "sigma")
    r, c = np.indices((5, 8))
    assert np.allclose(got[:, :7], ((np.arange(40).reshape(5, 8) / (1 + r + c)) ** 2)[:, :7]) and np.isnan(got[:, 7]).all()
    cut = raster.sliced(px, (1, 5, 2), (0, 8, 3)).collect()
    assert sorted((x.row, x.col, x.v) for x in cut) == [(0, 0, 8), (0, 1, 11), (0, 2, 14), (1, 0, 24), (1, 1, 27), (1, 2, 30)]


def test_elevation(spark):
    dem = spark.createDataFrame([(0, 0, 5.0), (0, 1, -2.0)], "grid_row long, grid_col long, value double").withColumns({"lon0": F.lit(0.0), "lat0": F.lit(1.0), "step": F.lit(1.0)})
    scenes = spark.createDataFrame([(1, 1, 3, 0.0, 1.0, 1.0, -1.0)], "scene_id long, height int, width int, min_lon double, dlon double, max_lat double, dlat double")
    assert [(r.col, r.value, r.water) for r in raster.resampled(scenes, dem).orderBy("col").collect()] == [(0, 5.0, 0), (1, -2.0, 1), (2, 0.0, 1)]


def test_change_mask(spark):
    rows = [(1, r, c, 0.2 + 0.001 * r, 0.3, 0.1, 0.2 + 0.001 * c) for r in range(12) for c in range(12)] + [(1, 20, 20, None, 0.3, 0.1, 0.2)]
    df = spark.createDataFrame(rows, "scene_id long, row int, col int, vh double, vv double, vh2 double, vv2 double")
    got = {(r.row, r.col): r for r in pipe.change_mask(df, tile=5).collect()}
    assert len(got) == 145 and got[20, 20].flag is False and got[20, 20].written_mask == 1
    assert all(r.flag == (r.statistic >= 0) for k, r in got.items() if k != (20, 20))
    assert all(r.written_mask == (0 if r.flag else 1) for r in got.values())


# ---- detections

BOX = "image_id long, det_id long, x1 double, y1 double, x2 double, y2 double, conf double, cls int"


def boxes(spark, rows):
    return spark.createDataFrame([(im, i, float(a), float(b), float(c), float(d), float(s), k) for im, i, a, b, c, d, s, k in rows], BOX)


def test_suppression(spark):
    df = boxes(spark, [(1, 1, 0, 0, 10, 10, 0.9, 0), (1, 2, 1, 1, 10, 10, 0.8, 0), (1, 3, 1, 1, 10, 10, 0.7, 1), (1, 4, 20, 20, 30, 30, 0.5, 0), (1, 5, 20, 20, 30, 30, 0.5, 0), (2, 6, 0, 0, 10, 10, 0.1, 0)])
    once = det.suppressed(df)
    assert ids(once, "det_id") == [1, 3, 4, 6] and ids(det.suppressed(once), "det_id") == [1, 3, 4, 6]
    at = boxes(spark, [(1, 1, 0, 0, 10, 10, 0.9, 0), (1, 2, 0, 0, 10, 5, 0.8, 0)])  # overlap exactly one half
    assert ids(det.suppressed(at, 0.5), "det_id") == [1, 2] and ids(det.suppressed(at, 0.4999), "det_id") == [1] and ids(det.suppressed(at, 0.6, smaller=True), "det_id") == [1]
    many = boxes(spark, [(1, k, 20 * k, 0, 20 * k + 5, 5, k / 1000, 0) for k in range(400)])
    assert det.suppressed(many).count() == 300 and det.suppressed(many, most_in=None, most_out=None).count() == 400


def test_chain_of_overlaps_is_greedy(spark):
    df = boxes(spark, [(1, 1, 0, 0, 10, 10, 0.9, 0), (1, 2, 4, 0, 14, 10, 0.8, 0), (1, 3, 8, 0, 18, 10, 0.7, 0)])
    assert ids(det.suppressed(df, 0.3), "det_id") == [1, 3] and ids(det.outdone(df, 0.3), "det_id") == [2, 3]


def test_candidates(spark):
    schema = "image_id long, det_id long, cx double, cy double, w double, h double, obj double, scores array<double>"
    rows = [(1, 1, 5.0, 5.0, 4.0, 2.0, 0.5, [0.2, 0.9, 0.9]), (1, 2, 0.0, 0.0, 1.0, 1.0, 0.05, [1.0, 1.0, 1.0]), (1, 3, 0.0, 0.0, 1.0, 1.0, 0.06, [0.1, 0.1, 0.1])]
    df = spark.createDataFrame(rows, schema)
    r = det.candidates(df).collect()
    assert [(x.det_id, x.cls, x.x1, x.y2) for x in r] == [(1, 1, 3.0, 6.0)] and r[0].conf == pytest.approx(0.45)
    assert det.candidates(df, multi_label=True).count() == 3 and det.candidates(df, classes=[0]).count() == 0
    single = spark.createDataFrame([(1, 1, 0.0, 0.0, 1.0, 1.0, 0.3, [0.5])], schema)
    assert det.candidates(single).first().conf == 0.3


def test_masks_and_training_boxes(spark):
    mask = spark.createDataFrame([(1, r, c, 0 if c == 5 else 1) for r in range(8) for c in range(8)], "image_id long, row int, col int, water int")
    df = boxes(spark, [(1, 1, 0, 0, 3, 3, 0.9, 0), (1, 2, 1, 1, 5, 3, 0.9, 0), (1, 3, 6, 6, 9, 7, 0.9, 0)])
    assert ids(det.on_water(df, mask), "det_id") == [1]
    assert ids(det.off_shore(df, mask.where("water = 0 or col = 3")), "det_id") == [1, 3]
    px = spark.createDataFrame([(1, r, c, float(c)) for r in range(10) for c in range(10)], "image_id long, row int, col int, value double")
    bs = spark.createDataFrame([(1, 1, 6, 2, 3, 3), (1, 2, 1, 2, 3, 3), (1, 3, 0, 2, 10, 3), (1, 4, 50, 50, 3, 3)], "image_id long, box_id long, x int, y int, w int, h int")
    assert ids(det.bright_boxes(bs, px), "box_id") == [1, 4] and ids(det.bright_boxes(bs, px, keep_zero=True), "box_id") == [1, 3, 4]


def test_model_hook_and_outputs(spark):
    ts = spark.createDataFrame([(1, 2, 2, [1.0, 2.0, 3.0, 4.0]), (2, 1, 2, [5.0, 6.0])], "tile_id long, h int, w int, pixels array<double>")
    got = {r.tile_id: r.output for r in det.predicted(ts, lambda x: x * 2).collect()}
    assert got == {1: [2, 4, 6, 8], 2: [10, 12]}
    scenes = spark.createDataFrame([(1, 126.0, 0.01, 35.0, -0.01)], "scene_id long, min_lon double, dlon double, max_lat double, dlat double")
    schema = "image_id long, tile_id long, x0 double, y0 double, det_id long, cx double, cy double, w double, h double, obj double, scores array<double>"
    raw = spark.createDataFrame([(1, 0, 100.0, 0.0, 1, 5.0, 5.0, 2.0, 4.0, 0.9, [0.1, 0.9])], schema)
    r = pipe.facilities_of(raw, scenes, {0: "a", 1: "b"}).first()
    assert (round(r.LatMin, 6), round(r.LonMin, 6), round(r.LatMax, 6), round(r.LonMax, 6), r.Class) == (34.93, 127.04, 34.97, 127.06, "b")
    s = pipe.ships_of(boxes(spark, [(1, 1, 10, 20, 30, 40, 0.9, 0)]), scenes).first()
    assert (s.X, s.W, round(s.Lon, 6), round(s.Lat, 6)) == (10, 20, 126.2, 34.7)


# ---- lookups


def test_lookups(spark):
    a = spark.createDataFrame([("vv", 0, 1), ("VV", 1, 2), ("VH", 0, 3)], "pol string, idx int, x int")
    both = lookup.by_polarisation({"a": a, "b": a.where("pol != 'VH'")}).collect()
    assert [(r.pol, r.a.x, r.b.x) for r in both] == [("VV", 2, 2)]
    for n, want in ((1, 0), (2, 0), (3, 1), (4, 1), (5, 1), (6, 2), (7, 3)):
        rows = spark.createDataFrame([(1, k) for k in range(n)], "g int, k int")
        assert lookup.middle_of_sorted(rows, ["g"], "k").first().k == want


def test_polynomial(spark):
    rows = spark.createDataFrame([(g, float(x), 1 + 2 * x - 0.5 * x**2 + 0.1 * x**3) for g in (1, 2) for x in range(9)] + [(3, 1.0, 1.0)], "g int, x double, y double")
    got = {r.g: (r.c0, r.c1, r.c2, r.c3) for r in lookup.polynomial(rows, ["g"], "x", "y").collect()}
    assert got[1] == pytest.approx((1, 2, -0.5, 0.1)) and got[3] == (None,) * 4


def test_alignment(spark):
    rng = np.random.default_rng(5)
    a = rng.random((40, 40))
    b = np.roll(a, (2, -1), (0, 1))
    rows = [(1, r, c, float(a[r, c]), float(b[r, c])) for r in range(40) for c in range(40)]
    df = spark.createDataFrame(rows, "scene_id long, row int, col int, a double, b double")
    shifts = alignment.patch_shifts(df, "a", "b", 16, 10)
    assert shifts.count() == 4
    r = alignment.scene_shift(alignment.patch_shifts(df, "a", "b", 20, 10), 1).first()
    assert (r.shift_row, r.shift_col) == (pytest.approx(-2, abs=0.3), pytest.approx(1, abs=0.3))


# ---- products


def test_tie_points_there_and_back(spark):
    nodes = [(1, r, c, 35 - 0.001 * r - 0.0003 * c + 1e-8 * r * c, 129 + 0.001 * c + 0.0002 * r) for r in (0, 30, 70) for c in (0, 25, 60, 90)]
    grid_ = spark.createDataFrame(nodes, "scene_id long, node_row int, node_col int, lat double, lon double")
    at = [(1, k, r, c) for k, (r, c) in enumerate([(0, 0), (70, 90), (12, 33), (45, 60), (30, 25), (69, 1)])]
    points_ = spark.createDataFrame(at, "scene_id long, id long, row int, col int")
    there = products.on_grid(points_, grid_, ["lat", "lon"])
    back_ = {x.id: (x.row, x.col) for x in products.index_of(there, grid_).collect()}
    assert all(back_[k] == pytest.approx((r, c), abs=1e-5) for _, k, r, c in at)
    far = spark.createDataFrame([(1, 9, 50.0, 50.0), (2, 8, 35.0, 129.0)], "scene_id long, id long, lat double, lon double")
    assert all(x.row is None for x in products.index_of(far, grid_).collect())
    outside = spark.createDataFrame([(1, 1, 71, 0)], "scene_id long, id long, row int, col int")
    assert products.on_grid(outside, grid_, ["lat"]).first().lat is None
    sizes = spark.createDataFrame([(1, 70, 90)], "scene_id long, ysize int, xsize int")
    mid = there.where("id = 2").first()
    w = products.window_around(sizes, grid_, mid.lat, mid.lon, 40, 20).first()
    assert (w.row0, w.row1, w.col0, w.col1) == (0, 32, 23, 43)


def test_nodes_of_an_image(spark):
    nodes = spark.createDataFrame([(1, r, c) for r in (0, 10, 20, 30, 40) for c in (0, 10, 20)], "scene_id long, node_row int, node_col int")
    kept = products.cropped_nodes(nodes, 25, 15).collect()
    assert sorted({x.node_row for x in kept}) == [0, 10, 20, 30] and sorted({x.node_col for x in kept}) == [0, 10, 20]


def test_padded_inference(spark):
    a = np.arange(30.0).reshape(5, 6)
    px = grid(spark, a).withColumnRenamed("v", "b1").withColumn("b2", F.lit(60.0))
    shapes_ = set()

    def model(x):
        shapes_.add(x.shape)
        return x[0] + x[1]

    got = back(products.spills(px, lambda x: x[0] + x[1], 4), (5, 6), "output")
    want = np.minimum(a, 0.1) / 0.1 + 1
    want[0, 0] = 0
    assert np.allclose(got, want) and model(np.zeros((2, 4, 4))).shape == (4, 4)


def test_coregistration(spark):
    from tidemark.functions import kernels

    rng = np.random.default_rng(8)
    a = kernels.gaussian(rng.random((80, 80)), 0.7) * 100
    b = kernels.moved(np.pad(a, 10, mode="wrap"), 1.4, -2.3)[10:-10, 10:-10]
    out = products.coregistered(grid(spark, a), grid(spark, b), "v", patch=40, degree=1, tile=48)
    moved = back(out, a.shape, "out")
    inner = (slice(8, -8), slice(8, -8))
    assert np.corrcoef(moved[inner].ravel(), a[inner].ravel())[0, 1] > 0.97 > np.corrcoef(b[inner].ravel(), a[inner].ravel())[0, 1] + 0.5
    r = out.where("shift_row is not null").first()
    assert (r.shift_row, r.shift_col) == (pytest.approx(1.4, abs=0.2), pytest.approx(-2.3, abs=0.2))


def test_saved_products(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    products.save(str(tmp_path), bands=df, grid=df)
    assert products.load(spark, str(tmp_path), "bands", "grid")["grid"].first().b == 2
