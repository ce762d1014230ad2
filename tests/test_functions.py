import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import boxes as bx
from tidemark.functions import geo, kernels, statistics, strings
from tidemark.functions import radiometry as rad


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def lit(*values):
    return [F.lit(v) for v in values]


def test_distances(spark):
    r = one(spark, zero=geo.haversine_m(*lit(35.0, 129.0, 35.0, 129.0)), degree=geo.haversine_m(*lit(0.0, 0.0, 0.0, 1.0)), back=geo.haversine_m(*lit(0.0, 1.0, 0.0, 0.0)), half=geo.haversine_m(*lit(0.0, 0.0, 0.0, 180.0)), extent=geo.metres_of_degrees(F.lit(1.0)))
    assert r.zero == 0 and r.degree == r.back == pytest.approx(111194.9266, abs=1e-3)
    assert r.half == pytest.approx(math.pi * 6_371_000) and r.extent == pytest.approx(111194.9266 * math.cos(math.radians(35)), abs=1e-3)


def test_geodesic(spark):
    df = spark.createDataFrame([(50.06632, -5.71475, 58.64402, -3.07009), (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.5, 179.7), (None, 0.0, 0.0, 0.0)], "a double, b double, c double, d double")
    got = [r.m for r in df.select(geo.geodesic_m("a", "b", "c", "d").alias("m")).collect()]
    assert got[0] == pytest.approx(969_954.166, abs=0.01) and got[1] == 0 and got[2] is None and got[3] is None


def scene(spark):
    return spark.sql("SELECT 126.0D min_lon, 0.1D dlon, 126.5D max_lon, 34.5D max_lat, 34.0D min_lat, -0.1D dlat")


def test_pixels_count_from_one(spark):
    y, x = geo.pixel_of(F.col("lat"), F.col("lon"))
    rows = spark.createDataFrame([(34.5, 126.0), (34.0, 126.5), (34.2, 126.25)], "lat double, lon double").crossJoin(scene(spark)).select(y.alias("y"), x.alias("x")).collect()
    assert [(round(r.y, 9), round(r.x, 9)) for r in rows] == [(1, 1), (6, 6), (4, 3.5)]


def test_dead_reckoning_and_mercator(spark):
    lat, lon = geo.dead_reckoned(*lit(10.0, 20.0, 11.1, 90.0, 100.0))
    x, y = geo.web_mercator(*lit(180.0, 0.0))
    r = one(spark, lat=lat, lon=lon, x=x, y=y)
    assert (r.lat, r.lon) == (pytest.approx(10.0), pytest.approx(20.01)) and r.x == pytest.approx(20037508.342789244) and abs(r.y) < 1e-6


@pytest.mark.parametrize("value, want", [(-0.5, 0.991), (0.0, 0.996), (0.1999, 0.996), (0.2, 0.973), (0.35, 0.996 * 0.25 + 0.973 * 0.75), (0.5, 0.973), (0.9, 0.973)])
def test_emissivity(spark, value, want):
    assert one(spark, e=rad.emissivity(F.lit(value))).e == pytest.approx(want)


def test_temperature(spark):
    r = one(spark, dark=rad.brightness_temperature(F.lit(-300.0)), bt=rad.brightness_temperature(F.lit(25000.0)), flat=rad.ndvi(*lit(0.0, 0.0)), cancel=rad.ndvi(*lit(-3.0, 3.0)), rel=rad.ndvi(*lit(1.0, 3.0)))
    assert r.dark is None and r.bt == pytest.approx(1329.2405 / math.log(799.0284 / (0.00038 * 25000 + 0.1) + 1)) and r.flat == 0 and r.cancel == 0 and r.rel == 0.5
    t = config.Thermal(wavelength_term=0.0)
    edge = [one(spark, c=rad.surface_temperature(F.lit(v), F.lit(0.99), t)).c for v in (223.15 - 1e-6, 223.1500001, 353.1499999, 353.16)]
    assert edge[0] is None and edge[3] is None and edge[1] == pytest.approx(-50) and edge[2] == pytest.approx(80)


@pytest.mark.parametrize("word, cloud", [(0, False), (8, True), (16, True), (24, True), (32, False)])
def test_quality_bits(spark, word, cloud):
    assert one(spark, c=rad.cloudy(F.lit(word))).c is cloud


def test_log_ratio(spark):
    pair = lambda a, b, c, d: (tuple(lit(a, b)), tuple(lit(c, d)))
    r = one(spark, same=rad.log_ratio(*pair(1.0, 2.0, 1.0, 2.0)), some=rad.log_ratio(*pair(4.0, 3.0, 2.0, 1.0)), zero=rad.log_ratio(*pair(0.0, 3.0, 2.0, 1.0)), q=rad.log_likelihood(*pair(1.0, 1.0, 1.0, 1.0), 4.4))
    assert r.same == pytest.approx(-2 * math.log(1e-10) + 4 * math.log(2))
    assert r.some == pytest.approx(math.log(12) - math.log(2) - 2 * math.log(4) + 4 * math.log(2))
    assert r.zero == pytest.approx(math.log(1e-10) - math.log(2) - 2 * math.log(1e-10) + 4 * math.log(2)) and abs(r.q) < 1e-12


def test_missing_values_stay_missing(spark):
    nan, null = F.lit(math.nan), F.lit(None).cast("double")
    r = one(spark, nan=rad.known(nan), null=rad.known(null), nodata=rad.known(F.lit(-9999.0), -9999.0), ok=rad.known(F.lit(1.0), -9999.0), clip=rad.clipped(null, 0.0, 1.0), pol=rad.polarimetric(F.lit(0.0), F.lit(0.0)), neg=rad.polarimetric(F.lit(-1.0), F.lit(0.5)))
    assert r.nan is None and r.null is None and r.nodata is None and r.ok == 1 and r.clip is None and r.pol == 0 and r.neg == 0


def test_scaling(spark):
    c0, c1 = rad.oil_inputs(*lit(0.5, 30.0))
    r = one(spark, a=rad.unit_scaled(F.lit(9.0), 0.0, 0.5), b=rad.byte_scaled(F.lit(0.999), 0.0, 1.0), c0=c0, c1=c1, s=rad.softmax(F.array(*lit(1000.0, 1000.0))), g=rad.sigmoid(F.lit(0.0)))
    assert (r.a, r.b, r.c0, r.c1, r.s, r.g) == (1.0, 254, 1.0, 0.5, [0.5, 0.5], 0.5)


def box(*v):
    return bx.Box(*lit(*map(float, v)))


def test_overlaps(spark):
    a, b, far, dot = box(0, 0, 2, 2), box(1, 1, 3, 3), box(5, 5, 6, 6), box(1, 1, 1, 1)
    r = one(spark, iou=bx.iou(a, b), none=bx.iou(a, far), same=bx.giou(a, a), giou=bx.giou(a, far), diou=bx.diou(a, b), small=bx.over_smaller(a, box(0, 0, 1, 1)), empty=bx.iou(dot, dot), size=bx.size_iou(*lit(2.0, 2.0, 1.0, 4.0)), soft=bx.soft_iou(a, a, "ciou"), cos=bx.cosine_ciou(a, a), alpha=bx.alpha_iou(a, b))
    assert r.iou == pytest.approx(1 / 7) and r.none == 0 and r.same == 1 and r.giou == pytest.approx(-(36 - 5) / 36)
    assert r.diou == pytest.approx(1 / 7 - 2 / 18) and r.small == 1 and r.empty is None and r.size == pytest.approx(2 / 6)
    assert r.soft == pytest.approx(1, abs=1e-5) and r.cos == pytest.approx(1) and r.alpha == pytest.approx(1 / 49, abs=1e-6)


def test_collapsed_on_each_edge(spark):
    w, h = lit(10.0, 8.0)
    for v, want in (((2, 8, 5, 8), True), ((10, 1, 10, 4), True), ((2, 0, 5, 0), True), ((0, 1, 0, 4), True), ((0, 0, 1, 1), False)):
        assert one(spark, c=bx.collapsed(box(*v), w, h)).c is want


def test_box_forms(spark):
    cx, cy, w, h = bx.to_centre(box(1, 2, 5, 10))
    again = bx.from_centre(cx, cy, w, h)
    lettered = bx.unlettered(box(10, 20, 30, 40), 2.0, (2.0, 4.0), 12, 12)
    points = bx.of_points(F.array(F.struct(F.lit(1.0).alias("x"), F.lit(5.0).alias("y")), F.struct(F.lit(4.0).alias("x"), F.lit(2.0).alias("y"))))
    r = one(spark, back=F.array(*again), letter=F.array(*lettered), points=F.array(*points), flip=F.array(*bx.flipped(box(1, 2, 3, 4), F.lit(10.0))))
    assert r.back == [1, 2, 5, 10] and r.letter == [4, 8, 12, 12] and r.points == [1, 2, 4, 5] and r.flip == [7, 2, 9, 4]


def test_incomplete_gamma():
    assert statistics.gamma_cdf(1.0, np.array([0.0, 1.0, 2.0, np.inf])) == pytest.approx([0, 1 - math.exp(-1), 1 - math.exp(-2), 1])
    assert statistics.gamma_cdf(0.5, np.array([0.5])) == pytest.approx([math.erf(math.sqrt(0.5))])
    assert statistics.gamma_cdf(250.0, np.array([250.0, 500.0])) == pytest.approx([0.5084105, 1.0], abs=1e-6)
    assert np.isnan(statistics.gamma_cdf(2.0, np.array([-1.0, np.nan]))).all()
    assert math.log10(statistics.gamma_cdf(250.0, np.array([24.4]))[0]) == pytest.approx(-156, abs=1)


def test_f_quantile():
    assert statistics.f_quantile(0.5, 5, 5) == pytest.approx(1)
    assert statistics.f_quantile(0.95, 4, 10) == pytest.approx(3.47805, abs=1e-5)
    assert statistics.f_quantile(0.05, 10, 4) == pytest.approx(1 / 3.47805, abs=1e-6)
    assert statistics.f_quantile(0.0, 2, 2) == 0 and math.isnan(statistics.f_quantile(0.5, -1, 2))


def test_f_quantile_column(spark):
    df = spark.createDataFrame([(4.0, 10.0), (-1.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r.q for r in df.select(statistics.f_quantiles(0.95, F.col("a"), F.col("b")).alias("q")).collect()] == [pytest.approx(3.47805, abs=1e-5), None, None]


def test_chi2_column(spark):
    df = spark.createDataFrame([(2.0,), (-1.0,), (None,)], "x double")
    assert [r.p for r in df.select(statistics.chi2_cdf(F.col("x"), 2.0).alias("p")).collect()] == [pytest.approx(1 - math.exp(-1)), None, None]


def test_strings(spark):
    date, time = strings.date_and_time(F.lit(1702113812.9))
    start, end = strings.scene_times(F.lit("S1A_IW_GRDH_1SDV_20231209T092333_20231209T092402_051576_0639F8_652A"))
    r = one(
        spark, a=strings.target_code(F.lit("OilSpill")), b=strings.target_code(F.lit("cat")), c=strings.cleaned(F.lit("a|b(c)")), d=strings.is_ascii(F.lit("é")), e=strings.product_name(F.lit("SHIPD_RGB012345_x")), f=strings.product_name(F.lit("SHIPD")),
        g=strings.four_numbers(F.lit("1, 2 3,4")), h=strings.four_numbers(F.lit("1,2,x,4")), i=strings.box_or_point(F.lit("126,35")), j=strings.box_or_point(F.lit("1,2,3")), date=date, time=time, start=start.cast("long"), end=end.cast("long"),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.h, r.j) == ("OILSP", "-1", "a_b_c_", False, True, False, [1, 2, 3, 4], None, None)
    assert r.i == pytest.approx([125.98, 34.98, 126.02, 35.02]) and (r.date, r.time) == ("2023-12-09", "09:23:32") and r.end - r.start == 29


def test_neighbourhood_kernels():
    rng = np.random.default_rng(0)
    a = rng.random((9, 11))
    p = np.pad(a, 1, mode="symmetric")
    mean = np.array([[p[i : i + 3, j : j + 3].mean() for j in range(11)] for i in range(9)])
    assert np.allclose(kernels.boxcar(a, 3), mean) and np.allclose(kernels.gaussian(np.ones((8, 8)), 2.0), 1)
    q = np.pad(a, 2, mode="symmetric")
    assert np.allclose(kernels.median(a, 5), [[np.median(q[i : i + 5, j : j + 5]) for j in range(11)] for i in range(9)])
    low = kernels.eroded(a, 2)
    assert low[4, 5] == a[2:7, 3:8].min() and kernels.resized(a, 9, 11) == pytest.approx(a) and kernels.resized(np.arange(4.0)[None], 1, 2).tolist() == [[0.5, 2.5]]


def test_phase_shift_and_move():
    rng = np.random.default_rng(1)
    a = kernels.gaussian(rng.random((64, 64)), 1.5)
    b = np.roll(a, (-3, 5), (0, 1))
    assert kernels.phase_shift(a, b) == pytest.approx((3, -5), abs=0.01)
    assert kernels.phase_shift(np.zeros((8, 8)), np.ones((8, 8))) == (0, 0)
    assert np.allclose(kernels.moved(a, 0, 0), a) and np.allclose(kernels.moved(a, 2, -1)[:-2, 1:], a[2:, :-1])
    x = np.arange(40.0)
    line = np.sin(x / 5)[None].repeat(40, 0)
    assert np.abs(kernels.moved(line, 0, 0.5)[20, 5:30] - np.sin((x[5:30] + 0.5) / 5)).max() < 1e-4
