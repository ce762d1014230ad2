import json
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.sources import geotiff, sar_xml, shapes, tables


def write(path, text):
    path.write_text(text)
    return str(path)


def test_reports(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    upper = write(tmp_path / "a.csv", "MMSI,Date,Time,Lon,Lat,SOG,COG,VesselName,VesselType,DimA,DimB,DimC,DimD,Status,ToPortof\n5,2024-02-24,09:32:02.7,129.1,35.2,10,90,A,Cargo,12,x,,3,ok,Busan\n6,bad,date,129.1,35.2,1,2,B,T,1,1,1,1,s,P\n")
    lower = write(tmp_path / "b.csv", "mmsi,date,time,lon,lat,sog,cog,vesselname,vesseltype,dima,dimb,dimc,dimd,status\n7,2024-02-24,00:00:00,1,2,3,4,C,T,1,2,3,4,s\n")
    a, bad = tables.reports(spark, upper).orderBy("seq").collect()
    assert (a.mmsi, a.epoch, a.dim_a, a.dim_b, a.dim_c, a.destination) == (5, 1708767122.0, 12.0, 0.0, 0.0, "Busan") and bad.epoch == 0
    b = tables.reports(spark, lower).first()
    assert (b.mmsi, b.sog, b.destination, b["name"]) == (7, 3.0, None, "C")


def test_boxes_and_ships(spark, tmp_path):
    ships = write(tmp_path / "s.csv", "imageName,X,Y,W,H,Lon,Lat\na.tif,1,2,3,4,129.5,35.5\na.tif,oops,2,3,4,129.5,35.5\n")
    rows = tables.ships(spark, ships).collect()
    assert rows[0].image == "a.tif" and rows[0].X == 1 and rows[1].X is None
    boxes = write(tmp_path / "f.csv", "Class,LatMin,LonMin,LatMax,LonMax\nSHIP,1,2,3,4\n")
    assert tables.facilities(spark, boxes).first().LonMin == 2


def test_json_sources(spark, tmp_path):
    write(tmp_path / "a.json", json.dumps({"ROI_ID": "1", "Timestamp": "20220204021523"}, indent=2))
    write(tmp_path / "b.json", "{broken")
    write(tmp_path / "c.json", json.dumps({"Timestamp": "x"}))
    got = {r.file: (r.roi_id, r.timestamp) for r in tables.roi(spark, str(tmp_path)).collect()}
    assert got == {"a.json": ("1", "20220204021523"), "b.json": ("Unknown", "Unknown"), "c.json": ("Unknown", "x")}
    write(tmp_path / "t.json", json.dumps({"satellite": "X", "RADIANCE_MULT_BAND_10": 0.00038, "RADIANCE_ADD_BAND_10": 0.1, "K1_CONSTANT_BAND_10": 799.0284, "K2_CONSTANT_BAND_10": 1329.2405}, indent=1))
    r = tables.thermal_constants(spark, str(tmp_path / "t.json")).first()
    assert (r.radiance_mult, r.radiance_add, r.k1, r.k2) == (0.00038, 0.1, 799.0284, 1329.2405)


def test_files_and_key_values(spark, tmp_path):
    write(tmp_path / "x_B4.tif", "1")
    write(tmp_path / "y.txt", "swath: IW2\nBperp (average): 0.91\nBpar (average): 2.87\n")
    assert [(r.name, r.stem, r.length) for r in tables.files(spark, str(tmp_path), "*.tif").collect()] == [("x_B4.tif", "x_B4", 1)]
    r = tables.key_values(spark, str(tmp_path / "y.txt"), ["swath", "Bperp", "Bpar"]).first()
    assert (r.swath, r.Bperp, r.Bpar) == ("IW2", "0.91", "2.87")


def test_labels(spark, tmp_path):
    lines = write(tmp_path / "train.txt", "a.jpg 1,2,3,4,0 5,6,7,8,1\nb.jpg\nc.jpg 9,9,9,9,2\n")
    assert [(r.image, r.x1, r.cls) for r in tables.label_lines(spark, lines).orderBy("image", "x1").collect()] == [("a.jpg", 1, 0), ("a.jpg", 5, 1), ("c.jpg", 9, 2)]
    (tmp_path / "j").mkdir()
    write(tmp_path / "j" / "scene.json", json.dumps({"shapes": [{"label": "s", "points": [[9.7, 1], [2.2, 5]]}, {"label": "p", "points": [[1, 1], [2, 2], [3, 3]]}]}))
    assert [tuple(r) for r in tables.label_shapes(spark, str(tmp_path / "j")).collect()] == [("scene.tif", 2, 1, 7, 4)]
    (tmp_path / "t").mkdir()
    write(tmp_path / "t" / "one.txt", "1 2 3 4\n")
    write(tmp_path / "t" / "two.txt", "1,2,3,4\n5,6,7,8\n")
    assert tables.label_files(spark, str(tmp_path / "t")).count() == 3 and tables.label_files(spark, str(tmp_path / "t"), one_row_is_unread=True).count() == 2


def test_sinks(spark, tmp_path):
    source = write(tmp_path / "a.csv", "x,y\n1,\n2,b\n")
    tables.csv_to_json(spark, source, str(tmp_path / "out"))
    rows = [json.loads(x) for p in (tmp_path / "out").glob("*.json") for x in p.read_text().splitlines()]
    assert sorted(rows, key=str) == [{"x": "1", "y": None}, {"x": "2", "y": "b"}]
    df = spark.createDataFrame([(1, 2.5)], "a int, b double")
    tables.to_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).first().b == "2.5"
    tables.to_json(df, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).first().b == 2.5
    assert json.loads(tables.alert(df, F.lit(10.4)).first().alert) == {"thresholdEstimationValue": 10.4}


def test_time_span_is_pushed_down(spark, data):
    rows = tables.in_span(spark.read.parquet(f"{data}/events.parquet"), "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan and rows.count() > 0


# ---- GeoTIFF


@pytest.mark.parametrize("dtype", ["u1", "u2", "i2", "f4", "f8"])
@pytest.mark.parametrize("deflate", [True, False])
def test_round_trip(dtype, deflate):
    a = (np.arange(3 * 70 * 5).reshape(3, 70, 5) % 250).astype(dtype)
    t = geotiff.Tiff(geotiff.encoded(a, (126.0, 0.1, 0.0, 35.0, 0.0, -0.2), nodata=7, deflate=deflate))
    out = np.zeros_like(a)
    for r, c, block in t.blocks():
        out[:, r : r + block.shape[1], c : c + block.shape[2]] = block
    assert (out == a).all() and t.transform == (126.0, 0.1, 0.0, 35.0, 0.0, -0.2) and t.nodata == 7


def plain_tiff(fields, blobs, order="<"):
    """A file of given directory fields; blobs go first and their places are filled into 273 or 324."""
    places, body = [], b""
    for b in blobs:
        places.append(8 + len(body))
        body += b
    at = 8 + len(body)
    entries, extra = b"", b""
    for tag, kind, values in sorted([*fields, (fields[0][0], fields[0][1], places)][1:]):
        data = struct.pack(f"{order}{len(values)}{ {3: 'H', 4: 'I'}[kind] }", *values)
        if len(data) <= 4:
            value = data.ljust(4, b"\0")
        else:
            value, extra = struct.pack(f"{order}I", at + 2 + 12 * len(fields) + 4 + len(extra)), extra + data
        entries += struct.pack(f"{order}HHI", tag, kind, len(values)) + value
    return struct.pack(f"{order}2sHI", b"II" if order == "<" else b"MM", 42, at) + body + struct.pack(f"{order}H", len(fields)) + entries + b"\0" * 4 + extra


def test_tiles_planes_byte_order_and_predictor():
    a = np.arange(2 * 20 * 30, dtype=">u2").reshape(2, 20, 30)
    blobs = []
    for band in range(2):
        for r in (0, 16):
            for c in (0, 16):
                tile = np.zeros((16, 16), ">u2")
                part = a[band, r : r + 16, c : c + 16]
                tile[: part.shape[0], : part.shape[1]] = part
                step = tile.copy()
                step[:, 1:] -= tile[:, :-1]
                blobs.append(step.tobytes())
    fields = [(324, 4, []), (256, 3, [30]), (257, 3, [20]), (258, 3, [16, 16]), (259, 3, [1]), (277, 3, [2]), (284, 3, [2]), (317, 3, [2]), (322, 3, [16]), (323, 3, [16]), (325, 4, [len(b) for b in blobs])]
    t = geotiff.Tiff(plain_tiff(fields, blobs, ">"))
    out = np.zeros((2, 20, 30), int)
    for r, c, block in t.blocks():
        out[:, r : r + block.shape[1], c : c + block.shape[2]] = block
    assert (out == a).all()


def lzw(data):
    """A plain encoder, for the decoder's test."""
    table, codes, width, out, bits = {bytes([k]): k for k in range(256)}, 258, 9, 0, 0

    def put(code):
        nonlocal out, bits
        out, bits = out << width | code, bits + width

    put(256)
    run = b""
    for k in range(len(data)):
        more = run + data[k : k + 1]
        if more in table:
            run = more
            continue
        put(table[run])
        table[more] = codes
        codes += 1
        width = 9 if codes < 512 else 10 if codes < 1024 else 11 if codes < 2048 else 12
        run = data[k : k + 1]
        if codes >= 4093:
            put(table[run])
            run = b""
            put(256)
            table, codes, width = {bytes([j]): j for j in range(256)}, 258, 9
    if run:
        put(table[run])
    put(257)
    return (out << -bits % 8).to_bytes((bits + 7) // 8, "big")


def test_lzw_and_packbits():
    data = bytes(np.random.default_rng(0).integers(0, 4, 20_000).astype(np.uint8))
    assert geotiff._unlzw(lzw(data)) == data
    assert geotiff._unpacked_bits(bytes([2, 1, 2, 3, 254, 9, 128])) == bytes([1, 2, 3, 9, 9, 9])


def test_rasters_through_spark(spark, tmp_path):
    a = np.array([[[1.0, -9.0], [np.nan, 4.0], [5.0, 6.0]]], np.float32)
    (tmp_path / "s1.tif").write_bytes(geotiff.encoded(a, (126.0, 0.5, 0.0, 35.0, 0.0, -0.5), nodata=-9))
    px = {(r.row, r.col): (r.b1, r.b2) for r in geotiff.pixels(spark, str(tmp_path), bands=2).collect()}
    assert px[0, 0] == (1.0, None) and px[0, 1] == (None, None) and px[1, 0] == (None, None) and px[2, 1] == (6.0, None)
    s = geotiff.scenes(spark, str(tmp_path)).first()
    assert (s.scene_id, s.xsize, s.ysize, s.max_lon, s.min_lat, s.nodata) == ("s1", 2, 3, 126.5, 34.0, -9.0)
    image = geotiff.images(geotiff.pixels(spark, str(tmp_path)), ["b1"]).first()
    again = geotiff.Tiff(bytes(image.content))
    block = next(again.blocks())[2][0]
    assert block.tolist() == [[1, -9999], [-9999, 4], [5, 6]]
    with pytest.raises(ValueError):
        geotiff.Tiff(b"not a raster")


# ---- XML

ANNOTATION = """<product><adsHeader><missionId>S1A</missionId><startTime>2023-12-09T09:23:33.141</startTime><stopTime>2023-12-09T09:24:02.140</stopTime></adsHeader>
<generalAnnotation><productInformation><pass>Ascending</pass></productInformation></generalAnnotation><geolocationGrid><geolocationGridPointList count="1"><geolocationGridPoint>
<azimuthTime>2023-12-09T09:23:33.141</azimuthTime><slantRangeTime>5.3e-03</slantRangeTime><line>0</line><pixel>10</pixel><latitude>34.5</latitude><longitude>129.5</longitude><height>1</height><incidenceAngle>30.5</incidenceAngle><elevationAngle>27.1</elevationAngle>
</geolocationGridPoint></geolocationGridPointList></geolocationGrid></product>"""
CALIBRATION = """<calibration><adsHeader><polarisation>VV</polarisation></adsHeader><calibrationInformation><absoluteCalibrationConstant>1.5</absoluteCalibrationConstant></calibrationInformation><calibrationVectorList>
<calibrationVector><azimuthTime>2023-12-09T09:23:33</azimuthTime><line>0</line><pixel>0 40</pixel><sigmaNought>1 2</sigmaNought><betaNought>3 3</betaNought><gamma>4 4</gamma><dn>5 5</dn></calibrationVector>
<calibrationVector><azimuthTime>2023-12-09T09:23:34</azimuthTime><line>50</line><pixel>0 40</pixel><sigmaNought>3 4</sigmaNought><betaNought>3 3</betaNought><gamma>4 4</gamma><dn>5 5</dn></calibrationVector></calibrationVectorList></calibration>"""
MANIFEST = """<x:xfdu xmlns:x="u" xmlns:safe="a" xmlns:s1="b"><safe:familyName>SENTINEL-1</safe:familyName><safe:number>A</safe:number><safe:orbitNumber type="start">51576</safe:orbitNumber><safe:orbitNumber type="stop">51577</safe:orbitNumber>
<safe:startTime>2023-12-09T09:23:33.141</safe:startTime><s1:pass>ASCENDING</s1:pass><s1:swath>IW1</s1:swath><s1:swath>IW2</s1:swath><safe:cycleNumber>oops</safe:cycleNumber></x:xfdu>"""


def test_radar_metadata(spark, tmp_path):
    for name, text in (("a", ANNOTATION), ("c", CALIBRATION), ("m", MANIFEST)):
        write(tmp_path / f"{name}.xml", text)
    doc = lambda n: sar_xml.texts(spark, str(tmp_path / f"{n}.xml"))
    a = sar_xml.annotation(doc("a")).first()
    assert a.end_s - a.start_s == 29 and a.ascending is True
    g = sar_xml.geolocation(doc("a")).first()
    assert (g.row, g.column, g.latitude, g.incidence_angle) == (0, 10, 34.5, 30.5)
    c = sar_xml.calibration(doc("c"))
    assert [(r.pol, r.abs_const, r.line, r.pixel, r.sigma_0) for r in c.orderBy("line").collect()] == [("VV", 1.5, 0, [0, 40], [1, 2]), ("VV", 1.5, 50, [0, 40], [3, 4])]
    assert sorted((r.node_row, r.node_col, r.factor) for r in sar_xml.calibration_nodes(c).collect()) == [(0, 0, 1), (0, 40, 2), (50, 0, 3), (50, 40, 4)]
    m = sar_xml.manifest(doc("m")).first()
    assert (m.mission, m.orbit_number, m["pass"], m.swath) == ("SENTINEL-1A", [51576, 51577], "ASCENDING", ["IW1", "IW2"])
    assert "cycle_number" in m.error and "stop_time" in m.error and "mission" not in m.error and "start_time" not in m.error


def test_image_descriptions(spark, tmp_path):
    write(tmp_path / "i.xml", '<imageFile><property name="width"><value>24891</value><doc>w</doc></property><component name="c"><property name="size"><value>2850</value></property></component></imageFile>')
    write(tmp_path / "b.xml", '<PAMDataset><PAMRasterBand band="1"><Metadata><MDI key="STATISTICS_MAXIMUM">9.5</MDI><MDI key="STATISTICS_MEAN">0.5</MDI><MDI key="STATISTICS_MINIMUM">0</MDI><MDI key="STATISTICS_STDDEV">1</MDI><MDI key="STATISTICS_VALID_PERCENT">100</MDI></Metadata></PAMRasterBand></PAMDataset>')
    props = {r.name: r.value for r in sar_xml.image_properties(sar_xml.texts(spark, str(tmp_path / "i.xml"))).collect()}
    assert props == {"width": "24891", "size": "2850"}
    b = sar_xml.band_statistics(sar_xml.texts(spark, str(tmp_path / "b.xml"))).first()
    assert (b.band, b.least, b.most, b.valid_percent) == (1, 0.0, 9.5, 100.0)


def test_overlays(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "S1A_x.zip", "w") as z:
        z.writestr("S1A_x.SAFE/preview/map-overlay.kml", "<kml><coordinates>129.1,34.2 131.9,34.6 131.5,36.3 128.8,35.9</coordinates></kml>")
    pts = sar_xml.footprint_points(sar_xml.overlays(spark, str(tmp_path)))
    from tidemark.operators import lookup

    b = lookup.footprint(pts, ["path"])
    assert tuple(b.first())[1:] == (34, 37, 128, 132) and lookup.degree_grid(b, ["path"]).count() == 20


# ---- shapefiles


def test_zones(spark, tmp_path):
    def record(number, *rings):
        xy = [p for r in rings for p in r]
        starts = np.cumsum([0, *(len(r) for r in rings)])[:-1]
        body = struct.pack("<i4dii", 5, 0, 0, 1, 1, len(rings), len(xy)) + struct.pack(f"<{len(rings)}i", *starts) + struct.pack(f"<{2 * len(xy)}d", *(v for p in xy for v in p))
        return struct.pack(">ii", number, len(body) // 2) + body

    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    null = struct.pack(">ii", 3, 2) + struct.pack("<i", 0)
    (tmp_path / "z.shp").write_bytes(b"\0" * 100 + record(1, square(0, 10), square(2, 3)) + record(2, square(20, 30)) + null)
    fields = b"HAEGU_NO\0\0\0N\0\0\0\0" + bytes([6, 0]) + b"\0" * 14 + b"NAME\0\0\0\0\0\0\0C\0\0\0\0" + bytes([8, 0]) + b"\0" * 14
    head = struct.pack("<4BIHH", 3, 24, 1, 1, 3, 32 + 64 + 1, 15) + b"\0" * 20
    (tmp_path / "z.dbf").write_bytes(head + fields + b"\r" + b" " + b"    12" + b"east    " + b" " + b"      " + b"west    " + b" " + b"     7" + b"none    " + b"\x1a")
    rows = shapes.zones(spark, str(tmp_path)).orderBy("zone_ord").collect()
    assert [(r.zone_ord, r.zone_no, len(r.rings)) for r in rows] == [(0, 12, 2), (1, None, 1), (2, 7, 0)] and rows[0].rings[1][1].x == 3
