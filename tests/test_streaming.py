import datetime

from pyspark.sql import functions as F

from tidemark.streaming import tracks

SCHEMA = "seq long, mmsi long, ts timestamp, lon double, lat double, sog double"
T0 = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)


def drop(spark, folder, rows):
    spark.createDataFrame([(s, m, T0 + datetime.timedelta(seconds=t), 126.2, 34.2, v) for s, m, t, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(df, name, tmp_path, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"c_{name}")).start()
    q.processAllAvailable()
    return q


def scenes(spark):
    start = T0.timestamp()
    return spark.sql(f"SELECT 1L scene_id, 126.0D min_lon, 126.5D max_lon, 34.0D min_lat, 34.5D max_lat, {start}D start_s, {start + 60}D end_s")


def test_activity_and_repeats(spark, tmp_path):
    at = str(tmp_path / "in")
    drop(spark, at, [(1, 5, 0, 2.0), (1, 5, 0, 2.0), (2, 5, 30, 4.0), (3, 6, 700, 1.0)])
    q = run(tracks.activity(tracks.reports(spark, at, SCHEMA)), "activity", tmp_path)
    drop(spark, at, [(4, 6, 5000, 1.0)])
    q.processAllAvailable()
    drop(spark, at, [(5, 5, 10, 9.0), (6, 7, 9000, 1.0)])  # the first comes too late
    q.processAllAvailable()
    q.stop()
    got = {(r.mmsi, r.start.minute): (r.n, r.mean_sog) for r in spark.table("activity").where("start < timestamp'2024-01-01 00:30:00+00:00'").collect()}
    assert got[5, 0][0] == 3 and got[6, 10] == (1, 1.0)
    q = run(tracks.once(tracks.reports(spark, at, SCHEMA), ["seq"]).select("seq"), "once", tmp_path)
    q.stop()
    assert spark.table("once").where("seq = 1").count() == 1


def test_middle_reports_come_when_the_scene_has_closed(spark, tmp_path):
    at = str(tmp_path / "in")
    drop(spark, at, [(1, 5, 0, 1.0), (2, 5, 10, 1.0), (3, 5, 20, 1.0), (9, 6, 30, 1.0)])
    rows = tracks.in_scenes(tracks.reports(spark, at, SCHEMA), F.broadcast(scenes(spark)))
    q = run(tracks.middle_reports(rows), "middle", tmp_path)
    assert spark.table("middle").count() == 0
    drop(spark, at, [(4, 5, 40, 1.0), (50, 8, 650, 1.0)])
    q.processAllAvailable()
    assert spark.table("middle").count() == 0
    q.stop()


def test_middle_report_of_each_ship(spark, tmp_path):
    at = str(tmp_path / "in")
    wide = scenes(spark).withColumn("end_s", F.col("start_s") + 60)
    late = scenes(spark).withColumns({"scene_id": F.lit(2).cast("long"), "start_s": F.col("start_s") + 9000, "end_s": F.col("start_s") + 9060})
    drop(spark, at, [(1, 5, 0, 1.0), (2, 5, 10, 1.0), (3, 5, 20, 1.0), (9, 6, 30, 1.0)])
    rows = tracks.in_scenes(tracks.reports(spark, at, SCHEMA), F.broadcast(wide.union(late)))
    q = run(tracks.middle_reports(rows), "middle2", tmp_path)
    drop(spark, at, [(20, 7, 9030, 1.0)])
    q.processAllAvailable()
    drop(spark, at, [(21, 7, 9040, 1.0)])
    q.processAllAvailable()
    q.stop()
    got = {(r.scene_id, r.mmsi): (r.n, r.seq) for r in spark.table("middle2").collect()}
    assert got == {(1, 5): (3, 3), (1, 6): (1, 9)}
