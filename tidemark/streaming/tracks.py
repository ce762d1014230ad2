"""Position reports as an unbounded stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import config
from ..operators.tracks import in_scene

LATE = "10 minutes"


def reports(spark: SparkSession, path: str, schema: str, files_a_trigger: int | None = None, kind: str = "parquet") -> DataFrame:
    """Files that arrive in a folder, read as they come."""
    reader = spark.readStream.format(kind).schema(schema)
    return (reader.option("maxFilesPerTrigger", files_a_trigger) if files_a_trigger else reader).load(path)


def once(stream: DataFrame, keys: list[str], at: str = "ts", late: str = LATE) -> DataFrame:
    """Reports without repeats that come within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def activity(stream: DataFrame, at: str = "ts", window: str = "10 minutes", slide: str | None = None, late: str = LATE) -> DataFrame:
    """(start, end, mmsi, n, mean_sog) by event-time window; a window comes out when the watermark has passed it."""
    w = F.window(at, window, slide) if slide else F.window(at, window)
    return stream.withWatermark(at, late).groupBy(w.alias("w"), "mmsi").agg(F.count("*").alias("n"), F.avg("sog").alias("mean_sog")).select("w.start", "w.end", "mmsi", "n", "mean_sog")


def in_scenes(stream: DataFrame, scenes: DataFrame, margin_s: float = config.TIME_MARGIN_S) -> DataFrame:
    """Stream-static join, by time bucket: reports with the scenes whose time span (and margin) and bounds hold them."""
    placed = stream.withColumn("epoch", F.col("ts").cast("timestamp").cast("double"))
    return in_scene(placed, scenes, margin_s, zero_is_missing=False)


def middle_reports(rows: DataFrame, late: str = LATE) -> DataFrame:
    """(scene_id, mmsi, n, seq, lon, lat): the middle report of each ship in a scene, once the watermark has passed the scene's end.

    rows: in_scenes(); the state of a group is its reports so far, dropped when it comes out.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = pd.DataFrame(list(zip(*state.get, strict=True)), columns=["seq", "lon", "lat"]).sort_values("seq", kind="stable")
            state.remove()
            k = 0 if len(held) < 2 else int(round(len(held) / 2))
            mid = held.iloc[k]
            yield pd.DataFrame({"scene_id": [key[0]], "mmsi": [key[1]], "n": [len(held)], "seq": [int(mid.seq)], "lon": [float(mid.lon)], "lat": [float(mid.lat)]})
            return
        seq, lon, lat = (list(x) for x in state.get) if state.exists else ([], [], [])
        end = 0.0
        for pdf in batches:
            seq += pdf.seq.tolist()
            lon += pdf.lon.tolist()
            lat += pdf.lat.tolist()
            end = max(end, float(pdf.close_s.max()))
        state.update((seq, lon, lat))
        state.setTimeoutTimestamp(max(int(end * 1000), state.getCurrentWatermarkMs() + 1))

    placed = rows.withColumn("close_s", F.col("end_s") + config.TIME_MARGIN_S).withWatermark("ts", late)
    return placed.select("scene_id", "mmsi", "ts", "seq", "lon", "lat", "close_s").groupBy("scene_id", "mmsi").applyInPandasWithState(
        run, "scene_id long, mmsi long, n long, seq long, lon double, lat double", "seq array<long>, lon array<double>, lat array<double>", "append", GroupStateTimeout.EventTimeTimeout
    )
