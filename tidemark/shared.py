"""Tables written to the folder that all executors share, and the package sent to Python workers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Tables written and not removed, in the order of writing.
_kept: list[str] = []


def ship(spark: SparkSession) -> None:
    """Adds this package to the Python path of every executor, once an application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    top = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp()) / f"{top.name}.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(at))


def folder(spark: SparkSession) -> str:
    """The shared folder: spark.checkpoint.dir.  Where that is unset, a folder of this machine if the session runs on it alone, else an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file://{os.path.join(tempfile.gettempdir(), 'checkpoints')}"
    return at.rstrip("/")


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows as a Parquet table in the shared folder: what follows doesn't depend on executors that made them."""
    spark = df.sparkSession
    at = f"{_own(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    _kept.append(at)
    out = spark.read.schema(df.schema).parquet(at)
    out._written_at = at
    return out


def _own(spark: SparkSession) -> str:
    return f"{folder(spark)}/tables/{spark.sparkContext.applicationId}"


def _removed(spark: SparkSession, at: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dropped(df: DataFrame) -> None:
    """Removes the files of a table that written() made, once nothing reads it any more."""
    at = getattr(df, "_written_at", None)
    if at and at in _kept:
        _kept.remove(at)
        _removed(df.sparkSession, at)


def mark() -> int:
    """A point in time for dropped_since()."""
    return len(_kept)


def dropped_since(spark: SparkSession, since: int, but: DataFrame) -> None:
    """Removes the tables written since a mark, but for one: the intermediate tables of what that one holds."""
    for at in _kept[since:]:
        if at != getattr(but, "_written_at", None):
            _kept.remove(at)
            _removed(spark, at)


def cleared(spark: SparkSession) -> None:
    """Removes all tables that this application has written to the shared folder; results read from them must have been used before."""
    _kept.clear()
    _removed(spark, _own(spark))
