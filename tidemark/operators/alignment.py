"""Alignment of image pairs by phase correlation of patches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS
from ..functions import kernels
from .lookup import polynomial

A = DEFAULTS.alignment


def patch_shifts(pixels: DataFrame, first: str, second: str, patch: int = A.patch, upsample: int = A.upsample) -> DataFrame:
    """(scene_id, patch_row, patch_col, shift_row, shift_col) of each whole patch of a pair of aligned bands; patches that aren't whole are left out."""
    placed = pixels.select("scene_id", F.floor(F.col("row") / patch).alias("patch_row"), F.floor(F.col("col") / patch).alias("patch_col"), "row", "col", F.col(first).cast("double").alias("a"), F.col(second).cast("double").alias("b"))
    kind = dict(pixels.dtypes)["scene_id"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < patch * patch:
            return pd.DataFrame({"scene_id": [], "patch_row": [], "patch_col": [], "shift_row": [], "shift_col": []})
        r, c = pdf.row.to_numpy() % patch, pdf.col.to_numpy() % patch
        a, b = np.full((patch, patch), np.nan), np.full((patch, patch), np.nan)
        a[r, c], b[r, c] = pdf.a, pdf.b
        rows, cols = kernels.phase_shift(a, b, upsample)
        return pd.DataFrame({"scene_id": pdf.scene_id.iloc[:1], "patch_row": pdf.patch_row.iloc[:1], "patch_col": pdf.patch_col.iloc[:1], "shift_row": [rows], "shift_col": [cols]})

    return placed.groupBy("scene_id", "patch_row", "patch_col").applyInPandas(run, f"scene_id {kind}, patch_row long, patch_col long, shift_row double, shift_col double")


def scene_shift(shifts: DataFrame, degree: int = A.degree) -> DataFrame:
    """(scene_id, shift_row, shift_col): polynomials of the patch shifts along each axis, at the mean place.

    Where there are too few patches for a polynomial, the mean shift.
    """
    mean = shifts.groupBy("scene_id").agg(F.avg("patch_row").alias("r"), F.avg("patch_col").alias("c"), F.avg("shift_row").alias("mr"), F.avg("shift_col").alias("mc"))
    value = lambda p, at: sum((F.col(f"{p}{k}") * F.pow(F.col(at), k) for k in range(1, degree + 1)), F.col(f"{p}0"))
    fit = lambda x, y, p: polynomial(shifts, ["scene_id"], x, y, degree).withColumnsRenamed({f"c{k}": f"{p}{k}" for k in range(degree + 1)})
    both = mean.join(fit("patch_row", "shift_row", "u"), "scene_id", "left").join(fit("patch_col", "shift_col", "v"), "scene_id", "left")
    return both.select("scene_id", F.coalesce(value("u", "r"), "mr").alias("shift_row"), F.coalesce(value("v", "c"), "mc").alias("shift_col"))
