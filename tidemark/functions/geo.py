"""Distances, projections and pixel grids as column expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config

col = F.col


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres on a sphere."""
    s1, s2 = F.sin((F.radians(lat2) - F.radians(lat1)) / 2), F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    a = s1 * s1 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s2 * s2
    return 1000 * config.EARTH_KM * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def metres_of_degrees(degrees: Column, latitude: float = config.BOX_LATITUDE) -> Column:
    """Box extents in metres: one scale, that of the given latitude, for both axes."""
    return F.radians(degrees) * config.METRES_A_RADIAN * math.cos(math.radians(latitude))


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(x, y) in metres."""
    return config.MERCATOR_RADIUS * F.radians(lon), config.MERCATOR_RADIUS * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))


def grid_size(low: Column, high: Column, step: Column) -> Column:
    """Points of an evenly spaced axis that includes both ends."""
    return F.bround(((high + step) - low) / step, 0)


def pixel_of(lat: Column, lon: Column, scene: str = "") -> tuple[Column, Column]:
    """(y, x): fractional pixel, counted from 1, of a position in a scene (columns min_lon, dlon, max_lon, max_lat, min_lat, dlat)."""
    c = lambda n: F.col(f"{scene}{n}")
    rows = grid_size(c("min_lat"), c("max_lat"), -c("dlat"))
    columns = grid_size(c("min_lon"), c("max_lon"), c("dlon"))
    y = 1 + (c("max_lat") - lat) / (c("max_lat") - c("min_lat")) * (rows - 1)
    x = 1 + (lon - c("min_lon")) / (c("max_lon") - c("min_lon")) * (columns - 1)
    return y, x


def position_of(x: Column, y: Column, transform: tuple[Column, ...]) -> tuple[Column, Column]:
    """(lon, lat) of a pixel by the six numbers of an affine transform (x origin, a, b, y origin, d, e)."""
    xo, a, b, yo, d, e = transform
    return a * x + b * y + xo, d * x + e * y + yo


def dead_reckoned(lat: Column, lon: Column, speed: Column, course: Column, seconds: Column) -> tuple[Column, Column]:
    """(lat, lon) after some seconds at speed (m/s) and course (degrees); a degree is as long on either axis."""
    return lat + seconds * (speed * F.cos(F.radians(course)) / config.METRES_A_DEGREE), lon + seconds * (speed * F.sin(F.radians(course)) / config.METRES_A_DEGREE)


def on_line(first: Column, last: Column, index: Column, n: Column) -> Column:
    """Element `index` of n evenly spaced values from first to last."""
    return first + (last - first) * index / (n - 1)


@F.pandas_udf(T.DoubleType())
def geodesic_m(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """Distance in metres on the WGS 84 ellipsoid by Vincenty's inverse iteration; null where it doesn't settle (near antipodes)."""
    a, f = 6_378_137.0, 1 / 298.257223563
    b = (1 - f) * a
    u1, u2 = np.arctan((1 - f) * np.tan(np.radians(lat1))), np.arctan((1 - f) * np.tan(np.radians(lat2)))
    gap = np.radians((lon2 - lon1).to_numpy(float))
    su1, cu1, su2, cu2 = (np.asarray(x, float) for x in (np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)))
    lam, settled, last = gap.copy(), np.zeros(len(gap), bool), False
    with np.errstate(all="ignore"):
        for _ in range(1000):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cs = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0.0, cu1 * cu2 * sl / np.where(ss == 0, 1, ss))
            ca2 = 1 - sa**2
            c2m = np.where(ca2 == 0, 0.0, cs - 2 * su1 * su2 / np.where(ca2 == 0, 1, ca2))
            c = f / 16 * ca2 * (4 + f * (4 - 3 * ca2))
            new = gap + (1 - c) * f * sa * (sigma + c * ss * (c2m + c * cs * (-1 + 2 * c2m**2)))
            settled = np.abs(new - lam) < 1e-12
            lam = new
            if last:
                break
            last = bool(settled[~np.isnan(gap)].all())  # one more round, so that what follows belongs to the settled longitude
        u = ca2 * (a**2 - b**2) / b**2
        big = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
        small = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
        delta = small * ss * (c2m + small / 4 * (cs * (-1 + 2 * c2m**2) - small / 6 * c2m * (-3 + 4 * ss**2) * (-3 + 4 * c2m**2)))
    return pd.Series(np.where(settled, np.where(ss == 0, 0.0, b * big * (sigma - delta)), np.nan)).replace({np.nan: None}).astype(float)
