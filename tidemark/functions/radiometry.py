"""Per-pixel expressions.  A missing pixel is NULL; NaN is never compared."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULTS, Thermal

T = DEFAULTS.thermal


def known(value: Column, nodata: float | None = None) -> Column:
    """The value, NULL for NaN and for the no-data value."""
    v = F.when(~F.isnan(value), value)
    return v if nodata is None else F.when(v != nodata, v)


def radiance(dn: Column, t: Thermal = T) -> Column:
    """Top-of-atmosphere radiance; NULL unless positive."""
    value = t.radiance_mult * dn + t.radiance_add
    return F.when(value > 0, value)


def brightness_temperature(dn: Column, t: Thermal = T) -> Column:
    """Kelvin."""
    return t.k2 / F.log(t.k1 / radiance(dn, t) + 1)


def ndvi(red: Column, near: Column) -> Column:
    """Normalised difference of near infrared and red; 0 where both cancel out."""
    return F.when(near + red == 0, F.lit(0.0)).otherwise((near - red) / (near + red))


def emissivity(index: Column, t: Thermal = T) -> Column:
    """Surface emissivity by vegetation index."""
    low, high = t.ndvi
    share = ((index - low) / (high - low)) * ((index - low) / (high - low))
    mixed = t.soil * share + t.vegetation * (1 - share)
    return F.when(index < 0, F.lit(t.water)).when(index < low, F.lit(t.soil)).when(index >= high, F.lit(t.vegetation)).otherwise(mixed)


def surface_temperature(brightness: Column, eps: Column, t: Thermal = T) -> Column:
    """Degrees Celsius; NULL outside the valid range (its ends are valid)."""
    value = brightness / (1 + t.wavelength_term * brightness / t.rho * F.log(eps)) - t.kelvin
    return F.when((value >= t.valid_c[0]) & (value <= t.valid_c[1]), value)


def cloudy(qa: Column, bits: int = T.qa_bits) -> Column:
    """Whether a quality word has the cloud or the cloud shadow bit."""
    return qa.bitwiseAND(F.lit(bits)) != 0


def safe_log(x: Column) -> Column:
    """Natural logarithm; 1e-10 stands for values that aren't positive."""
    return F.log(F.when(x <= 0, F.lit(1e-10)).otherwise(x))


def log_ratio(before: tuple[Column, Column], after: tuple[Column, Column]) -> Column:
    """Change statistic of a two-band pair: log products, and the product of the bands' differences."""
    gap = safe_log((before[0] - after[0]) * (before[1] - after[1]))
    return safe_log(before[0] * before[1]) - safe_log(after[0] * after[1]) - 2 * gap + 4 * math.log(2)


def log_ratio_scaled(before: tuple[Column, Column], after: tuple[Column, Column], looks: float) -> Column:
    """log_ratio() times -2 looks."""
    return log_ratio(before, after) * (-2 * looks)


def log_likelihood(before: tuple[Column, Column], after: tuple[Column, Column], looks: float) -> Column:
    """The classical test statistic, with the product of the bands' sums."""
    both = safe_log((before[0] + after[0]) * (before[1] + after[1]))
    return (safe_log(before[0] * before[1]) + safe_log(after[0] * after[1]) - 2 * both + 4 * math.log(2)) * (-2 * looks)


def likelihood_of_means(u: Column, v: Column, looks: float) -> Column:
    """Generalised likelihood ratio of two mean intensities."""
    return 2 * looks * F.log(F.sqrt(u / v) + F.sqrt(v / u)) - 2 * looks * math.log(2)


def gamma_density(y: Column, mean: Column, looks: int) -> Column:
    """Density of speckle intensity, with the normalisation as the source has it."""
    return looks / (mean * float(math.gamma(looks))) * F.pow(looks * y / mean, looks - 1) * F.exp(-looks * y / mean)


def to_db(value: Column, amplitude: bool = False) -> Column:
    """10 (amplitude: 20) times the natural logarithm."""
    return (20 if amplitude else 10) * F.log(value)


def clipped(value: Column, low: Column | float, high: Column | float) -> Column:
    low, high = (F.lit(x) if not isinstance(x, Column) else x for x in (low, high))
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def unit_scaled(value: Column, low: float, high: float) -> Column:
    """Clipped, then scaled by (1 - low) / (high - low)."""
    return clipped(value, low, high) * ((1 - low) / (high - low))


def byte_scaled(value: Column, low: float, high: float, offset: bool = False) -> Column:
    """Clipped and scaled to 0..255 (by 255 / high; with offset by (255 - low) / (high - low)), cut to a whole number."""
    scale = (255 - low) / (high - low) if offset else 255.0 / high
    return F.floor(clipped(value, low, high) * scale).cast("int")


def mixed(mode: str, b1: Column, b2: Column, b3: Column) -> Column:
    """One channel from three: 'vh+vv', 'grayscale', 'vv^2+vh^2' or 'vv*vh'."""
    return {"vh+vv": b2 + b3, "grayscale": 0.229 * b1 + 0.587 * b2 + 0.114 * b3, "vv^2+vh^2": b2 * b2 + b3 * b3, "vv*vh": b1 * b2}[mode]


def polarimetric(vh: Column, vv: Column) -> Column:
    """Polarimetric index; 0 where it is negative or not a number."""
    value = F.try_divide(vh, vv) * (F.try_divide(vv, vh + vv) * (10 * vh * vv))
    return F.when(value.isNull() | F.isnan(value) | (value < 0), F.lit(0.0)).otherwise(value)


def oil_inputs(intensity: Column, incidence: Column) -> tuple[Column, Column]:
    """The two channels of the spill model: intensity up to 0.1 on 0..1, incidence angle over 60."""
    return F.when(intensity.isNotNull(), F.least(intensity, F.lit(0.1)) / 0.1), incidence / 60


def masked(value: Column, valid: Column, instead: float | None = None) -> Column:
    """The value where `valid` holds, else a constant or NULL."""
    return F.when(valid, value) if instead is None else F.when(valid, value).otherwise(F.lit(instead))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def softmax(values: Column) -> Column:
    """Of an array, stable."""
    most = F.array_max(values)
    powers = F.transform(values, lambda v: F.exp(v - most))
    total = F.aggregate(powers, F.lit(0.0), lambda a, v: a + v)
    return F.transform(powers, lambda v: v / total)
