"""Default parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# They decide results, and are the defaults of the operators that name them.
EARTH_KM = 6371.0
METRES_A_RADIAN = 6_371_000.0
BOX_LATITUDE = 35.0
MERCATOR_RADIUS = 6_378_137.0
PROXIMITY_M = 200.0
NO_ZONE = -1.0
TIME_MARGIN_S = 600.0
KNOT = 0.5144
METRES_A_DEGREE = 111_000.0
TARGET_CODES = {
    "bridge": "BRIDG", "ship": "SHIPD", "wind": "WTURB", "windturbin": "WTURB", "water": "WATER", "flood": "FLOOD", "oil": "OILSP", "oilspill": "OILSP",
    "fire": "FFIRE", "forestfire": "FFIRE", "land": "LDSLD", "landslide": "LDSLD", "earthquake": "EARQK", "subsidence": "SUBSD", "infra": "INFRA",
}
NO_TARGET = "-1"


@dataclass(frozen=True)
class Platform:
    """Radar geometry of the azimuth shift."""

    slant_m: tuple[int, int] = (788_000, 936_000)
    incidence_deg: tuple[int, int] = (30, 45)
    speed_m_s: float = 7600.0
    heading_ascending: float = 349.0
    heading_descending: float = 191.0


@dataclass(frozen=True)
class Thermal:
    """Surface temperature from a thermal band and a vegetation index."""

    radiance_mult: float = 0.00038
    radiance_add: float = 0.1
    k1: float = 799.0284
    k2: float = 1329.2405
    wavelength_term: float = 0.00115
    rho: float = 1.4388
    kelvin: float = 273.15
    valid_c: tuple[float, float] = (-50.0, 80.0)
    ndvi: tuple[float, float] = (0.2, 0.5)
    soil: float = 0.996
    vegetation: float = 0.973
    water: float = 0.991
    qa_bits: int = (1 << 3) | (1 << 4)


@dataclass(frozen=True)
class Change:
    """Amplitude change test."""

    looks: float = 4.4
    quantile: float = 0.001
    quantile_div: float = 10.0
    df: float = 500.0
    least_blob: int = 30
    sigma: float = 5.0


@dataclass(frozen=True)
class Detector:
    """Tiling, scaling and suppression of the two detectors."""

    tile: int = 640
    overlap: int = 200
    conf: float = 0.05
    iou: float = 0.3
    band_max: tuple[float, ...] = (0.15, 0.5, 50.0)
    band_min: tuple[float, ...] = (0.0, 0.0, 0.0)
    div: int = 5
    div_conf: float = 0.15
    div_iou: float = 0.4
    most_in: int = 30_000
    most_out: int = 300
    shore_median: int = 5
    shore_erosions: int = 5
    shore_level: float = 35.0
    shore_area: int = 600


@dataclass(frozen=True)
class Alignment:
    patch: int = 128
    percentiles: tuple[float, float] = (0.01, 0.99)
    upsample: int = 100
    degree: int = 3


@dataclass(frozen=True)
class Defaults:
    platform: Platform = field(default_factory=Platform)
    thermal: Thermal = field(default_factory=Thermal)
    change: Change = field(default_factory=Change)
    detector: Detector = field(default_factory=Detector)
    alignment: Alignment = field(default_factory=Alignment)


DEFAULTS = Defaults()
