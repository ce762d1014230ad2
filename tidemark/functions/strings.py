"""Names, codes and small text formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import NO_TARGET, TARGET_CODES


def target_code(name: Column) -> Column:
    """The five-letter code of a target name, case aside; NO_TARGET for any other."""
    return F.coalesce(F.create_map(*(F.lit(x) for pair in TARGET_CODES.items() for x in pair))[F.lower(name)], F.lit(NO_TARGET))


# Fixed value: the punctuation that cleaned() replaces.
PUNCTUATION = "[|@#!¡·$€%&()=?¿^*;:,¨´><+]"


def cleaned(text: Column) -> Column:
    """Punctuation replaced by underscores."""
    return F.regexp_replace(text, PUNCTUATION, "_")


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def product_name(text: Column, place_chars: int = 5, marker: str = "RGB", rest_chars: int = 6) -> Column:
    """Whether a name reads <place>_<marker><rest>... with parts of the given lengths."""
    parts = F.split(text, "_")
    place, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.coalesce((F.char_length(place) == place_chars) & second.startswith(marker) & (F.char_length(second) == len(marker) + rest_chars), F.lit(False))


def four_numbers(text: Column) -> Column:
    """An array of exactly four numbers written with commas or spaces, else NULL."""
    parts = F.transform(F.split(F.trim(text), r"[,\s]+"), lambda x: x.try_cast("double"))
    return F.when((F.size(parts) == 4) & ~F.exists(parts, lambda x: x.isNull() | F.isnan(x)), parts)


def box_or_point(text: Column, margin: float = 0.02) -> Column:
    """Four numbers as they are; two (lon, lat) as the box around the point; else NULL."""
    parts = F.transform(F.split(F.trim(text), r"[,\s]+"), lambda x: x.try_cast("double"))
    sound = ~F.exists(parts, lambda x: x.isNull() | F.isnan(x))
    lon, lat = parts[0], parts[1]
    return F.when(sound & (F.size(parts) == 4), parts).when(sound & (F.size(parts) == 2), F.array(lon - margin, lat - margin, lon + margin, lat + margin))


def scene_times(name: Column) -> tuple[Column, Column]:
    """(start, end) timestamps in a radar product name: yyyyMMddTHHmmss at character 17 and at 33."""
    at = lambda k: F.try_to_timestamp(F.concat(F.substring(name, k + 1, 8), F.substring(name, k + 10, 6)), F.lit("yyyyMMddHHmmss"))
    return at(17), at(33)


def date_and_time(epoch: Column) -> tuple[Column, Column]:
    """('yyyy-MM-dd', 'HH:mm:ss') of seconds since 1970, in the session's time zone."""
    at = F.timestamp_seconds(F.floor(epoch))
    return F.date_format(at, "yyyy-MM-dd"), F.date_format(at, "HH:mm:ss")
