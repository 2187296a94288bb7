"""Strings, times and look-ups."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

#: Microseconds of each unit in a duration such as "10s" (fixed values).
UNITS = {"us": 1, "ms": 1_000, "s": 1_000_000, "min": 60_000_000, "h": 3_600_000_000, "D": 86_400_000_000}


def duration_micros(text: str) -> int:
    found = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*(us|ms|s|min|h|D)\s*", text)
    if not found:
        raise ValueError(f"not a duration: {text!r}")
    return round(float(found[1]) * UNITS[found[2]])


def micros(time: Column) -> Column:
    """A timestamp, with or without zone, as microseconds since 1970 (UTC)."""
    return F.unix_micros(time.cast("timestamp"))


def year_of(name: Column) -> Column:
    """The first four digits in a row, or 0."""
    found = F.regexp_extract(name, r"(\d{4})", 1)
    return F.when(found == "", 0).otherwise(found.cast("int"))


def segment_of(frame_id: Column) -> Column:
    """``Data_YYYYMMDD_SS_FFF`` -> ``YYYYMMDD_SS``."""
    parts = F.split(frame_id, "_")
    return F.concat_ws("_", F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))


def instrument_of(flight: Column) -> Column:
    return F.when(flight.startswith("b"), "PASIN").otherwise("HiCARS")


def radargram_folder(flight: Column, present: Sequence[str] | None = None) -> Column:
    """The folder of a flight's radargrams by its name's beginning; none if it is not among those present."""
    folder = F.when(flight.startswith("b"), "PASIN").when(flight.startswith("DRP"), "UTIG_D").otherwise(flight)
    return folder if present is None else F.when(folder.isin(list(present)), folder)


def short_number(value: Column, scale: float = 1.0) -> Column:
    return F.format_string("%.4g", value * scale)


def shown_date(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm")


def decoded_time(number: Column, unit: str, epoch_micros: int = 0) -> Column:
    """A count of units since an epoch, as data files store times."""
    return F.timestamp_micros((number * UNITS[unit] + epoch_micros).cast("long"))


def encoded_time(time: Column, unit: str, epoch_micros: int = 0) -> Column:
    return (micros(time) - epoch_micros) / UNITS[unit]


def colour_index(name: str, palette: int) -> Column:
    """A stable colour for each of a few distinct names: their order, round the palette. For tables of names."""
    return ((F.dense_rank().over(Window.orderBy(name)) - 1) % palette).cast("int")


def draw_order(is_censored: Column) -> Column:
    """Censored points are drawn first, so that coloured ones lie above them."""
    return F.when(is_censored, 0).otherwise(1)


def looked_up(mapping: Column, key: Column, fallback: str = "unknown") -> Column:
    return F.coalesce(F.try_element_at(mapping, key), F.lit(fallback))
