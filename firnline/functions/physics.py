"""Radar and ice physics as column expressions.

Powers are linear unless a name says dB. Missing values are NULL; a logarithm of a value that is not positive is NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Speed of light in m/s, relative permittivity of ice, the refractive index used with sounder picks, and the level of
#: the high-gain channel over the low-gain one in dB (fixed values).
LIGHT = 299_792_458.0
ICE_PERMITTIVITY = 3.17
SOUNDER_ICE_INDEX = 1.78
HIGH_GAIN_DB = 39.0


def to_db(power: Column) -> Column:
    return F.when(power > 0, F.lit(10.0) * F.log10(power))


def from_db(level: Column) -> Column:
    return F.pow(F.lit(10.0), level / 10.0)


def magnitude(real: Column, imaginary: Column) -> Column:
    return F.sqrt(real * real + imaginary * imaginary)


def ice_speed(permittivity: float = ICE_PERMITTIVITY) -> float:
    return LIGHT / math.sqrt(permittivity)


def margin_seconds(metres: float, permittivity: float = ICE_PERMITTIVITY) -> float:
    """Half width of a search window that spans ``metres`` of ice, one way."""
    return metres / ice_speed(permittivity)


def microseconds(seconds: Column) -> Column:
    return seconds * 1e6


def surface_elevation(platform: Column, surface_twtt: Column) -> Column:
    return platform - surface_twtt * (LIGHT / 2)


def bed_elevation(surface: Column, surface_twtt: Column, bed_twtt: Column, permittivity: float = ICE_PERMITTIVITY) -> Column:
    return surface - ice_thickness(surface_twtt, bed_twtt, permittivity)


def ice_thickness(surface_twtt: Column, bed_twtt: Column, permittivity: float = ICE_PERMITTIVITY) -> Column:
    return (bed_twtt - surface_twtt) * (ice_speed(permittivity) / 2)


def thickness_between(surface: Column, bed: Column) -> Column:
    """Thickness from elevations instead of travel times."""
    return surface - bed


def required_surface_snr_db(surface_db: Column, bed_db: Column, surface_twtt: Column, bed_twtt: Column, permittivity: float = ICE_PERMITTIVITY) -> Column:
    """Surface over bed power after spherical spreading, both ranges as in air: the bed lies thickness / n below."""
    index = math.sqrt(permittivity)
    surface_range = surface_twtt * (LIGHT / 2)
    bed_range = surface_range + ice_thickness(surface_twtt, bed_twtt, permittivity) / index
    ratio = F.try_divide(surface_range, bed_range)
    return surface_db - bed_db + F.when(ratio > 0, F.lit(20.0) * F.log10(ratio))


def bed_snr_db(bed_db: Column, noise_db: Column) -> Column:
    return bed_db - noise_db


def sounder_times(height: Column, thickness: Column, index: float = SOUNDER_ICE_INDEX) -> tuple[Column, Column]:
    """Surface and bed travel times of a platform ``height`` over ice of a thickness."""
    surface = height * (2 / LIGHT)
    return surface, surface + thickness * (2 * index / LIGHT)


def levelled_gain(instrument: Column, low_gain_db: Column, high_gain_db: Column, two_channel: str = "HiCARS") -> tuple[Column, Column]:
    """Surface and bed levels on one scale: two-channel instruments take the bed from the high-gain channel."""
    return low_gain_db, F.when(instrument == two_channel, high_gain_db - HIGH_GAIN_DB).otherwise(low_gain_db)


def acute_angle(first: Column, second: Column) -> Column:
    d = F.pmod(F.abs(first - second), F.lit(180.0))
    return F.least(d, 180.0 - d)


def midpoint(a: Column, b: Column) -> Column:
    return (a + b) / 2


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def rms(value: Column) -> Column:
    """Aggregate: root of the mean square."""
    return F.sqrt(F.avg(value * value))


def simplify_tolerance(area_km2: Column) -> Column:
    """Metres by which a region's outline may be simplified."""
    return F.when(area_km2 >= 100_000, 1000.0).when(area_km2 >= 10_000, 100.0).otherwise(0.0)


def signed_distance(inside: Column, metres: Column) -> Column:
    """Positive on grounded ice, negative on floating ice."""
    return F.when(inside, metres).otherwise(-metres)


def colour_fraction(value: Column, low: Column | float, high: Column | float) -> Column:
    """Where a value lies between the limits of a scale, 0 to 1."""
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    share = F.try_divide(value - low, high - low)  # least() and greatest() pass over a missing value
    return F.when(share.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), share)))


def log_fraction(value: Column, low: float, high: float, nodata: float = -32767.0) -> Column:
    """The same on a logarithmic scale; no-data and values that are not positive have none."""
    shown = F.when((value > 0) & (value != nodata), value)
    return colour_fraction(F.log(shown), math.log(low), math.log(high))
