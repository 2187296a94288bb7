"""Quality checks of traces, the masks that follow from them, and the frame gates.

A check is a boolean column; a disabled one is TRUE. Checks that need a bed pick fail where there is none. The
definitions behind the configuration's names are this module's; its parameters and masks are those of the trace table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline.functions.physics import LIGHT, ice_thickness

#: Columns that only the surface checks mask, and those that every check masks (fixed by the table's contract).
SURFACE_COLUMNS = ("surface_twtt", "surface_power_dB", "surface_elevation", "pre_surface_noise_dB", "record_tail_noise_dB", "post_bed_noise_interp_dB", "post_bed_peak_interp_dB", "post_bed_std_interp_dB")
BED_COLUMNS = ("bed_twtt", "bed_power_dB", "bed_elevation", "required_surface_snr_dB", "post_bed_noise_dB")
SURFACE_CHECKS = ("heading_change", "minimum_agl")


def heading_change(limit: float) -> Column:
    """Turning rate, in degrees per kilometre flown, from ``heading_step`` (degrees) and ``step_km``."""
    d = F.pmod(F.abs(F.col("heading_step")), F.lit(360.0))
    turn = F.least(d, 360.0 - d)
    return F.coalesce(F.when(F.col("step_km") > 0, turn / F.col("step_km") <= limit), F.lit(True))


def minimum_agl(limit: float) -> Column:
    return F.coalesce(F.col("surface_pick") * (LIGHT / 2) >= limit, F.lit(False))


def ice_thickness_threshold(limit: float) -> Column:
    return F.coalesce(ice_thickness(F.col("surface_pick"), F.col("bed_pick")) >= limit, F.lit(False))


def snr_bed_pick(limit: float) -> Column:
    return F.coalesce(F.col("bed_pick_power_dB") - F.col("bed_pick_noise_dB") >= limit, F.lit(False))


CHECKS: dict[str, Callable[[float], Column]] = {"heading_change": heading_change, "minimum_agl": minimum_agl, "ice_thickness_threshold": ice_thickness_threshold, "snr_bed_pick": snr_bed_pick}


def enabled(limits: dict[str, float | None]) -> dict[str, Column]:
    """The checks whose limit is set."""
    unknown = set(limits) - set(CHECKS)
    if unknown:
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    return {name: CHECKS[name](limit) for name, limit in limits.items() if limit is not None}


def flags(checks: dict[str, Column]) -> dict[str, Column]:
    """qc_pass, qc_surface_pass, qc_heading_pass and qc_agl_pass."""

    def both(names: Sequence[str]) -> Column:
        out = F.lit(True)
        for name in names:
            out = out & checks.get(name, F.lit(True))
        return out

    return {"qc_pass": both(list(checks)), "qc_surface_pass": both(SURFACE_CHECKS), "qc_heading_pass": both(["heading_change"]), "qc_agl_pass": both(["minimum_agl"])}


def mask(traces: DataFrame, surface: Sequence[str] = SURFACE_COLUMNS, bed: Sequence[str] = BED_COLUMNS) -> DataFrame:
    """NULL where the check that a column depends on fails."""
    changes = {c: F.when(F.col("qc_surface_pass"), F.col(c)) for c in surface if c in traces.columns}
    changes |= {c: F.when(F.col("qc_pass"), F.col(c)) for c in bed if c in traces.columns}
    return traces.withColumns(changes)


def enough_traces(traces: DataFrame, by: Sequence[str], least: int, flag: str = "qc_surface_pass") -> DataFrame:
    """Frames with at least ``least`` passing traces."""
    passing = F.count_if(F.col(flag)).over(Window.partitionBy(*by))
    return traces.withColumn("_passing", passing).where(F.col("_passing") >= least).drop("_passing")


def passing(traces: DataFrame, flag: str = "qc_pass") -> DataFrame:
    """Rows that pass; tables without the flag pass whole."""
    return traces.where(F.col(flag)) if flag in traces.columns else traces


def surface_flag(traces: DataFrame) -> Column:
    """The mask for columns above the bed: the surface flag, or in older tables the only one there is."""
    names = [n for n in ("qc_surface_pass", "qc_pass") if n in traces.columns]
    return F.coalesce(*[F.col(n) for n in names]) if names else F.lit(True)


def mask_of(variable: str) -> str:
    return "qc_pass" if variable in BED_COLUMNS else "qc_surface_pass"


def censored(surface_pass: Column, attempted: Column, available: Column) -> Column:
    """A bed was looked for on a good trace and not found."""
    return surface_pass & attempted & ~available


def has_censoring(traces: DataFrame) -> bool:
    return {"qc_surface_pass", "bed_pick_attempted", "bed_pick_available"} <= set(traces.columns)


def finite(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != float("inf"))
    return out
