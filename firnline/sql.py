"""SQL functions over the same expressions: ``register(spark)`` makes them temporary functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from firnline.functions.geo import ANTARCTIC, ARCTIC, ECCENTRICITY
from firnline.functions.physics import LIGHT


def definitions() -> dict[str, str]:
    """Name with parameters -> body."""
    def t(phi: str) -> str:
        return f"tan(pi() / 4 - {phi} / 2) / power((1 - {ECCENTRICITY!r}D * sin({phi})) / (1 + {ECCENTRICITY!r}D * sin({phi})), {ECCENTRICITY / 2!r}D)"

    south, north = f"({ANTARCTIC.factor!r}D * {t('radians(-lat)')})", f"({ARCTIC.factor!r}D * {t('radians(lat)')})"
    return {
        "to_db(p DOUBLE)": "CASE WHEN p > 0 THEN 10 * log10(p) END",
        "from_db(l DOUBLE)": "power(10, l / 10)",
        "ice_thickness(ts DOUBLE, tb DOUBLE, eps DOUBLE)": f"(tb - ts) * {LIGHT / 2!r}D / sqrt(eps)",
        "required_surface_snr(ps DOUBLE, pb DOUBLE, ts DOUBLE, tb DOUBLE, eps DOUBLE)": "ps - pb + CASE WHEN ts > 0 AND tb > ts - ts * eps THEN 20 * log10(ts / (ts + (tb - ts) / eps)) END",
        "acute_angle(a DOUBLE, b DOUBLE)": "least(pmod(abs(a - b), 180), 180 - pmod(abs(a - b), 180))",
        "antarctic_x(lat DOUBLE, lon DOUBLE)": f"{south} * sin(radians(lon))",
        "antarctic_y(lat DOUBLE, lon DOUBLE)": f"{south} * cos(radians(lon))",
        "arctic_x(lat DOUBLE, lon DOUBLE)": f"{north} * sin(radians(lon + 45))",
        "arctic_y(lat DOUBLE, lon DOUBLE)": f"-{north} * cos(radians(lon + 45))",
    }


def window_definitions() -> dict[str, str]:
    """The same for functions of a trace's samples and their times."""
    both, finite = "data ARRAY<DOUBLE>, twtt ARRAY<DOUBLE>", "p IS NOT NULL AND NOT isnan(p) AND abs(p) < double('infinity')"
    inside = "slice(data, size(filter(twtt, t -> t < {0})) + 1, greatest(0, size(filter(twtt, t -> t <= {1})) - size(filter(twtt, t -> t < {0}))))"
    around = inside.format("pick - margin", "pick + margin")
    middle = f"sort_array(filter({inside.format('low', 'high')}, p -> {finite}))"
    median = f"transform(array({middle}), m -> CASE WHEN size(m) > 0 THEN (m[(size(m) - 1) div 2] + m[size(m) div 2]) / 2 END)[0]"
    db = "transform(array({0}), v -> CASE WHEN v > 0 THEN 10 * log10(v) END)[0]"
    return {
        f"window_max_db({both}, pick DOUBLE, margin DOUBLE)": db.format(f"array_max(filter({around}, p -> p IS NOT NULL AND NOT isnan(p)))"),
        f"window_median_db({both}, low DOUBLE, high DOUBLE)": f"CASE WHEN high > low THEN {db.format(median)} END",
        f"window_count({both}, low DOUBLE, high DOUBLE)": f"double(size({inside.format('low', 'high')}))",
    }


def register(spark: SparkSession) -> list[str]:
    every = definitions() | window_definitions()
    for head, body in every.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS DOUBLE RETURN {body}")
    return [head.split("(")[0] for head in every]
