"""Polar projections and plane geometry as column expressions."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Ring = list[tuple[float, float]]

#: WGS 84 (fixed values).
SEMI_MAJOR = 6_378_137.0
FLATTENING = 1 / 298.257223563
ECCENTRICITY = math.sqrt(2 * FLATTENING - FLATTENING**2)


@dataclass(frozen=True)
class Polar:
    """Polar stereographic projection, true to scale at a parallel (Snyder 1987; EPSG method 9829)."""

    code: str
    south: bool
    true_scale: float  # degrees, positive
    meridian: float  # degrees

    @property
    def factor(self) -> float:
        phi = math.radians(self.true_scale)
        s = ECCENTRICITY * math.sin(phi)
        m = math.cos(phi) / math.sqrt(1 - s * s)
        return SEMI_MAJOR * m / (math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (ECCENTRICITY / 2))


ANTARCTIC = Polar("EPSG:3031", True, 71.0, 0.0)
ARCTIC = Polar("EPSG:3413", False, 70.0, -45.0)


def projection_of(mean_latitude: float) -> Polar:
    return ANTARCTIC if mean_latitude < 0 else ARCTIC


def hemisphere(latitude: Column) -> Column:
    """Aggregate: the hemisphere a set of points lies in."""
    return F.when(F.avg(latitude) < 0, "south").otherwise("north")


def project(latitude: Column, longitude: Column, to: Polar) -> tuple[Column, Column]:
    phi = F.radians(-latitude if to.south else latitude)
    s = F.sin(phi) * ECCENTRICITY
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(ECCENTRICITY / 2))
    rho, angle = t * to.factor, F.radians(longitude - to.meridian)
    y = rho * F.cos(angle)
    return rho * F.sin(angle), y if to.south else -y


def unproject(x: Column, y: Column, to: Polar, steps: int = 6) -> tuple[Column, Column]:
    """Latitude and longitude in degrees; ``steps`` of the usual fixed-point iteration."""
    t = F.sqrt(x * x + y * y) / to.factor
    phi = math.pi / 2 - 2 * F.atan(t)
    for _ in range(steps):
        s = F.sin(phi) * ECCENTRICITY
        phi = math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(ECCENTRICITY / 2)))
    angle = F.degrees(F.atan2(x, y if to.south else -y))
    longitude = F.pmod(angle + (to.meridian + 180.0), F.lit(360.0)) - 180.0
    return F.degrees(-phi if to.south else phi), longitude


def _edges(rings: Sequence[Ring]) -> list[list[dict[str, float]]]:
    """Per ring, each edge that is not level: its lower end, its upper end's height and how far x moves per unit of y."""
    out = []
    for ring in rings:
        pairs = [sorted((p, q), key=lambda point: point[1]) for p, q in zip(ring, [*ring[1:], ring[0]]) if p[1] != q[1]]
        out.append([{"x": float(p[0]), "low": float(p[1]), "high": float(q[1]), "slope": (q[0] - p[0]) / (q[1] - p[1])} for p, q in pairs])
    return out


def _rings(shape: Ring | Sequence[Ring]) -> list[Ring]:
    return [list(shape)] if shape and not isinstance(shape[0][0], Sequence) else [list(ring) for ring in shape]


def in_polygon(x: Column, y: Column, shape: Ring | Sequence[Ring]) -> Column:
    """Whether a point lies in a ring, or in any of several: an odd number of edges passes to its right.

    The shape is one literal however many vertices it has. A point without coordinates is outside.
    """
    rings = _rings(shape)
    corners = [p for ring in rings for p in ring]
    if not corners:
        return F.lit(False)
    edges = F.from_json(F.lit(json.dumps(_edges(rings))), "array<array<struct<x:double,low:double,high:double,slope:double>>>")
    passes = lambda e: (e["low"] <= y) & (y < e["high"]) & (e["x"] + (y - e["low"]) * e["slope"] > x)
    inside = F.exists(edges, lambda ring: F.size(F.filter(ring, passes)) % 2 == 1)
    box = x.between(min(p[0] for p in corners), max(p[0] for p in corners)) & y.between(min(p[1] for p in corners), max(p[1] for p in corners))
    return F.coalesce(F.when(box, inside), F.lit(False))


def box_meets(x_min: Column, y_min: Column, x_max: Column, y_max: Column, shape: Ring | Sequence[Ring]) -> Column:
    """Whether a box and a polygon have a point in common: an edge touches the box, or the box lies inside."""
    rings = _rings(shape)
    halves = [{"x": (p[0] + q[0]) / 2, "y": (p[1] + q[1]) / 2, "dx": (q[0] - p[0]) / 2, "dy": (q[1] - p[1]) / 2} for ring in rings for p, q in zip(ring, [*ring[1:], ring[0]])]
    edges = F.from_json(F.lit(json.dumps(halves)), "array<struct<x:double,y:double,dx:double,dy:double>>")
    wide, tall = (x_max - x_min) / 2, (y_max - y_min) / 2

    def touches(e: Column) -> Column:  # no axis separates the edge from the box
        ox, oy = e["x"] - (x_min + x_max) / 2, e["y"] - (y_min + y_max) / 2
        apart = (F.abs(ox) > wide + F.abs(e["dx"])) | (F.abs(oy) > tall + F.abs(e["dy"]))
        return ~apart & (F.abs(e["dx"] * oy - e["dy"] * ox) <= wide * F.abs(e["dy"]) + tall * F.abs(e["dx"]))

    return F.coalesce(F.exists(edges, touches), F.lit(False)) | in_polygon(x_min, y_min, rings)


def in_view(latitude: Column, longitude: Column, south: float, west: float, north: float, east: float) -> Column:
    return latitude.between(south, north) & longitude.between(west, east)


def segment_distance(x: Column, y: Column, xa: Column, ya: Column, xb: Column, yb: Column) -> Column:
    """Distance from a point to a line segment."""
    dx, dy = xb - xa, yb - ya
    along = F.coalesce(F.try_divide((x - xa) * dx + (y - ya) * dy, dx * dx + dy * dy), F.lit(0.0))
    along = F.least(F.lit(1.0), F.greatest(F.lit(0.0), along))
    ex, ey = x - (xa + along * dx), y - (ya + along * dy)
    return F.sqrt(ex * ex + ey * ey)


def box_around(x: Column, y: Column, margin: float = 50_000.0) -> list[Column]:
    """Aggregates: the corners of a square around the points' centroid."""
    return [(F.avg(x) - margin).alias("x_min"), (F.avg(y) - margin).alias("y_min"), (F.avg(x) + margin).alias("x_max"), (F.avg(y) + margin).alias("y_max")]
