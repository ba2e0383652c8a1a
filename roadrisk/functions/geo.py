"""Geometry as column expressions: haversine distance and point-in-polygon.

Areas are ``rings: array<array<struct<x double, y double>>>``: the exterior ring
and holes of each of their parts, which don't overlap; a point is two doubles. The within-test uses the
even-odd crossing rule across all rings (so holes subtract) and treats a point
on any edge or vertex as *not* within, as a strict ``within`` predicate does.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col_

EARTH_RADIUS_M = 6371000.0


def haversine_m(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres between two (lat, lon) points in degrees."""
    p1, p2 = F.radians(col_(lat1)), F.radians(col_(lat2))
    dphi = p2 - p1
    dlmb = F.radians(col_(lon2)) - F.radians(col_(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def meters_to_degrees(eps_m: float, radius: float = EARTH_RADIUS_M) -> float:
    """Arc of ``eps_m`` metres on the sphere, in degrees."""
    return math.degrees(eps_m / radius)


def lon_span_degrees(eps_m: float, max_abs_lat_deg: float, radius: float = EARTH_RADIUS_M) -> float:
    """Largest longitude difference two points within ``eps_m`` can have, both at
    |lat| <= ``max_abs_lat_deg``: d >= 2R asin(cos(lat_max) sin(dlon/2))."""
    c = math.cos(math.radians(min(max_abs_lat_deg, 89.999)))
    s = min(1.0, eps_m / (2 * radius * c))
    return math.degrees(2 * math.asin(s)) if s < 1.0 else 360.0


_RING_CROSSINGS = (
    "aggregate(sequence(0, greatest(size(r) - 2, 0)), 0, (acc, i) -> acc + "
    "CASE WHEN ((r[i].y > {py}) <> (r[i + 1].y > {py})) AND "
    "({px} < (r[i + 1].x - r[i].x) * ({py} - r[i].y) / (r[i + 1].y - r[i].y) + r[i].x) THEN 1 ELSE 0 END)"
)
_RING_TOUCH = (
    "exists(sequence(0, greatest(size(r) - 2, 0)), i -> "
    "((r[i + 1].x - r[i].x) * ({py} - r[i].y) - (r[i + 1].y - r[i].y) * ({px} - r[i].x)) = 0 "
    "AND {px} BETWEEN least(r[i].x, r[i + 1].x) AND greatest(r[i].x, r[i + 1].x) "
    "AND {py} BETWEEN least(r[i].y, r[i + 1].y) AND greatest(r[i].y, r[i + 1].y))"
)


def point_within_sql(rings: str, px: str, py: str) -> str:
    """SQL text of the strict within test (even-odd over all rings, edges excluded)."""
    cross = _RING_CROSSINGS.format(px=px, py=py)
    touch = _RING_TOUCH.format(px=px, py=py)
    return (
        f"(aggregate(transform({rings}, r -> {cross}), 0, (a, v) -> a + v) % 2 = 1 "
        f"AND NOT exists({rings}, r -> {touch}))"
    )


def point_within(rings, x, y) -> Column:
    """True when point (x, y) lies strictly inside the polygon given by ``rings``.

    Arguments are column names; the test is one SQL expression (a single call
    into the JVM instead of a tree of lambda columns built in Python).
    """
    return F.expr(point_within_sql(rings, x, y))


def ring_bounds(rings) -> dict[str, Column]:
    """Bounding box of all rings: an area may have several exterior ones."""
    ext = F.flatten(col_(rings))
    xs = F.transform(ext, lambda p: p["x"])
    ys = F.transform(ext, lambda p: p["y"])
    return {"lon_lo": F.array_min(xs), "lon_hi": F.array_max(xs), "lat_lo": F.array_min(ys), "lat_hi": F.array_max(ys)}
