"""Coordinate systems: the SRID of a table's coordinates, checks, and closed-form reprojection as columns.

A table carries its SRID in the metadata of both coordinate columns, which Spark keeps through selections and in
Parquet. Known systems: 4326 (degrees), 3857 (spherical Mercator metres) and the UTM zones 32601-32660 (north)
and 32701-32760 (south) on the same ellipsoid. UTM uses the series in the third flattening n up to n^4, whose
error is below a micrometre inside a zone; all of it is arithmetic on columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: ellipsoid, UTM scale and false origin, series coefficients ----
A, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, FALSE_EAST, FALSE_NORTH = 0.9996, 500000.0, 10000000.0
N = FLATTENING / (2 - FLATTENING)
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ALPHA = (N / 2 - 2 / 3 * N**2 + 5 / 16 * N**3 + 41 / 180 * N**4, 13 / 48 * N**2 - 3 / 5 * N**3 + 557 / 1440 * N**4, 61 / 240 * N**3 - 103 / 140 * N**4, 49561 / 161280 * N**4)
BETA = (N / 2 - 2 / 3 * N**2 + 37 / 96 * N**3 - 1 / 360 * N**4, 1 / 48 * N**2 + 1 / 15 * N**3 - 437 / 1440 * N**4, 17 / 480 * N**3 - 37 / 840 * N**4, 4397 / 161280 * N**4)
DELTA = (2 * N - 2 / 3 * N**2 - 2 * N**3 + 116 / 45 * N**4, 7 / 3 * N**2 - 8 / 5 * N**3 - 227 / 45 * N**4, 56 / 15 * N**3 - 136 / 35 * N**4, 4279 / 630 * N**4)
ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))


class CrsError(ValueError):
    """A table without a coordinate system, with two, or with one that is not known."""


def known(srid: int) -> bool:
    return srid in (4326, 3857) or 32601 <= srid <= 32660 or 32701 <= srid <= 32760


def with_srid(df: DataFrame, srid: int, x: str = "lon", y: str = "lat") -> DataFrame:
    """``df`` declared to hold coordinates of ``srid``; a declared one cannot be replaced by another."""
    if not known(srid):
        raise CrsError(f"unknown SRID {srid}")
    for c in (x, y):
        had = df.schema[c].metadata.get("srid")
        if had is not None and had != srid:
            raise CrsError(f"{c} has SRID {had}, not {srid}: reproject instead")
        df = df.withMetadata(c, {**df.schema[c].metadata, "srid": srid})
    return df


def srid_of(df: DataFrame, x: str = "lon", y: str = "lat") -> int:
    """The table's SRID; an error where none, an unknown one or two different ones are declared."""
    found = {df.schema[c].metadata.get("srid") for c in (x, y)}
    if len(found) > 1:
        raise CrsError(f"{x} and {y} have different SRIDs: {sorted(map(str, found))}")
    (srid,) = found
    if srid is None:
        raise CrsError(f"{x} and {y} have no SRID")
    if not known(srid):
        raise CrsError(f"unknown SRID {srid}")
    return srid


def require_srid(srid: int, *tables: DataFrame, x: str = "lon", y: str = "lat") -> None:
    """An error unless all tables that are to meet in one join are in ``srid``."""
    for k, t in enumerate(tables):
        if (have := srid_of(t, x, y)) != srid:
            raise CrsError(f"table {k}: SRID {have}, expected {srid}")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``; an error when it has no row (one row is looked for, the table is not counted)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def _zone(srid: int) -> tuple[float, float]:
    """Central meridian in degrees and false northing of a UTM zone."""
    return (srid % 100) * 6 - 183.0, FALSE_NORTH if srid >= 32700 else 0.0


def _geographic(srid: int, x: Column, y: Column) -> tuple[Column, Column]:
    """Degrees of longitude and latitude."""
    if srid == 4326:
        return x, y
    if srid == 3857:
        return F.degrees(x / A), F.degrees(2 * F.atan(F.exp(y / A)) - math.pi / 2)
    meridian, north = _zone(srid)
    xi, eta = (y - north) / (SCALE * RADIUS), (x - FALSE_EAST) / (SCALE * RADIUS)
    xi_, eta_ = xi, eta
    for j, b in enumerate(BETA, 1):
        xi_ = xi_ - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_ = eta_ - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_) / F.cosh(eta_))
    lat = chi
    for j, d in enumerate(DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return meridian + F.degrees(F.atan2(F.sinh(eta_), F.cos(xi_))), F.degrees(lat)


def _projected(srid: int, lon: Column, lat: Column) -> tuple[Column, Column]:
    if srid == 4326:
        return lon, lat
    if srid == 3857:
        return A * F.radians(lon), A * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))
    meridian, north = _zone(srid)
    s, away = F.sin(F.radians(lat)), F.radians(lon - meridian)
    t = F.sinh(F.atanh(s) - ECCENTRICITY * F.atanh(ECCENTRICITY * s))
    xi, eta = F.atan2(t, F.cos(away)), F.asinh(F.sin(away) / F.sqrt(t * t + F.cos(away) * F.cos(away)))
    e, n = eta, xi
    for j, a in enumerate(ALPHA, 1):
        e = e + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n = n + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return FALSE_EAST + SCALE * RADIUS * e, north + SCALE * RADIUS * n


def reproject(df: DataFrame, srid: int, x: str = "lon", y: str = "lat") -> DataFrame:
    """``df`` with its coordinates in ``srid``; null coordinates stay null."""
    if not known(srid):
        raise CrsError(f"unknown SRID {srid}")
    have = srid_of(df, x, y)
    if have == srid:
        return df
    lon, lat = _geographic(have, F.col(x), F.col(y))
    # degrees go through columns of their own, so that each expression is written out once
    mid = df.withColumns({"_lon": lon, "_lat": lat})
    px, py = _projected(srid, F.col("_lon"), F.col("_lat"))
    plain = {c: {k: v for k, v in df.schema[c].metadata.items() if k != "srid"} for c in (x, y)}
    out = mid.withColumns({x: px, y: py}).drop("_lon", "_lat")
    for c in (x, y):
        out = out.withMetadata(c, {**plain[c], "srid": srid})
    return out
