"""Crash cleaning and point preparation (row filters and projection only).

These are narrow transformations: no shuffle, filters push into the scan where
the predicates touch stored columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import all_of, coerce_double, null_false
from ..schemas import ENV_COLUMNS, INJURY_COLUMNS_ALL, NO_INJURY, REQUIRED_COLUMNS, require_columns


def coerce_coordinates(df: DataFrame, lat: str = "LATITUDE", lon: str = "LONGITUDE") -> DataFrame:
    """Parse coordinate text leniently: junk and 'NaN' become NULL."""
    return df.withColumns({lat: coerce_double(lat), lon: coerce_double(lon)})


def valid_coordinates(lat: str = "LATITUDE", lon: str = "LONGITUDE"):
    """In range, not null and *neither* coordinate zero."""
    la, lo = F.col(lat), F.col(lon)
    return all_of([la.between(-90, 90), lo.between(-180, 180), la.isNotNull(), lo.isNotNull(), la != 0, lo != 0])


def clean_crashes(df: DataFrame, keep_columns=REQUIRED_COLUMNS, extra_columns=()) -> DataFrame:
    """Rows valid for risk mapping, projected to the required columns.

    Drops: invalid coordinates; rows whose 8 environment columns are all null;
    zero-injury drive-away rows (injury counts with null as 0 sum to 0 and the
    crash type is the drive-away label; a null type never matches).
    """
    require_columns(df, REQUIRED_COLUMNS, "crash")
    df = coerce_coordinates(df)
    env_present = F.coalesce(*[F.col(c) for c in ENV_COLUMNS]).isNotNull()
    injury_sum = sum(F.coalesce(F.col(c), F.lit(0)) for c in INJURY_COLUMNS_ALL)
    drive_away = null_false((injury_sum == 0) & (F.col("CRASH_TYPE") == NO_INJURY))
    out = df.filter(valid_coordinates()).filter(env_present).filter(~drive_away)
    return out.select(*extra_columns, *keep_columns)


def crash_points(df: DataFrame, lat: str = "LATITUDE", lon: str = "LONGITUDE") -> DataFrame:
    """Point table: coerce, keep in-range non-null rows, drop only (0, 0) points.

    The point is carried as two doubles ``lon``/``lat`` (WGS84).
    """
    df = coerce_coordinates(df, lat, lon)
    la, lo = F.col(lat), F.col(lon)
    keep = all_of([la.isNotNull(), lo.isNotNull(), la.between(-90, 90), lo.between(-180, 180), ~((la == 0) & (lo == 0))])
    return df.filter(keep).withColumns({"lon": lo, "lat": la})


def drop_zero_points(df: DataFrame, lat: str = "LATITUDE", lon: str = "LONGITUDE") -> DataFrame:
    """Drop missing coordinates and points where *both* coordinates are zero."""
    df = coerce_coordinates(df, lat, lon).dropna(subset=[lat, lon])
    return df.filter(~((F.col(lat) == 0) & (F.col(lon) == 0)))
