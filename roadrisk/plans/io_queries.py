"""Registered queries: GeoJSON round trips through the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from ..sources.geojson import polygon_features, read_geojson_points, read_geojson_polygons, write_geojson_lines
from . import stages as S
from .registry import register, rounded, sql


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io/{name}-{uuid.uuid4().hex[:12]}"


@register("geojson_roundtrip", sql(
    "SELECT crash_id, community_area_number, round(weighted_severity, 9) AS weighted_severity, "
    "round(lon, 9) AS lon, round(lat, 9) AS lat FROM severity"))
def geojson_roundtrip(spark, sf_dir):
    """IO6 + IO3 + IO13: crash points written as GeoJSON Features and read back."""
    df = S.severity(spark, sf_dir).select("crash_id", "community_area_number", "weighted_severity", "lon", "lat")
    path = _scratch(spark, "crash_points_geojson")
    write_geojson_lines(df, path)
    props = T.StructType([T.StructField("crash_id", T.LongType()), T.StructField("community_area_number", T.LongType()),
                          T.StructField("weighted_severity", T.DoubleType())])
    return rounded(read_geojson_points(spark, path, props))


@register("load_areas", sql(
    "SELECT CAST(area_num_1 AS BIGINT) AS community_area_number, community AS community_area_name, "
    "'Polygon' AS geom_type FROM areas"))
def load_areas_q(spark, sf_dir):
    """IO4 + PR3/PR4 + SC1: boundary GeoJSON -> renamed, typed area table."""
    from ..operators.spatial import load_community_areas
    from ..sources.fixture import load_areas
    path = _scratch(spark, "areas_geojson")
    polygon_features(load_areas(spark).drop("geom_type")).write.mode("overwrite").text(path)
    props = T.StructType([T.StructField("area_num_1", T.StringType()), T.StructField("community", T.StringType())])
    areas = load_community_areas(read_geojson_polygons(spark, path, props, multiline=False))
    return areas.select("community_area_number", "community_area_name", "geom_type")


@register("csv_roundtrip", sql(
    "SELECT crash_id, LATITUDE, WEATHER_CONDITION, INJURIES_REPORTED_NOT_EVIDENT, CRASH_TYPE FROM crashes"))
def csv_roundtrip(spark, sf_dir):
    """IO1/IO2/IO5: crash extract written as CSV with header and read back with the explicit schema."""
    from pyspark.sql import functions as F
    from ..schemas import CRASHES_RAW
    from ..sources.geojson import read_crashes_csv, write_csv
    path = _scratch(spark, "crashes_csv")
    raw = S.raw(spark, sf_dir).withColumnRenamed("crash_id", "CRASH_ID_NUM")
    write_csv(raw.select("CRASH_ID_NUM", *[f.name for f in CRASHES_RAW.fields]), path)
    schema = T.StructType([T.StructField("CRASH_ID_NUM", T.LongType()), *CRASHES_RAW.fields])
    back = read_crashes_csv(spark, path, schema)
    return back.select(F.col("CRASH_ID_NUM").alias("crash_id"), "LATITUDE", "WEATHER_CONDITION",
                       "INJURIES_REPORTED_NOT_EVIDENT", "CRASH_TYPE")
