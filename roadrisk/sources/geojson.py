"""GeoJSON and CSV sources/sinks.

GeoJSON is written and read as newline-delimited Features (one Feature per
line), which splits across tasks; a single FeatureCollection document is
also readable (``multiLine``) for small boundary files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CRASHES_RAW


def read_crashes_csv(spark: SparkSession, path: str, schema: T.StructType = CRASHES_RAW) -> DataFrame:
    """Crash extract with header and an explicit schema (no inference on the hot path)."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def point_features(df: DataFrame, x: str = "lon", y: str = "lat") -> DataFrame:
    """One GeoJSON Feature (JSON text) per row: Point geometry + all other columns as properties."""
    props = [c for c in df.columns if c not in (x, y)]
    feat = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array(F.col(x), F.col(y)).alias("coordinates")).alias("geometry"),
        F.struct(*[F.col(c) for c in props]).alias("properties"),
    )
    return df.select(F.to_json(feat).alias("value"))


def polygon_features(df: DataFrame, rings: str = "rings", parts: str = "parts") -> DataFrame:
    """One Feature per area. ``parts``, where the table has it, is the number of rings of each part; an
    area of several parts is written as a MultiPolygon."""
    props = [c for c in df.columns if c not in (rings, parts)]
    coords = F.transform(F.col(rings), lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    one = F.concat(F.lit('{"type":"Polygon","coordinates":'), F.to_json(coords), F.lit("}"))
    geometry = one
    if parts in df.columns:
        n = F.col(parts)
        begin = lambda k: F.aggregate(F.slice(n, 1, k), F.lit(0), lambda a, v: a + v) + 1
        many = F.transform(n, lambda size, k: F.slice(coords, begin(k), size))
        many = F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), F.to_json(many), F.lit("}"))
        geometry = F.when(F.size(n) > 1, many).otherwise(one)
    return df.select(F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce(geometry, F.lit("null")),
                              F.lit(',"properties":'), F.to_json(F.struct(*[F.col(c) for c in props])), F.lit("}")).alias("value"))


def write_geojson_lines(df: DataFrame, path: str, x: str = "lon", y: str = "lat") -> None:
    point_features(df, x, y).write.mode("overwrite").text(path)


def read_geojson_points(spark: SparkSession, path: str, properties: T.StructType, x: str = "lon",
                        y: str = "lat", multiline: bool = False) -> DataFrame:
    """Read Point Features (newline-delimited, or one FeatureCollection with ``multiline``)."""
    geom = T.StructType([T.StructField("type", T.StringType()),
                         T.StructField("coordinates", T.ArrayType(T.DoubleType()))])
    feat = T.StructType([T.StructField("type", T.StringType()), T.StructField("geometry", geom),
                         T.StructField("properties", properties)])
    if multiline:
        coll = T.StructType([T.StructField("type", T.StringType()), T.StructField("features", T.ArrayType(feat))])
        df = spark.read.schema(coll).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    else:
        df = spark.read.schema(feat).json(path).select(F.struct("*").alias("f"))
    return df.select(F.col("f.geometry.coordinates")[0].alias(x), F.col("f.geometry.coordinates")[1].alias(y),
                     "f.properties.*")


def read_geojson_polygons(spark: SparkSession, path: str, properties: T.StructType, multiline: bool = True) -> DataFrame:
    """Boundary file: Polygon and MultiPolygon Features -> rings, parts, geom_type and the properties.

    ``rings`` holds the rings of all parts one after the other, ``parts`` the number of rings of each.
    A Feature without a geometry has nulls; any other geometry type is an error.
    """
    geom = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    feat = T.StructType([T.StructField("type", T.StringType()), T.StructField("geometry", geom),
                         T.StructField("properties", properties)])
    if multiline:
        coll = T.StructType([T.StructField("type", T.StringType()), T.StructField("features", T.ArrayType(feat))])
        df = spark.read.schema(coll).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    else:
        df = spark.read.schema(feat).json(path).select(F.struct("*").alias("f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    ring = "array<array<array<double>>>"
    parts = F.when(kind == "Polygon", F.array(F.from_json(text, ring))).when(kind == "MultiPolygon", F.from_json(text, f"array<{ring}>")).when(
        kind.isNotNull(), F.raise_error(F.concat(F.lit("Not an area: "), kind)).cast(f"array<{ring}>"))
    df = df.withColumn("_parts", parts)
    rings = F.transform(F.flatten("_parts"), lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return df.select(rings.alias("rings"), F.transform("_parts", lambda p: F.size(p)).alias("parts"), kind.alias("geom_type"), "f.properties.*")
