"""Literal pairs for fixed values, areas of several parts, quantiles and row numbers of any layout."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.functions.labels import preventive_measure, risk_factors
from roadrisk.functions.recode import recode_causes
from roadrisk.operators.profile import medians, percentiles
from roadrisk.operators.sampling import example_rows, row_number_distributed
from roadrisk.operators.spatial import load_community_areas, spatial_join
from roadrisk.sources.geojson import polygon_features, read_geojson_polygons


def test_risk_factor_texts(spark):
    row = spark.createDataFrame([(45, "SNOW", "DARKNESS", "DRY", "x", 3, 23)],
                                "POSTED_SPEED_LIMIT int, WEATHER_CONDITION string, LIGHTING_CONDITION string, ROADWAY_SURFACE_COND string, "
                                "PRIM_CONTRIBUTORY_CAUSE string, NUM_UNITS int, CRASH_HOUR int")
    found = row.select(risk_factors().alias("f")).first()["f"]
    assert found == ["High speed zone (≥40 mph)", "Adverse weather: SNOW", "Low visibility (darkness)", "Multiple vehicles (3)", "Late night hours"]


def test_unknown_feature_gets_the_default_measure(spark):
    got = spark.createDataFrame([("NO SUCH FEATURE",), ("ANOTHER",)], "f string").select(preventive_measure("f").alias("m")).distinct().collect()
    assert len(got) == 1 and got[0]["m"]


def test_cause_groups_leave_other_values(spark):
    df = spark.createDataFrame([("no such cause", None)], "PRIM_CONTRIBUTORY_CAUSE string, SEC_CONTRIBUTORY_CAUSE string")
    assert recode_causes(df).first()["PRIM_CONTRIBUTORY_CAUSE"] == "no such cause"


SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]
FAR = [[10, 10], [12, 10], [12, 12], [10, 12], [10, 10]]


def _collection(*geometries):
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": g, "properties": {"area_numbe": str(i), "community": f"c{i}"}} for i, g in enumerate(geometries)]})


PROPS = T.StructType([T.StructField("area_numbe", T.StringType()), T.StructField("community", T.StringType())])


def test_areas_of_several_parts(spark, tmp_path):
    (tmp_path / "a.json").write_text(_collection(
        {"type": "Polygon", "coordinates": [FAR]}, {"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE], [[[20, 0], [22, 0], [22, 2], [20, 2], [20, 0]]]]}, None))
    raw = read_geojson_polygons(spark, str(tmp_path / "a.json"), PROPS)
    assert [(r["geom_type"], r["parts"]) for r in raw.orderBy("area_numbe").collect()] == [("Polygon", [1]), ("MultiPolygon", [2, 1]), (None, None)]
    areas = load_community_areas(raw)
    pts = spark.createDataFrame([(1, 3.0, 3.0), (2, 1.5, 1.5), (3, 21.0, 1.0), (4, 11.0, 11.0), (5, 15.0, 5.0), (6, 4.0, 2.0)], "id int, lon double, lat double")
    found = {r["id"]: r["community_area_number"] for r in spatial_join(pts, areas).collect()}
    assert found == {1: 1, 2: None, 3: 1, 4: 0, 5: None, 6: None}
    polygon_features(raw.drop("geom_type")).write.text(str(tmp_path / "out"))
    back = read_geojson_polygons(spark, str(tmp_path / "out"), PROPS, multiline=False)
    key = lambda df: sorted((r["area_numbe"], r["geom_type"], str(r["rings"]), r["parts"]) for r in df.collect())
    assert [k[:3] for k in key(back.fillna("", ["geom_type"]))] == [k[:3] for k in key(raw.fillna("", ["geom_type"]))]


def test_other_geometries_are_an_error(spark, tmp_path):
    (tmp_path / "b.json").write_text(_collection({"type": "LineString", "coordinates": [[0, 0], [1, 1]]}))
    with pytest.raises(Exception, match="Not an area: LineString"):
        read_geojson_polygons(spark, str(tmp_path / "b.json"), PROPS).collect()


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_quantiles_of_skewed_values(spark, partitions):
    rng = np.random.default_rng(partitions)
    x = np.concatenate((np.zeros(4000), rng.normal(0, 5, 3000).round(1), rng.uniform(-1e6, 1e6, 2001)))
    df = spark.createDataFrame([(float(v), None if i % 3 else float(i)) for i, v in enumerate(x)], "x double, y double").repartition(partitions)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = percentiles(df, "x", [0.0, 0.1, 0.5, 0.77, 1.0]).first()
        assert np.allclose(list(got), np.quantile(x, [0.0, 0.1, 0.5, 0.77, 1.0]))
        m = medians(df, ["x", "y"]).first()
        assert m["_med_x"] == pytest.approx(np.median(x)) and m["_med_y"] == pytest.approx(np.median(np.arange(0, len(x), 3)))
        assert list(percentiles(df.limit(0), "x", [0.5]).first()) == [None]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_row_numbers_of_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 8, F.lit("hot")).when(F.col("id") % 10 == 8, F.lit(None)).otherwise(F.lit("b")).alias("g"), F.pmod(F.xxhash64("id"), F.lit(100000)).alias("h"), "id")
    rows = row_number_distributed(df, ["g"], [F.col("h"), F.col("id")]).collect()
    for g in ("hot", None, "b"):
        mine = sorted((r["h"], r["id"], r["rn"]) for r in rows if r["g"] == g)
        assert [r[2] for r in mine] == list(range(1, len(mine) + 1))


def test_example_rows_fall_back_to_the_first(spark):
    assert [r["position"] for r in example_rows(spark.range(5).withColumnRenamed("id", "k"), "k").collect()] == [0]
    assert sorted(r["position"] for r in example_rows(spark.range(120).withColumnRenamed("id", "k"), "k").collect()) == [10, 100]
    assert example_rows(spark.range(0).withColumnRenamed("id", "k"), "k").count() == 0
