"""Coordinate systems, published sets, dashboard years, table profiles, neighbour counts and the lon/lat order."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadrisk.functions import crs
from roadrisk.functions import labels as L
from roadrisk.operators import artefacts
from roadrisk.operators import dashboard as D
from roadrisk.operators.dbscan import dbscan, eps_neighbours
from roadrisk.operators.profile import shape, table_profile

POINTS = [(-87.6298, 41.8781), (-87.0, 0.0), (-87.0, 45.0), (-90.0, 84.0), (-84.1, -79.9), (-87.0, 1e-7)]


def points(spark, rows=POINTS):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], "id long, lon double, lat double")


@pytest.mark.parametrize("srid", [3857, 32616, 32716])
def test_there_and_back(spark, srid):
    df = crs.with_srid(points(spark), 4326)
    back = crs.reproject(crs.reproject(df, srid), 4326)
    assert crs.srid_of(back) == 4326
    for r in back.collect():
        assert abs(r["lon"] - POINTS[r["id"]][0]) < 1e-9 and abs(r["lat"] - POINTS[r["id"]][1]) < 1e-9


def test_known_places(spark):
    got = {r["id"]: (r["lon"], r["lat"]) for r in crs.reproject(crs.with_srid(points(spark), 4326), 32616).collect()}
    assert got[1] == pytest.approx((500000.0, 0.0), abs=1e-6)
    assert got[2] == pytest.approx((500000.0, 0.9996 * 4984944.378), abs=2e-3)  # the meridian's length from the equator to 45 degrees
    got = {r["id"]: (r["lon"], r["lat"]) for r in crs.reproject(crs.with_srid(points(spark), 4326), 3857).collect()}
    assert got[2][0] == pytest.approx(-87 * math.pi / 180 * 6378137) and got[2][1] == pytest.approx(5621521.486192, abs=1e-5)


def test_srid_is_checked(spark, tmp_path):
    df = points(spark)
    with pytest.raises(crs.CrsError):
        crs.srid_of(df)
    with pytest.raises(crs.CrsError):
        crs.with_srid(df, 12345)
    good = crs.with_srid(df, 4326)
    with pytest.raises(crs.CrsError):
        crs.with_srid(good, 3857)
    mixed = good.withMetadata("lat", {"srid": 3857})
    with pytest.raises(crs.CrsError):
        crs.srid_of(mixed)
    with pytest.raises(crs.CrsError):
        crs.require_srid(4326, good, crs.reproject(good, 3857))
    good.write.parquet(str(tmp_path / "points"))
    assert crs.srid_of(spark.read.parquet(str(tmp_path / "points")).filter("id > 1").select("lat", "lon")) == 4326  # it travels with the table
    assert crs.require_rows(good, "points") is good
    with pytest.raises(ValueError, match="points is empty"):
        crs.require_rows(good.limit(0), "points")
    none = crs.reproject(crs.with_srid(points(spark, [(None, 1.0)]), 4326), 3857).first()
    assert none["lon"] is None and none["lat"] is not None


def test_published_set(spark, tmp_path):
    folder = str(tmp_path / "sets")
    with pytest.raises(artefacts.IncompleteSet):
        artefacts.load(spark, folder)
    first = artefacts.publish(spark, folder, {"t": ("parquet", spark.range(5)), "r": ("json", points(spark)), "names": ("text", ["b", "a", "c"])})
    second = artefacts.publish(spark, folder, {"t": ("parquet", spark.range(7))})
    assert artefacts.versions(spark, folder) == [first, second]
    assert artefacts.load(spark, folder)["t"].count() == 7
    old = artefacts.load(spark, folder, first)
    assert old["names"] == ["b", "a", "c"] and sorted(map(tuple, old["r"].collect())) == sorted((i, *p) for i, p in enumerate(POINTS))
    spark.range(1).write.mode("append").parquet(f"{folder}/{second}/t")
    with pytest.raises(artefacts.IncompleteSet, match="8 rows, the manifest says 7"):
        artefacts.load(spark, folder)
    spark.range(3).write.parquet(f"{folder}/{'9' * 20}-half/t")  # no manifest: not a version
    assert artefacts.versions(spark, folder) == [first, second]
    with pytest.raises(ValueError):
        artefacts.publish(spark, folder, {"t": ("xlsx", spark.range(1))})


def crashes(spark, years):
    rows = [(i, y, 1.0, 2.0, i % 2, 0, 0, 1, 1, 3, 4, 5, "CLEAR", "DAYLIGHT", "DRY", "ANGLE", float(i)) for i, y in enumerate(years)]
    return spark.createDataFrame(rows, "crash_id long, crash_year int, lon double, lat double, fatal long, serious long, moderate long, minor long, none long, crash_month int, crash_day_of_week int, "
                                       "crash_hour int, WEATHER_CONDITION string, LIGHTING_CONDITION string, ROADWAY_SURFACE_COND string, FIRST_CRASH_TYPE string, mean_weighted_severity double")


def test_years_of_a_request(spark):
    ids = lambda df, years: sorted(r[0] for r in D.apply_filters(df, D.CrashFilter(years=years)).select("crash_id").collect())
    df = crashes(spark, [2021, 2022, 2022, 2023])
    assert ids(df, [2022]) == [1, 2] and ids(df, [2021, 2022, 2023]) == [0, 1, 2, 3] and ids(df, [2020]) == [] and ids(df, []) == [0, 1, 2, 3]
    some = crashes(spark, [2021, None, 2022])
    assert ids(some, [2021, 2022]) == [0, 2] and ids(some, []) == [0, 1, 2]


def test_request_layers(spark):
    df = crashes(spark, [2021, 2022, 2022, 2023])
    out = D.dashboard(df, D.CrashFilter(years=[2022], surface=["DRY", "WET"]), layers=("statistics", "points"))
    row = out["statistics"].first()
    assert out.keys() == {"statistics", "points"} and (row["filtered_count"], row["total_count"], row["fatal_filtered"], row["fatal_total"]) == (2, 4, 1, 2)
    assert row["mean_risk_filtered"] == 1.5 and row["mean_risk_total"] == 1.5  # the scores' means, not the injuries'
    assert sorted(r["crash_id"] for r in out["points"].collect()) == [1, 2]
    assert D.dashboard(df, D.reset(), layers=("statistics",))["statistics"].first()["percentage"] == 100
    clusters = spark.createDataFrame([(0, 1.0, 2.0), (1, 3.0, 4.0)], "cluster_id long, centroid_lon double, centroid_lat double")
    risk = spark.createDataFrame([(0, 16, 0.5)], "cluster_id long, total_crashes long, weighted_score double")
    layer = {r["cluster_id"]: r["marker_size"] for r in D.dashboard(df, D.CrashFilter(), clusters=clusters, cluster_risk=risk, layers=("clusters",))["clusters"].collect()}
    assert layer == {0: 8.0, 1: None}


def test_table_profile(spark):
    df = spark.createDataFrame([(1, "b", None, {"k": 1}), (5, None, 2.5, None), (5, "a", -1.0, {})], "n int, s string, x double, m map<string,int>")
    got = {r["column"]: r for r in table_profile(df, 2).collect()}
    assert [(got[c]["type"], got[c]["n_rows"], got[c]["n_null"]) for c in "nsxm"] == [("int", 3, 0), ("string", 3, 1), ("double", 3, 1), ("map<string,int>", 3, 1)]
    assert (got["n"]["least"], got["n"]["greatest"], got["n"]["distinct_estimate"]) == ("1", "5", 2) and got["m"]["least"] is None
    assert [len(got[c]["head"]) for c in "nsxm"] == [2] * 4 and got["s"]["position"] == 1
    assert tuple(shape(df).first()) == (3, 4) and table_profile(df.limit(0)).first()["n_rows"] == 0


def haversine(a, b):
    la, lo, lb, lp = map(math.radians, (a[1], a[0], b[1], b[0]))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371000.0 * math.asin(min(1, math.sqrt(h)))


def test_neighbour_counts(spark):
    rng = np.random.default_rng(2)
    spots = [(-87.6, 41.8, 0.0004, 150), (-87.6035, 41.8, 0.002, 80), (179.9995, -16.5, 0.002, 40), (-179.9995, -16.5, 0.002, 40), (10.0, 89.999, 2.0, 30)]
    rows = [((x + rng.normal() * s + 180) % 360 - 180, min(90.0, y + rng.normal() * min(s, 0.001)), k % 3 if k % 7 else None) for x, y, s, n in spots for k in range(n)]
    rows += rows[:25]  # equal coordinates
    df = spark.createDataFrame([(i, *map(float, r[:2]), r[2]) for i, r in enumerate(rows)], "crash_id long, lon double, lat double, community_area_number int")
    got = {r["crash_id"]: r["neighbours"] for r in eps_neighbours(df).collect()}
    assert got == {i: sum(a[2] == b[2] and haversine(a, b) <= 250 for b in rows) for i, a in enumerate(rows)}


def test_lonlat_order_is_the_swapped_table(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(-87.6 + rng.normal() * 0.003), float(41.8 + rng.normal() * 0.003), i % 2) for i in range(250)]
    df = spark.createDataFrame(rows, "crash_id long, lon double, lat double, community_area_number int")
    swapped = df.select("crash_id", F.col("lat").alias("lon"), F.col("lon").alias("lat"), "community_area_number")
    read = lambda d, order: sorted((r["crash_id"], r["cluster_id"]) for r in dbscan(d, axis_order=order).collect())
    assert read(df, "lonlat") == read(swapped, "latlon")
    # the brute force of that order: the first coordinate counts as latitude
    near = {i: [j for j, b in enumerate(rows) if a[3] == b[3] and haversine((a[2], a[1]), (b[2], b[1])) <= 250] for i, a in enumerate(rows)}
    core = {i for i in near if len(near[i]) >= 12}
    labelled = {i for i in near if i in core or any(j in core for j in near[i])}
    assert {i for i, c in read(df, "lonlat") if c >= 0} == labelled


def test_form_lists(spark):
    row = spark.range(1).select(*[L.form_code(F.lit(v), names).alias(f"c{k}") for k, (v, names) in enumerate([("Monday", L.FORM_DAYS), ("Sunday", L.FORM_DAYS), ("July", L.FORM_MONTHS), ("Mon", L.FORM_DAYS)])]).first()
    assert tuple(row) == (1, 7, 7, None)
    codes = spark.createDataFrame([("ON SCENE",), ("AMENDED",), ("else",)], "REPORT_TYPE string").select(L.vocab_encode("REPORT_TYPE").alias("c"))
    assert [r["c"] for r in codes.collect()] == [1, 3, -1]
    names = spark.range(0, 9).select(L.display_name(L.DAMAGE_NAMES, F.col("id").cast("int")).alias("n"))
    assert [r["n"] for r in names.collect()][1] == "$1-500" and [r["n"] for r in names.collect()][7:] == ["Unknown", None]


def test_literal_names(spark):
    """Pairs written out here, not taken from the module's maps."""
    pairs = [
        (L.WEATHER_NAMES, "FREEZING RAIN/DRIZZLE", "Freezing Rain"), (L.WEATHER_NAMES, "SEVERE CROSS WIND GATE", "Severe Wind"), (L.WEATHER_NAMES, "CLOUDY/OVERCAST", "Cloudy"),
        (L.LIGHTING_NAMES, "DARKNESS", "Darkness - No Lights"), (L.LIGHTING_NAMES, "DARKNESS, LIGHTED ROAD", "Darkness - Street Lights"),
        (L.SURFACE_NAMES, "SNOW OR SLUSH", "Snow/Slush"), (L.SURFACE_NAMES, "DRY", "Dry Surface"), (L.CRASH_TYPE_NAMES, "PEDALCYCLIST", "Cyclist"),
        (L.CRASH_TYPE_NAMES, "PARKED MOTOR VEHICLE", "Parked Vehicle"), (L.DAMAGE_NAMES, 6, "$10,001+"),
    ]
    row = spark.range(1).select(*[L.display_name(m, F.lit(k)).alias(f"c{i}") for i, (m, k, _) in enumerate(pairs)]).first()
    assert list(row) == [v for _, _, v in pairs]
    codes = [("WEATHER_CONDITION", "HAIL", 8), ("LIGHTING_CONDITION", "DAWN", 4), ("PRIM_CONTRIBUTORY_CAUSE", "TEXTING", 15), ("SEC_CONTRIBUTORY_CAUSE", "TEXTING", 14), ("TRAFFICWAY_TYPE", "RAMP", 10),
             ("FIRST_CRASH_TYPE", "TRAIN", 17), ("DEVICE_CONDITION", "FUNCTIONING PROPERLY", 2), ("INTERSECTION_RELATED_I", "N", 2), ("ROAD_DEFECT", "DEFECT", 1), ("CRASH_TIME_OF_DAY", "Night", 3)]
    row = spark.range(1).select(*[F.lit(v).alias(c) for c, v, _ in codes]).select(*[L.vocab_encode(c).alias(c) for c, _, _ in codes]).first()
    assert list(row) == [n for _, _, n in codes]


def test_location_clusters_are_nearest(spark):
    from roadrisk.operators.ml import location_cluster
    rng = np.random.default_rng(6)
    xy = rng.normal(size=(400, 2)) + rng.integers(0, 5, (400, 2)) * 10
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "id long, LATITUDE double, LONGITUDE double")
    out, model = location_cluster(df)
    centres = np.stack(model.stages[-1].clusterCenters())
    rows = {r["id"]: r["LOCATION_CLUSTER"] for r in out.collect()}
    d = ((xy[:, None] - centres[None]) ** 2).sum(2)
    assert len(centres) == 20 and len(rows) == 400
    assert all(d[i, c] <= d[i].min() + 1e-9 for i, c in rows.items())
    again, _ = location_cluster(df)
    assert {r["id"]: r["LOCATION_CLUSTER"] for r in again.collect()} == rows
