"""Split/fold invariants, exact sample size, evaluation tables and the attribution-share golden."""

import numpy as np
from pyspark.sql import functions as F

from roadrisk.operators import evaluate as EV
from roadrisk.operators.explain import attribution_share
from roadrisk.operators.ml import median_impute, standardize
from roadrisk.operators.sampling import exact_sample, stratified_folds, stratified_split


def _labelled(spark, n=1003):
    return spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 4 == 0, "A").otherwise("B").alias("y"))


def test_split_and_folds(spark):
    df = _labelled(spark)
    s = stratified_split(df, "y", "k").groupBy("y").agg(F.count_if("is_test").alias("t"), F.count(F.lit(1)).alias("n"))
    for r in s.collect():
        assert r["t"] == round(r["n"] * 0.2)
    f = stratified_folds(df, "y", "k")
    assert f.count() == 1003 and f.select("k").distinct().count() == 1003
    sizes = {(r["y"], r["fold"]): r["c"] for r in f.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("c")).collect()}
    for y in ("A", "B"):
        vals = [sizes[(y, k)] for k in range(5)]
        assert max(vals) - min(vals) <= 1


def test_exact_sample(spark):
    df = _labelled(spark)
    assert exact_sample(df, 100, "k").count() == 100
    assert exact_sample(df, 5000, "k").count() == 1003
    a = [r[0] for r in exact_sample(df, 50, "k").select("k").collect()]
    b = [r[0] for r in exact_sample(df.repartition(7), 50, "k").select("k").collect()]
    assert sorted(a) == sorted(b)


def test_impute_median_and_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    got = sorted(r[0] for r in median_impute(df, ["x"]).collect())
    assert got == [1.0, 2.0, 3.0, 4.0, 10.0]
    z = [r[0] for r in standardize(spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double"), ["x"]).collect()]
    assert abs(sum(v * v for v in z) / 3 - 1.0) < 1e-12
    c = [r[0] for r in standardize(spark.createDataFrame([(5.0,), (5.0,)], "x double"), ["x"]).collect()]
    assert c == [0.0, 0.0]


def test_confusion_and_metrics(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 5 + [(1, 1)] * 8 + [(1, 0)] * 2 + [(2, 0)] * 1
    pred = spark.createDataFrame(rows, "label int, prediction int")
    cm = {(r["label"], r["prediction"]): r["n"] for r in EV.confusion(pred).collect()}
    assert cm[(2, 2)] == 0 and cm[(0, 0)] == 5 and len(cm) == 9
    m = EV.classification_metrics(pred).first()
    assert abs(m["balanced_accuracy"] - (0.5 + 0.8 + 0.0) / 3) < 1e-12
    f1 = [2 * (5 / 8) * 0.5 / (5 / 8 + 0.5), 2 * (8 / 13) * 0.8 / (8 / 13 + 0.8), 0.0]
    assert abs(m["macro_f1"] - sum(f1) / 3) < 1e-12


# ---- fixed values: a published top-20 attribution table (feature, mean |value|, % share) ----
GOLDEN = [
    ("REPORT_TYPE", 1.2477682462558501, 26.93), ("NUM_UNITS", 0.6219629138106519, 13.42),
    ("DAMAGE", 0.5098981317092769, 11.01), ("POSTED_SPEED_LIMIT", 0.38459160925672153, 8.3),
    ("INTERSECTION_RELATED_I", 0.35938140070576124, 7.76), ("FIRST_CRASH_TYPE", 0.2869753857483363, 6.19),
    ("LOCATION_CLUSTER", 0.2786887473590876, 6.02), ("TRAFFICWAY_TYPE", 0.19024385760239323, 4.11),
    ("PRIM_CONTRIBUTORY_CAUSE", 0.14966479191977977, 3.23), ("LIGHTING_CONDITION", 0.11518918046967017, 2.49),
    ("SEC_CONTRIBUTORY_CAUSE", 0.10007123118352894, 2.16), ("CRASH_TIME_OF_DAY", 0.08228560181570262, 1.78),
    ("CRASH_HOUR", 0.06600161593376058, 1.42), ("DEVICE_CONDITION", 0.055939509901074075, 1.21),
    ("WEATHER_CONDITION", 0.03830087871950206, 0.83), ("CRASH_MONTH", 0.03492114611524509, 0.75),
    ("TRAFFIC_CONTROL_DEVICE", 0.03358368021485343, 0.72), ("ROADWAY_SURFACE_COND", 0.031466439660410774, 0.68),
    ("CRASH_DAY_OF_WEEK", 0.024864574469895505, 0.54), ("ROAD_DEFECT", 0.02133887280875409, 0.46),
]


def test_attribution_share_golden(spark):
    imp = spark.createDataFrame([(f, v) for f, v, _ in GOLDEN] + [("EXTRA", 0.001)], "feature string, mean_abs_shap double")
    got = {r["feature"]: r for r in attribution_share(imp).collect()}
    assert len(got) == 20 and "EXTRA" not in got
    for f, _, pct in GOLDEN:
        assert got[f]["percent_contribution"] == pct, f
    assert got["ROAD_DEFECT"]["preventive_measure"].startswith("Promptly repair")
    assert got["DAMAGE"]["preventive_measure"].startswith("Investigate")


def test_ingest_runs_its_input_once(spark, tmp_path):
    """The number of files comes from the source's size: no shuffle of the built table runs before the write does."""
    from roadrisk.sources.fixture import ingest

    spark.range(10).write.parquet(f"{tmp_path}/src.parquet")
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    got = ingest(spark, f"{tmp_path}/src.parquet", "once", lambda: spark.range(1000).mapInArrow(counted, "id long").groupBy("id").count())
    assert got.count() == 1000 and rows.value == 1000


def test_fold_statistics_are_made_once(spark, monkeypatch):
    """A fold's medians serve its training rows and the rows held out."""
    from roadrisk.operators import selection

    df = spark.createDataFrame([(i, "ab"[i % 2], float(i % 7) if i % 5 else None, i % 3) for i in range(60)], "id long, y string, x double, fold int")
    t, asked, plain = selection.Training(df, "id", "y", ["x"], 3), [], selection.medians
    monkeypatch.setattr(selection, "medians", lambda *a: asked.append(1) or plain(*a))
    train, test = t.scaled(1)
    assert len(asked) == 1 and train.count() == 40 and test.count() == 20
    v = np.asarray([r["x"] for r in train.collect()])
    assert abs(v.mean()) < 1e-9 and abs(v.std() - 1) < 1e-9 and test.filter("x is null").count() == 0


def test_ingest_of_a_large_source_shuffles_no_built_rows(spark, tmp_path, monkeypatch):
    """A table of a source above FILE_BYTES is written in the partitions it has; the crash table deals out its source's few columns."""
    import datetime
    import glob

    from roadrisk.session import ensure_checkpoint_dir
    from roadrisk.sources import fixture

    monkeypatch.setattr(fixture, "FILE_BYTES", 256)
    spark.range(100).selectExpr("id AS o_orderkey", "id AS o_custkey").withColumn("o_orderdate", F.lit(datetime.datetime(2024, 3, 1))).write.parquet(f"{tmp_path}/orders.parquet")
    got = fixture.ingest(spark, f"{tmp_path}/orders.parquet", "wide", lambda: spark.range(0, 1000, 1, 3))
    assert got.count() == 1000 and len(got.inputFiles()) == 3
    dealt = []
    monkeypatch.setattr(fixture, "crashes_from_orders", lambda orders, plain=fixture.crashes_from_orders: dealt.append(orders) or plain(orders))
    crashes = fixture.load_crashes(spark, str(tmp_path))
    assert crashes.count() == 100 and crashes.columns == fixture.crashes_from_orders(dealt[0]).columns
    assert dealt[0].columns == ["o_orderkey", "o_custkey", "o_orderdate"] and dealt[0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert glob.glob(f"{ensure_checkpoint_dir(spark)}".removeprefix("file:") + "/ingest/wide-*")
