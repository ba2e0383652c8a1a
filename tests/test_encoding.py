"""Label encoding, list recodes, row numbers and the fitted pipeline: small vocabularies move no rows, results as before."""

import pytest
from pyspark.sql import functions as F

from roadrisk.functions.recode import LIST_RECODES, recode_categories
from roadrisk.operators import features as FT
from roadrisk.operators import ml as ML
from roadrisk.operators.sampling import stratified_split


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def coded(spark):
    rows = [(i, None if i % 7 == 0 else f"v{i % 5}", None, f"many{i}", i % 3) for i in range(300)]
    return spark.createDataFrame(rows, "id long, few string, none string, many string, whole int").repartition(4)


def test_small_vocabularies_are_looked_up_without_a_join(coded):
    out = FT.label_encode(coded, ["few", "none", "whole"])
    assert "Join" not in _plan(out) and out.columns == coded.columns
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == 300
    for i, r in got.items():
        assert r["few"] == (None if i % 7 == 0 else i % 5) and r["none"] is None and r["whole"] == i % 3


def test_large_and_repeated_vocabularies_are_joined(spark, coded):
    many = sorted(f"many{i}" for i in range(300))
    out = FT.label_encode(coded, ["many", "few"])
    assert "Join" in _plan(out) and {r["id"]: r["many"] for r in out.collect()} == {i: many.index(f"many{i}") for i in range(300)}
    given = spark.createDataFrame([("few", "v1", 10), ("few", "v1", 11), ("few", None, 12)], "column string, value string, code int")
    assert sorted(r["few"] or 0 for r in FT.label_encode(coded.filter("id in (1, 2, 7)"), ["few"], given).collect()) == [0, 0, 10, 11]  # a value given twice gives two rows


def test_vocabulary_lays_out_no_rows_times_columns(coded):
    seen = FT.label_vocab(coded, ["few", "none", "many"])
    values = {c: [r["value"] for r in seen.filter(F.col("column") == c).orderBy("code").collect()] for c in ("few", "none", "many")}
    assert values == {"few": [f"v{k}" for k in range(5)], "none": [], "many": sorted(f"many{i}" for i in range(300))}
    assert FT.label_vocab(coded.limit(0), ["few"]).count() == 0


def test_recodes_compose_in_their_order(spark):
    rules = [("a", ["x", "y"], "z"), ("a", ["z", "w"], "y"), ("a", ["q"], "x")]
    out = recode_categories(spark.createDataFrame([(v,) for v in ("x", "y", "z", "w", "q", "other", None)], "a string"), rules)
    assert [r[0] for r in out.collect()] == ["y", "y", "y", "y", "x", "other", None]
    for c in {c for c, _, _ in LIST_RECODES}:  # each column's rules name it once, not once for each rule that follows
        text = _plan(recode_categories(spark.range(1).select(F.col("id").cast("string").alias(c))))
        assert text.count("ELSE") <= 1


def test_split_stores_no_order_key_and_the_fit_reads_narrow_rows(spark, tmp_path):
    df = spark.range(400).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("y"), F.when(F.col("id") % 11 != 0, F.col("id") % 3).alias("x"),
                                 F.lit("wide").alias("text"))
    s = stratified_split(df, "y", "k")
    assert s.columns == ["k", "y", "x", "text", "rn", "is_test"] and "ExistingRDD" not in _plan(s)
    model = ML.fit_pipeline(s.filter("NOT is_test"), ["x"], "y")
    model.write().save(f"{tmp_path}/m")
    from pyspark.ml import PipelineModel
    out = PipelineModel.load(f"{tmp_path}/m").transform(s.drop("y"))
    assert out.count() == 400 and out.filter((F.col("x") == 0) & (F.col("predicted_label") != "A")).count() == 0
