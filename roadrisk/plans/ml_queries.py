"""Registered queries: feature statistics, models, evaluation, attribution, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import ml as ML
from ..operators.explain import attribution_share, linear_contributions, linear_importance
from ..operators.profile import group_ranges
from ..schemas import FEATURE_COLUMNS, TARGET
from . import stages as S
from .feature_queries import fsql
from .registry import register, rounded


@register("impute_median", fsql(
    "SELECT " + ", ".join(f"round(quantile_cont({c}, 0.5), 9) AS med_{c}" for c in FEATURE_COLUMNS) + " FROM features"))
def impute_median(spark, sf_dir):
    """ML3: exact medians used to fill nulls (linear interpolation)."""
    from ..operators.profile import medians
    return rounded(medians(S.features(spark, sf_dir), FEATURE_COLUMNS, "med_"))


@register("impute_fill", fsql(
    "SELECT crash_id, " + ", ".join(f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM features)), 9) AS {c}" for c in FEATURE_COLUMNS)
    + " FROM features"))
def impute_fill(spark, sf_dir):
    """ML3: nulls filled with the exact medians, all features."""
    f = S.features(spark, sf_dir).select("crash_id", *FEATURE_COLUMNS)
    return rounded(ML.median_impute(f, FEATURE_COLUMNS))


@register("standardize", fsql(
    "SELECT crash_id, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END, 9) AS {c}"
        for c in FEATURE_COLUMNS) + " FROM features"))
def standardize(spark, sf_dir):
    """ML4: (x - mean) / population std (zero std -> 1)."""
    f = S.features(spark, sf_dir).select("crash_id", *FEATURE_COLUMNS)
    return rounded(ML.standardize(f, FEATURE_COLUMNS))


@register("class_weights", fsql(
    "SELECT CRASH_TYPE, count(*) AS n_class, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 9) AS weight "
    "FROM features GROUP BY CRASH_TYPE"))
def class_weights(spark, sf_dir):
    """ML6: balanced class weights n / (k * n_class)."""
    return rounded(ML.class_weights(S.features(spark, sf_dir), TARGET))


def _split(spark, sf_dir):
    s = S.split(spark, sf_dir)
    return s.filter(~F.col("is_test")), s.filter(F.col("is_test"))


def _logreg(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return ML.fit_predict(train, test, FEATURE_COLUMNS, TARGET, "LogisticRegression")


@register("train_logreg")
def train_logreg(spark, sf_dir):
    """ML5/ML8: balanced logistic regression on imputed, standardised features -> coefficients."""
    _, fitted, _ = _logreg(spark, sf_dir)
    coefs = fitted.coefficients.toArray().tolist()
    rows = [(f, float(c)) for f, c in zip(FEATURE_COLUMNS, coefs)] + [("(intercept)", float(fitted.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


@register("logreg_metrics")
def logreg_metrics(spark, sf_dir):
    """ML14-ML16: test-set accuracy, balanced accuracy, macro and weighted F1 of the logistic regression."""
    pred, _, _ = _logreg(spark, sf_dir)
    return EV.classification_metrics(pred, "label", "prediction")


@register("logreg_confusion")
def logreg_confusion(spark, sf_dir):
    """ML18: the logistic regression's confusion counts on the class spine."""
    pred, _, _ = _logreg(spark, sf_dir)
    return EV.confusion(pred, "label", "prediction")


@register("logreg_report")
def logreg_report(spark, sf_dir):
    """ML17: the logistic regression's per-class precision / recall / F1 / support with macro and weighted averages."""
    pred, _, _ = _logreg(spark, sf_dir)
    return EV.classification_report(pred, "label", "prediction")


@register("feature_importance")
def feature_importance(spark, sf_dir):
    """ML19/WI6: top-20 tree feature importances (gradient-boosted trees)."""
    train, test = _split(spark, sf_dir)
    _, fitted, _ = ML.fit_predict(train, test, FEATURE_COLUMNS, TARGET, "GBT", iters=10)
    return spark.createDataFrame(ML.feature_importance(fitted, FEATURE_COLUMNS), "feature string, importance double")


@register("score_batch")
def score_batch(spark, sf_dir):
    """AP2/ML14/SC18: batch scoring with predicted label, confidence and probability columns."""
    pred, _, indexer = _logreg(spark, sf_dir)
    out = ML.score_batch(pred, indexer)
    return out.select("crash_id", "predicted_label", "confidence", "is_injury", "prob")


@register("attribution_global")
def attribution_global(spark, sf_dir):
    """EX1/EX2/EX3/AG19/WI7: exact linear attributions -> top-20 mean |value| with % share and measures."""
    pred, fitted, _ = _logreg(spark, sf_dir)
    return attribution_share(linear_importance(pred, fitted.coefficients.toArray().tolist(), FEATURE_COLUMNS))


@register("attribution_local")
def attribution_local(spark, sf_dir):
    """EX4: per-feature attributions to the predicted class of the example rows (positions 10/100/250 of the test set)."""
    from ..operators.sampling import example_rows
    pred, fitted, _ = _logreg(spark, sf_dir)
    ex = example_rows(pred.select("crash_id", "prediction"), "crash_id")  # three rows at most
    rows = pred.join(F.broadcast(ex.select("crash_id")), "crash_id")
    contrib = linear_contributions(pred, fitted.coefficients.toArray().tolist(), FEATURE_COLUMNS, "crash_id", rows=rows)
    # contributions are to class 1's log odds; for a row predicted as class 0 they count the other way
    toward = F.when(F.col("prediction") == 1, F.col("value")).otherwise(-F.col("value"))
    return contrib.join(F.broadcast(ex), "crash_id").withColumn("value", toward)


@register("location_cluster")
def location_cluster(spark, sf_dir):
    """SP7: KMeans (k=20, seed 42) location cluster after dropping (0,0) points."""
    from ..operators.clean import drop_zero_points
    df, _ = ML.location_cluster(drop_zero_points(S.raw(spark, sf_dir)))
    return df.select("crash_id", "LOCATION_CLUSTER")


@register("location_cluster_profile")
def location_cluster_profile(spark, sf_dir):
    """AG4/AG5/JO1: per location cluster bounding ranges and centre (one aggregate)."""
    from ..operators.clean import drop_zero_points
    df, _ = ML.location_cluster(drop_zero_points(S.raw(spark, sf_dir)))
    return group_ranges(df, "LOCATION_CLUSTER")


def _metrics_for(spark, sf_dir, model: str, **kw):
    train, test = _split(spark, sf_dir)
    pred, _, _ = ML.fit_predict(train, test, FEATURE_COLUMNS, TARGET, model, **kw)
    return EV.classification_metrics(pred, "label", "prediction").withColumn("model", F.lit(model))


@register("train_forest")
def train_forest(spark, sf_dir):
    """ML9: random forest without bootstrap, balanced weights (extra-trees stand-in) -> test metrics."""
    return _metrics_for(spark, sf_dir, "RandomForest", trees=20)


@register("train_gbt")
def train_gbt(spark, sf_dir):
    """ML10/ML11: gradient-boosted trees (depth 6, step 0.05, 0.8 row/feature sampling) -> test metrics."""
    return _metrics_for(spark, sf_dir, "GBT", iters=10)


@register("probability_table")
def probability_table(spark, sf_dir):
    """SC18: per scored row, one row per outcome with its probability in percent."""
    pred, _, indexer = _logreg(spark, sf_dir)
    labels = F.array(*[F.lit(v) for v in indexer.labels])
    ex = pred.select("crash_id", F.posexplode("prob").alias("pos", "p"))
    return ex.select("crash_id", F.element_at(labels, F.col("pos") + 1).alias("outcome"),
                     (F.col("p") * 100).alias("probability"))


@register("prepare_data", fsql(
    "SELECT split, CRASH_TYPE, count(*) AS n FROM (SELECT CRASH_TYPE, CASE WHEN rn <= round(nc * 0.2) THEN 'test' "
    "ELSE 'train' END AS split FROM (SELECT CRASH_TYPE, row_number() OVER (PARTITION BY CRASH_TYPE ORDER BY "
    "md5(concat_ws('-', '42', CAST(crash_id AS VARCHAR))), crash_id) AS rn, count(*) OVER (PARTITION BY CRASH_TYPE) AS nc "
    "FROM features)) GROUP BY split, CRASH_TYPE"))
def prepare_data_q(spark, sf_dir):
    """ML20 + IO9-IO11: exact stratified split written as train/test Parquet + feature names; counts read back."""
    import uuid
    from ..session import ensure_checkpoint_dir
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/prepared/{uuid.uuid4().hex[:12]}"
    paths = ML.prepare_data(S.features(spark, sf_dir), out, TARGET, "crash_id")
    tr = spark.read.parquet(paths["train"]).withColumn("split", F.lit("train"))
    te = spark.read.parquet(paths["test"]).withColumn("split", F.lit("test"))
    return tr.unionByName(te).groupBy("split", "CRASH_TYPE").agg(F.count(F.lit(1)).alias("n"))


@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """IO12 + AP2: persist imputer, scaler, assembler, model and label names as one pipeline; load it and score raw rows."""
    import uuid
    from pyspark.ml import PipelineModel
    from ..session import ensure_checkpoint_dir
    train, test = _split(spark, sf_dir)
    fitted = ML.fit_pipeline(train, FEATURE_COLUMNS, TARGET)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex[:12]}"
    fitted.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return loaded.transform(test.drop(TARGET)).select("crash_id", "prediction", "predicted_label")


@register("metrics_json")
def metrics_json(spark, sf_dir):
    """IO8: metrics written as JSON and read back with defaults for missing fields/files."""
    import uuid
    from ..session import ensure_checkpoint_dir
    m = logreg_metrics(spark, sf_dir).first()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/metrics/{uuid.uuid4().hex[:12]}"
    ML.write_metrics(spark, {"best_model": "LogisticRegression", "test_balanced_accuracy": float(m["balanced_accuracy"]),
                             "test_macro_f1": float(m["macro_f1"])},
                     path)
    return ML.read_metrics(spark, path).unionByName(ML.read_metrics(spark, path + "-missing"))
