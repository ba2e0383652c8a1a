"""Registered queries: balancing, tree ensembles of this library, attributions and model selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ensemble, evaluate, extra_trees, leafwise, selection
from ..operators import ml as ML
from ..operators.explain import attribution_share, global_importance
from ..operators.lime import lime_local
from ..operators.neighbours import nearest, smote
from ..operators.sampling import example_rows, exact_sample, stratified_folds
from ..operators.tree_shap import shapley
from ..sources.fixture import ingest
from ..schemas import FEATURE_COLUMNS, TARGET
from . import stages as S
from .dashboard_queries import SPLIT_SQL
from .feature_queries import fsql
from .registry import register, rounded

_SCALED = ", ".join(f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN ({c} - avg({c}) OVER ()) ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS {c}" for c in FEATURE_COLUMNS)
_KEEP = ", ".join(FEATURE_COLUMNS)
_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATURE_COLUMNS)
#: Training rows, medians filled in and scaled; ``minor``: rows of the smaller class, numbered in hash order; ``near``: all pairs, the five nearest.
_NEAR_CTE = f"""
, tr AS (SELECT crash_id, CRASH_TYPE, {", ".join(f"coalesce(CAST({c} AS DOUBLE), quantile_cont({c}, 0.5) OVER ()) AS {c}" for c in FEATURE_COLUMNS)} FROM (
    SELECT f.* FROM features f JOIN ({SPLIT_SQL}) s ON s.crash_id = f.crash_id WHERE NOT s.rn <= round(s.nc * 0.2)))
, scaled AS MATERIALIZED (SELECT crash_id, CRASH_TYPE, {_SCALED} FROM tr)
, sizes AS (SELECT CRASH_TYPE, count(*) AS n FROM scaled GROUP BY CRASH_TYPE)
, minor AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY md5('42-' || crash_id), crash_id) AS rn FROM scaled WHERE CRASH_TYPE = (SELECT CRASH_TYPE FROM sizes ORDER BY n LIMIT 1))
, near AS MATERIALIZED (SELECT a.crash_id AS base, b.crash_id AS neighbour, round({_D2}, 6) AS d2 FROM minor a JOIN minor b ON a.crash_id <> b.crash_id
    QUALIFY row_number() OVER (PARTITION BY a.crash_id ORDER BY round({_D2}, 6), b.crash_id) <= 5)
, ranked AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY d2, neighbour) AS rank FROM near)
"""


def _train_scaled(spark, sf_dir):
    """Training rows with medians filled in, scaled by their own statistics."""
    train = S.split(spark, sf_dir).filter(~F.col("is_test")).select("crash_id", TARGET, *FEATURE_COLUMNS)
    return ML.standardize(ML.median_impute(train, FEATURE_COLUMNS), FEATURE_COLUMNS)


@register("minority_neighbours", fsql(_NEAR_CTE + "SELECT base AS crash_id, CAST(rank AS INT) AS rank, neighbour, d2 AS distance2 FROM ranked"))
def minority_neighbours(spark, sf_dir):
    """JO7: the five nearest rows of its class for every training row of the smaller class."""
    from ..operators.dbscan import _checkpoint
    rows = _train_scaled(spark, sf_dir)
    least = rows.groupBy(TARGET).count().orderBy("count").first()[TARGET]
    minor = _checkpoint(rows.filter(F.col(TARGET) == least).select("crash_id", *FEATURE_COLUMNS))
    return nearest(minor, minor, "crash_id", FEATURE_COLUMNS)


_HEX = lambda start: f"CAST('0x' || substr(x, {start}, 8) AS BIGINT)"


@register("smote", fsql(_NEAR_CTE + f"""
, new AS (SELECT t AS synthetic_id, {_HEX(1)} % (SELECT count(*) FROM minor) + 1 AS rn, {_HEX(9)} % 5 + 1 AS rank, {_HEX(17)} / 4294967296.0::DOUBLE AS u
    FROM (SELECT t, md5('42-smote-' || t) AS x FROM (SELECT unnest(range((SELECT max(n) - min(n) FROM sizes))) AS t)))
SELECT crash_id, CRASH_TYPE, {", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_COLUMNS)}, CAST(NULL AS BIGINT) AS synthetic_id, CAST(NULL AS BIGINT) AS base, CAST(NULL AS BIGINT) AS neighbour FROM scaled
UNION ALL
SELECT NULL, a.CRASH_TYPE, {", ".join(f"round(a.{c} + u * (b.{c} - a.{c}), 6)" for c in FEATURE_COLUMNS)}, synthetic_id, a.crash_id, b.crash_id
FROM new JOIN minor a USING (rn) JOIN ranked r ON r.base = a.crash_id AND r.rank = new.rank JOIN minor b ON b.crash_id = r.neighbour"""))
def smote_q(spark, sf_dir):
    """ML7/SE3: training rows and synthetic rows of the smaller class, up to parity."""
    from ..operators.dbscan import _checkpoint
    return rounded(smote(_checkpoint(_train_scaled(spark, sf_dir)), TARGET, "crash_id", FEATURE_COLUMNS), 6)


#: Sizes of the registered fits; the operators' defaults are the original's (400 trees, 500 rounds). README: what this changes.
TREES, ROUNDS, DEPTHWISE_ROUNDS, CV_TREES, CV_ROUNDS, MAX_DEPTH = 400, 500, 20, 400, 500, 10


def _training(spark, sf_dir, trees: int = TREES, rounds: int = ROUNDS) -> selection.Training:
    """Training rows in five stratified folds, stored."""
    rows = ingest(spark, f"{sf_dir}/orders.parquet", "folds", lambda: stratified_folds(
        S.split(spark, sf_dir).filter(~F.col("is_test")).drop("rn", "is_test"), TARGET, "crash_id"))
    return selection.Training(rows, "crash_id", TARGET, FEATURE_COLUMNS, 5, {"trees": trees, "rounds": rounds, "max_depth": MAX_DEPTH})


def _test(spark, sf_dir):
    return S.split(spark, sf_dir).filter(F.col("is_test"))


def _fitted(spark, sf_dir, name: str, fit) -> ensemble.Ensemble:
    """A model of all training rows: fitted once per source, then read from its table of nodes."""
    def build():
        t = _training(spark, sf_dir)
        return ensemble.node_table(fit(t)[0], spark)
    return ensemble.of_table(ingest(spark, f"{sf_dir}/orders.parquet", name, build))


def _leafwise(spark, sf_dir) -> ensemble.Ensemble:
    return _fitted(spark, sf_dir, f"leafwise-{ROUNDS}", lambda t: leafwise.fit_leafwise(t.blocks, t.bins, rounds=ROUNDS))


def _metrics(spark, sf_dir, model: ensemble.Ensemble, name: str):
    t = _training(spark, sf_dir)
    pred = ensemble.predicted(t.coded(_test(spark, sf_dir)), model, FEATURE_COLUMNS)
    return evaluate.classification_metrics(pred, "label", "prediction").withColumn("model", F.lit(name))


@register("train_extra_trees")
def train_extra_trees(spark, sf_dir):
    """ML9: 400 extremely randomised trees with balanced weights -> test metrics."""
    model = _fitted(spark, sf_dir, f"extra-{TREES}-{MAX_DEPTH}", lambda t: extra_trees.fit_extra_trees(t.blocks, len(t.classes), t.bins, trees=TREES, max_depth=MAX_DEPTH))
    return _metrics(spark, sf_dir, model, "ExtraTrees")


@register("train_leafwise")
def train_leafwise(spark, sf_dir):
    """ML11: leaf-wise boosted trees of 63 leaves -> test metrics."""
    return _metrics(spark, sf_dir, _leafwise(spark, sf_dir), "LightGBM")


@register("train_depthwise")
def train_depthwise(spark, sf_dir):
    """ML10: boosted trees of depth 6 with second-order gains and row and column sampling -> test metrics."""
    model = _fitted(spark, sf_dir, f"depthwise-{DEPTHWISE_ROUNDS}", lambda t: leafwise.fit_depthwise(t.blocks, t.bins, rounds=DEPTHWISE_ROUNDS))
    return _metrics(spark, sf_dir, model, "XGBoost")


@register("leafwise_importance")
def leafwise_importance(spark, sf_dir):
    """ML19/WI6: share of the total gain by feature of the leaf-wise model, largest first."""
    share = _leafwise(spark, sf_dir).importance(len(FEATURE_COLUMNS))
    return spark.createDataFrame(sorted(zip(FEATURE_COLUMNS, map(float, share)), key=lambda r: (-r[1], r[0]))[:20], "feature string, importance double")


@register("attribution_shapley")
def attribution_shapley(spark, sf_dir):
    """EX1/EX2: exact path-dependent Shapley values of the leaf-wise model on up to 5,000 test rows -> top-20 shares."""
    rows = exact_sample(_test(spark, sf_dir), 5000, "crash_id").repartition(spark.sparkContext.defaultParallelism)  # the first rows come in one partition
    return attribution_share(global_importance(shapley(rows, _leafwise(spark, sf_dir), FEATURE_COLUMNS, "crash_id")))


@register("attribution_tree_local")
def attribution_tree_local(spark, sf_dir):
    """EX4: exact attributions of the tree model to the predicted class of the example rows (picked before they are explained)."""
    model = _leafwise(spark, sf_dir)
    rows = example_rows(_test(spark, sf_dir), "crash_id")
    told = ensemble.predicted(rows, model, FEATURE_COLUMNS).select("crash_id", "position", "prediction")
    toward = F.when(F.col("prediction") == 1, F.col("value")).otherwise(-F.col("value"))  # log odds of class 1
    return shapley(rows, model, FEATURE_COLUMNS, "crash_id").join(F.broadcast(told), "crash_id").withColumn("value", toward)  # three rows


@register("lime_local")
def lime_local_q(spark, sf_dir):
    """EX5: quartile-binned local surrogate (5,000 draws, 10 features) of the tree model for the example rows of the test set."""
    model = _leafwise(spark, sf_dir)
    train = S.split(spark, sf_dir).filter(~F.col("is_test"))
    rows = example_rows(_test(spark, sf_dir), "crash_id").select("crash_id", *FEATURE_COLUMNS)
    return lime_local(lambda df: F.element_at(ensemble.probability(df, model, FEATURE_COLUMNS), 2), rows, train, FEATURE_COLUMNS, "crash_id")


def _cv_scores(spark, sf_dir):
    """Fold scores of all models, stored once per source."""
    return ingest(spark, f"{sf_dir}/orders.parquet", f"cv-{CV_TREES}-{CV_ROUNDS}", lambda: selection.cross_validate(_training(spark, sf_dir, CV_TREES, CV_ROUNDS)))


@register("cv_summary")
def cv_summary(spark, sf_dir):
    """ML12/AG20/SE4: five-fold stratified CV of all five models; errors as rows."""
    return selection.summary(_cv_scores(spark, sf_dir))


@register("best_model")
def best_model(spark, sf_dir):
    """ML13/WI5/FI18: the best model by mean macro F1 among those without error, refitted on all training rows -> test metrics."""
    name = selection.best_of(selection.summary(_cv_scores(spark, sf_dir)))
    pred = selection.refit(_training(spark, sf_dir, CV_TREES, CV_ROUNDS), name, _test(spark, sf_dir))
    return evaluate.classification_metrics(pred, "label", "prediction").withColumn("model", F.lit(name))


@register("logreg_smote_metrics")
def logreg_smote_metrics(spark, sf_dir):
    """ML7/ML8: logistic regression on training rows balanced by synthetic ones, without class weights -> test metrics."""
    pred = selection.refit(_training(spark, sf_dir), "LogReg+SMOTE", _test(spark, sf_dir))
    return evaluate.classification_metrics(pred, "label", "prediction")
