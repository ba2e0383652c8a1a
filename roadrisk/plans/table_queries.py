"""Registered queries on derived inputs: evaluation arithmetic, attribution shares, several-part areas, ranges.

A rule on the feature table stands in for a fitted model, so that the arithmetic of the evaluation and
attribution tables has an exact SQL form. Areas of several kinds of shape are derived from ``nation``
and points from ``customer``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import BAND_COLORS_FILTER, PREVENTIVE_MEASURES
from ..operators import dashboard as D
from ..operators import evaluate as EV
from ..operators import risk as R
from ..operators.explain import attribution_share, linear_importance
from ..operators.profile import group_ranges
from ..operators.sampling import stratified_folds
from ..operators.spatial import load_community_areas, spatial_join
from ..schemas import FEATURE_COLUMNS, TARGET
from ..session import ensure_checkpoint_dir
from ..sources.geojson import polygon_features, read_geojson_polygons
from . import stages as S
from .feature_queries import _features, fsql, q
from .registry import register, rounded, sql

# ---------------------------------------------------------------- evaluation

_LABEL = "CAST(CASE WHEN CRASH_TYPE = 'NO INJURY / DRIVE AWAY' THEN 1 ELSE 0 END AS DOUBLE)"
_RULES = {"rule_a": "CAST(CASE WHEN POSTED_SPEED_LIMIT >= 35 OR crash_id % 5 = 0 THEN 1 ELSE 0 END AS DOUBLE)",
          "rule_b": "CAST(CASE WHEN NUM_UNITS >= 2 AND crash_id % 7 <> 0 THEN 1 ELSE 0 END AS DOUBLE)"}
_PRED = f"(SELECT crash_id, CRASH_TYPE, {_LABEL} AS label, {_RULES['rule_a']} AS prediction FROM features)"
_PER_CLASS = """
SELECT g, cls, prec, rec, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END AS f1, support FROM (
  SELECT g, cls, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS prec, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS rec
  FROM (SELECT g, cls, count_if(label = cls AND prediction = cls) AS tp, count_if(label = cls) AS support, count_if(prediction = cls) AS predicted
        FROM {pred}, (SELECT unnest([0.0, 1.0]) AS cls) GROUP BY g, cls))
"""
_METRICS = """
SELECT g, sum(rec * support) / sum(support) AS accuracy, avg(CASE WHEN support > 0 THEN rec END) AS balanced_accuracy,
  avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1 FROM ({pc}) GROUP BY g
"""
_ONE = _PER_CLASS.format(pred=f"(SELECT 1 AS g, * FROM {_PRED})")


def _rule_predictions(spark, sf_dir, rule="rule_a"):
    return _features(spark, sf_dir).select("crash_id", TARGET, F.expr(_LABEL).alias("label"), F.expr(_RULES[rule]).alias("prediction"))


@register("eval_metrics", fsql("SELECT round(accuracy, 9) AS accuracy, round(balanced_accuracy, 9) AS balanced_accuracy, "
                               "round(macro_f1, 9) AS macro_f1, round(weighted_f1, 9) AS weighted_f1 FROM (" + _METRICS.format(pc=_ONE) + ")"))
def eval_metrics(spark, sf_dir):
    """ML15-ML16: accuracy, balanced accuracy, macro and weighted F1 of a rule's predictions."""
    return rounded(EV.classification_metrics(_rule_predictions(spark, sf_dir)))


@register("confusion_matrix", fsql(
    f"SELECT l AS label, p AS prediction, count_if(label = l AND prediction = p) AS n FROM {_PRED}, "
    "(SELECT unnest([0.0, 1.0]) AS l), (SELECT unnest([0.0, 1.0]) AS p) GROUP BY l, p"))
def confusion_matrix(spark, sf_dir):
    """ML18: confusion counts of a rule's predictions on the class spine."""
    return EV.confusion(_rule_predictions(spark, sf_dir))


@register("classification_report", fsql(
    "SELECT cls, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM ("
    "SELECT CASE WHEN cls = 0 THEN '0.0' ELSE '1.0' END AS cls, prec AS precision, rec AS recall, f1, support FROM (" + _ONE + ") UNION ALL "
    "SELECT 'macro avg', avg(prec), avg(rec), avg(f1), CAST(sum(support) AS BIGINT) FROM (" + _ONE + ") UNION ALL "
    "SELECT 'weighted avg', sum(prec * support) / sum(support), sum(rec * support) / sum(support), sum(f1 * support) / sum(support), "
    "CAST(sum(support) AS BIGINT) FROM (" + _ONE + "))"))
def classification_report(spark, sf_dir):
    """ML17: per-class precision, recall, F1 and support of a rule's predictions, macro and weighted averages."""
    return rounded(EV.classification_report(_rule_predictions(spark, sf_dir)))


_FOLDS = ("(SELECT crash_id, (row_number() OVER (PARTITION BY CRASH_TYPE ORDER BY md5(concat_ws('-', '42', CAST(crash_id AS VARCHAR))), "
          "crash_id) - 1) % 5 AS fold FROM features)")
_CV = " UNION ALL ".join(
    f"SELECT '{name}' AS model, macro_f1, balanced_accuracy FROM (" + _METRICS.format(pc=_PER_CLASS.format(
        pred=f"(SELECT fold AS g, {_LABEL} AS label, {rule} AS prediction FROM features JOIN {_FOLDS} USING (crash_id))")) + ")"
    for name, rule in _RULES.items())


@register("cv_arithmetic", fsql(
    "SELECT model, round(avg(macro_f1), 9) AS macro_f1_mean, round(stddev_pop(macro_f1), 9) AS macro_f1_std, "
    "round(avg(balanced_accuracy), 9) AS bal_acc_mean, round(stddev_pop(balanced_accuracy), 9) AS bal_acc_std FROM (" + _CV + ") GROUP BY model"))
def cv_arithmetic(spark, sf_dir):
    """ML12/AG20: mean and deviation over five stratified folds of two rules' scores."""
    scores = None
    for name in _RULES:
        folds = stratified_folds(_rule_predictions(spark, sf_dir, name), TARGET, "crash_id")
        for k in range(5):
            one = EV.classification_metrics(folds.filter(F.col("fold") == k)).withColumn("model", F.lit(name))
            scores = one if scores is None else scores.unionByName(one)
    return rounded(scores.groupBy("model").agg(
        F.avg("macro_f1").alias("macro_f1_mean"), F.stddev_pop("macro_f1").alias("macro_f1_std"),
        F.avg("balanced_accuracy").alias("bal_acc_mean"), F.stddev_pop("balanced_accuracy").alias("bal_acc_std")))


# ---------------------------------------------------------------- attribution

#: A fixed linear model: alternating signs, growing size.
_WEIGHTS = [(j + 1) / 10 * (1 if j % 2 else -1) for j in range(len(FEATURE_COLUMNS))]
_IMPORTANCE = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(abs({w!r} * ({c} - m))) AS v FROM features, (SELECT avg({c}) AS m FROM features)"
    for w, c in zip(_WEIGHTS, FEATURE_COLUMNS))
_MEASURE = "CASE feature " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in PREVENTIVE_MEASURES.items() if k != "DEFAULT") + f" ELSE {q(PREVENTIVE_MEASURES['DEFAULT'])} END"


@register("attribution_share", fsql(
    f"SELECT feature, round(v, 9) AS mean_abs_shap, round_even(v / sum(v) OVER () * 100, 2) AS percent_contribution, {_MEASURE} AS preventive_measure "
    f"FROM (SELECT * FROM ({_IMPORTANCE}) ORDER BY v DESC, feature LIMIT 20)"))
def attribution_share_q(spark, sf_dir):
    """EX2/EX3/AG19/WI7: mean |w (x - mean)| of a fixed linear model, top 20 with percent share and measure."""
    return rounded(attribution_share(linear_importance(_features(spark, sf_dir), _WEIGHTS, FEATURE_COLUMNS)))


@register("preventive_measures", fsql(f"SELECT DISTINCT feature, {_MEASURE} AS preventive_measure FROM ({_IMPORTANCE})"))
def preventive_measures(spark, sf_dir):
    """SC16: the preventive measure of every attributed feature."""
    ranked = attribution_share(linear_importance(_features(spark, sf_dir), _WEIGHTS, FEATURE_COLUMNS), top=len(FEATURE_COLUMNS))
    return ranked.select("feature", "preventive_measure")


# ---------------------------------------------------------------- layers and ranges

_E6 = "CAST(round({} * 1000000) AS BIGINT)"
@register("choropleth_rings", sql(
    "SELECT area_num_1, community, concat_ws(' ', " + ", ".join(_E6.format(c) for c in ("lon_lo", "lon_hi", "lon_hi", "lon_lo", "lon_lo")) + ") AS lons, "
    "concat_ws(' ', " + ", ".join(_E6.format(c) for c in ("lat_lo", "lat_lo", "lat_hi", "lat_hi", "lat_lo")) + ") AS lats, total_crashes, fatal, "
    "round(mean_weighted_severity, 9) AS mean_weighted_severity FROM areas JOIN area_risk USING (area_num_1, community)"))
def choropleth_rings(spark, sf_dir):
    """SP8/SP9 + FI17: exterior rings of the polygon layer as text, in millionths of a degree."""
    ar = S.areas_with_risk(spark, sf_dir)
    layer = D.choropleth_layer(R.with_risk_band(ar, thresholds=R.quantile_thresholds(ar), zero_is_no_data=True), BAND_COLORS_FILTER)
    text = lambda c: F.array_join(F.transform(c, lambda v: F.round(v * 1000000).cast("long").cast("string")), " ").alias(c)
    return rounded(layer.select("area_num_1", "community", text("lons"), text("lats"), "total_crashes", "fatal", "mean_weighted_severity"))


@register("area_ranges", sql(
    "SELECT community_area_number, round(min(LATITUDE), 9) AS LAT_MIN, round(max(LATITUDE), 9) AS LAT_MAX, round(min(LONGITUDE), 9) AS LON_MIN, "
    "round(max(LONGITUDE), 9) AS LON_MAX, round(avg(LATITUDE), 9) AS LAT_CENTER, round(avg(LONGITUDE), 9) AS LON_CENTER FROM joined GROUP BY 1"))
def area_ranges(spark, sf_dir):
    """AG4/AG5: bounding ranges and centre of the points of every given group."""
    return rounded(group_ranges(S.joined(spark, sf_dir), "community_area_number"))


@register("points_with_ranges", sql(
    "SELECT crash_id, round(LATITUDE - avg(LATITUDE) OVER (PARTITION BY community_area_number), 9) AS north, "
    "round(LONGITUDE - avg(LONGITUDE) OVER (PARTITION BY community_area_number), 9) AS east FROM joined"))
def points_with_ranges(spark, sf_dir):
    """JO1: every point joined to its group's ranges and centre."""
    j = S.joined(spark, sf_dir)
    ranges = group_ranges(j, "community_area_number").withColumnRenamed("community_area_number", "_group")
    far = j.join(ranges, j["community_area_number"].eqNullSafe(F.col("_group")))
    return rounded(far.select("crash_id", (F.col("LATITUDE") - F.col("LAT_CENTER")).alias("north"), (F.col("LONGITUDE") - F.col("LON_CENTER")).alias("east")))


@register("dashboard_crashes", sql(
    "SELECT crash_id, crash_hour AS \"crash_hour\", crash_day_of_week AS \"crash_day_of_week\", crash_month AS \"crash_month\", crash_year, "
    "fatal, serious, moderate, minor, \"none\" FROM dash"))
def dashboard_crashes(spark, sf_dir):
    """PR4/PR5: the crash table under the dashboards' names, with its constant year."""
    return S.dashboard_crashes(spark, sf_dir).select(
        "crash_id", "crash_hour", "crash_day_of_week", "crash_month", "crash_year", "fatal", "serious", "moderate", "minor", "none")


_NO_SUCH = D.CrashFilter(years=[2022], crash_types=["REAR END", "ANGLE"])
_OF_YEAR = D.CrashFilter(years=[2023], crash_types=["REAR END", "ANGLE"], surface=["WET", "DRY"])


@register("filter_year_type", sql(
    "SELECT crash_id FROM dash WHERE crash_year IN (2023) AND coalesce(FIRST_CRASH_TYPE IN ('REAR END', 'ANGLE'), false) "
    "AND coalesce(ROADWAY_SURFACE_COND IN ('WET', 'DRY'), false)"))
def filter_year_type(spark, sf_dir):
    """FI9-FI11: filters by year, crash type and surface; a year without crashes adds nothing."""
    d = S.dashboard_crashes(spark, sf_dir)
    return D.apply_filters(d, _OF_YEAR).select("crash_id").unionByName(D.apply_filters(d, _NO_SUCH).select("crash_id"))


# ---------------------------------------------------------------- areas of several shapes

def _ring(*corners):
    x0, y0 = F.col("x0"), F.col("y0")
    return F.array(*[F.struct((x0 + F.lit(float(x))).alias("x"), (y0 + F.lit(float(y))).alias("y")) for x, y in (*corners, corners[0])])


def _shapes(spark, sf_dir):
    """An area for each nation in a 10 x 10 field: L-shaped, a square with a hole, or two separate squares."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    k = F.col("n_nationkey")
    n = n.withColumns({"x0": (k % 5 * 10).cast("double"), "y0": F.floor(k / 5).cast("double") * 10})
    ell = F.array(_ring((0, 0), (8, 0), (8, 3), (3, 3), (3, 8), (0, 8)))
    holed = F.array(_ring((0, 0), (8, 0), (8, 8), (0, 8)), _ring((2, 2), (2, 5), (5, 5), (5, 2)))
    two = F.array(_ring((0, 0), (3, 0), (3, 3), (0, 3)), _ring((5, 5), (9, 5), (9, 9), (5, 9)), _ring((6, 6), (6, 7), (7, 7), (7, 6)))
    return n.select(k.cast("string").alias("area_numbe"), F.col("n_name").alias("community"),
                    F.when(k % 3 == 0, ell).when(k % 3 == 1, holed).otherwise(two).alias("rings"),
                    F.when(k % 3 == 2, F.array(F.lit(1), F.lit(2))).when(k % 3 == 1, F.array(F.lit(2))).otherwise(F.array(F.lit(1))).alias("parts"))


def _boundaries(spark, sf_dir):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/io/boundaries-{uuid.uuid4().hex[:12]}"
    polygon_features(_shapes(spark, sf_dir)).write.text(path)
    props = T.StructType([T.StructField("area_numbe", T.StringType()), T.StructField("community", T.StringType())])
    return load_community_areas(read_geojson_polygons(spark, path, props, multiline=False))


@register("boundaries", """
SELECT CAST(n_nationkey AS BIGINT) AS community_area_number, n_name AS community_area_name,
  CASE WHEN n_nationkey % 3 = 2 THEN 'MultiPolygon' ELSE 'Polygon' END AS geom_type,
  CASE n_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS n_rings,
  CAST(n_nationkey % 5 * 10 AS DOUBLE) AS lon_lo, CAST(n_nationkey % 5 * 10 + CASE WHEN n_nationkey % 3 = 2 THEN 9 ELSE 8 END AS DOUBLE) AS lon_hi
FROM nation""")
def boundaries(spark, sf_dir):
    """IO4/IO6 + PR3: areas with holes and several parts written as GeoJSON, read back, renamed and typed."""
    from ..functions.geo import ring_bounds
    b = _boundaries(spark, sf_dir)
    return b.withColumns(ring_bounds("rings")).select("community_area_number", "community_area_name", "geom_type", F.size("rings").alias("n_rings"), "lon_lo", "lon_hi")


_PX, _PY = "(c_custkey * 7919 % 49999) / 1000.0", "(c_custkey * 104729 % 49999) / 1000.0"


@register("several_part_join", f"""
WITH p AS (SELECT c_custkey, {_PX} AS x, {_PY} AS y FROM customer),
c AS (SELECT n_nationkey AS k, n_nationkey % 5 * 10 AS x0, n_nationkey // 5 * 10 AS y0 FROM nation),
m AS (SELECT c_custkey, k, x - x0 AS u, y - y0 AS v FROM p JOIN c ON x > x0 AND x < x0 + 10 AND y > y0 AND y < y0 + 10),
h AS (SELECT c_custkey, k FROM m WHERE CASE k % 3
  WHEN 0 THEN u > 0 AND v > 0 AND (u < 8 AND v < 3 OR u < 3 AND v < 8)
  WHEN 1 THEN u > 0 AND v > 0 AND u < 8 AND v < 8 AND NOT (u >= 2 AND u <= 5 AND v >= 2 AND v <= 5)
  ELSE u > 0 AND v > 0 AND u < 3 AND v < 3 OR u > 5 AND v > 5 AND u < 9 AND v < 9 AND NOT (u >= 6 AND u <= 7 AND v >= 6 AND v <= 7) END)
SELECT c_custkey, CAST(k AS BIGINT) AS community_area_number FROM p LEFT JOIN h USING (c_custkey)""")
def several_part_join(spark, sf_dir):
    """JO5/SP3: points joined to concave, holed and two-part areas; each point at most once per area."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    pts = c.select("c_custkey", F.expr(_PX).cast("double").alias("lon"), F.expr(_PY).cast("double").alias("lat"))
    return spatial_join(pts, _boundaries(spark, sf_dir)).select("c_custkey", "community_area_number")


@register("polygon_layer", """
WITH a AS (SELECT c_nationkey AS k, count(*) AS n, avg(c_acctbal) AS score FROM customer GROUP BY c_nationkey),
j AS (SELECT n_nationkey AS k, n_name, coalesce(n, 0) AS n, score FROM nation LEFT JOIN a ON a.k = n_nationkey),
q AS (SELECT quantile_cont(score, 0.5) AS p50, quantile_cont(score, 0.75) AS p75, quantile_cont(score, 0.9) AS p90 FROM j)
SELECT CAST(k AS BIGINT) AS area_num_1, n_name AS community, CASE WHEN score IS NULL THEN 'No Data' WHEN score >= p90 THEN 'Critical' WHEN score >= p75 THEN 'High' WHEN score >= p50 THEN 'Medium' ELSE 'Low' END AS risk_category,
  n AS total_crashes, CASE k % 3 WHEN 0 THEN 7 ELSE 5 END AS n_points, CAST(k % 5 * 10 AS DOUBLE) AS first_lon FROM j, q WHERE k % 3 <> 2""")
def polygon_layer(spark, sf_dir):
    """FI17/SP9: area layer over areas of both types: those of several parts are left out of it, their scores still set the bands."""
    from ..functions.labels import BAND_COLORS_FILTER
    from ..operators import risk as R
    from ..operators.dashboard import choropleth_layer
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy(F.col("c_nationkey").cast("long").alias("community_area_number")).agg(
        F.count(F.lit(1)).alias("total_crashes"), F.avg("c_acctbal").alias("mean_weighted_severity"))
    areas = _boundaries(spark, sf_dir).join(c, "community_area_number", "left").fillna(0, subset=["total_crashes"]).withColumn("fatal", F.lit(0))
    named = areas.drop("community").withColumnsRenamed({"community_area_number": "area_num_1", "community_area_name": "community"})
    layer = choropleth_layer(R.with_risk_band(named), BAND_COLORS_FILTER)
    return layer.select("area_num_1", "community", "risk_category", "total_crashes", F.size("lons").alias("n_points"), F.col("lons")[0].alias("first_lon"))
