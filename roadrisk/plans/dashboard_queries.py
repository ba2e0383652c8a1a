"""Registered queries: filter requests, filtered statistics, map layers, sampling, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import BAND_COLORS_FILTER, CLASS_COLOR, CLASS_SIZE, DAY_NAMES, LIGHTING_NAMES, MONTH_NAMES
from ..operators import dashboard as D
from ..operators import risk as R
from ..operators import sampling as SA
from . import stages as S
from .feature_queries import _features, fsql, q
from .registry import register, rounded, sql

# Example requests (the query parameters of the registered filter reports).
REQUEST = D.CrashFilter(hours=list(range(7, 19)), days=[0, 1, 2, 3, 4], weather=["RAIN", "CLEAR", "SLEET/HAIL"],
                        lighting=list(LIGHTING_NAMES))  # full lighting domain -> no lighting filter
SEVERITY_REQUEST = D.CrashFilter(severity=["Fatal", "Injury"])
RISK_REQUEST = D.CrashFilter(months=[1, 2, 3, 4, 5, 6], risk_range=(0.5, 2.0))

REQ_SQL = ("coalesce(crash_hour IN (7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18), false) "
            "AND coalesce(crash_day_of_week IN (0, 1, 2, 3, 4), false) "
            "AND coalesce(WEATHER_CONDITION IN ('RAIN', 'CLEAR', 'SLEET/HAIL'), false)")
_SEV_SQL = ("(coalesce(fatal > 0, false) OR (coalesce(serious > 0, false) OR coalesce(moderate > 0, false)))")


@register("filter_crashes", sql(f"SELECT crash_id FROM dash WHERE {REQ_SQL}"))
def filter_crashes(spark, sf_dir):
    """FI9-FI11 + FI14: temporal / environment filters (full-domain selections elided)."""
    return D.apply_filters(S.dashboard_crashes(spark, sf_dir), REQUEST).select("crash_id")


@register("filter_severity", sql(f"SELECT crash_id FROM dash WHERE {_SEV_SQL}"))
def filter_severity(spark, sf_dir):
    """FI12: severity disjunction (Fatal or Injury)."""
    return D.apply_filters(S.dashboard_crashes(spark, sf_dir), SEVERITY_REQUEST).select("crash_id")


@register("filter_risk_range", sql(
    "SELECT crash_id FROM (SELECT dash.*, s.weighted_severity AS risk_score FROM dash JOIN severity s USING (crash_id)) "
    "WHERE coalesce(crash_month IN (1, 2, 3, 4, 5, 6), false) AND risk_score >= 0.5 AND risk_score <= 2.0"))
def filter_risk_range(spark, sf_dir):
    """FI13: inclusive risk-score range, applied because the column exists."""
    from ..operators.risk import crash_severity
    d = crash_severity(S.dashboard_crashes(spark, sf_dir)).withColumn("risk_score", F.col("weighted_severity"))
    return D.apply_filters(d, RISK_REQUEST).select("crash_id")


@register("filter_statistics", sql(
    "SELECT filtered_count, total_count, round(percentage, 9) AS percentage, fatal_filtered, fatal_total, "
    "injury_filtered, injury_total, round(mean_risk_filtered, 9) AS mean_risk_filtered, "
    "round(mean_risk_total, 9) AS mean_risk_total, "
    "round(CASE WHEN mean_risk_total > 0 THEN (mean_risk_filtered - mean_risk_total) / mean_risk_total * 100 ELSE 0.0 END, 9) "
    "AS risk_change FROM (SELECT *, CASE WHEN total_count > 0 THEN filtered_count / total_count * 100 ELSE 0.0 END AS percentage, "
    "(3 * fatal_filtered + 2 * sf + mf) / greatest(filtered_count, 1) AS mean_risk_filtered, "
    "(3 * fatal_total + 2 * st + mt) / greatest(total_count, 1) AS mean_risk_total, "
    "sf + mf AS injury_filtered, st + mt AS injury_total FROM ("
    f"SELECT count_if({REQ_SQL}) AS filtered_count, count(*) AS total_count, "
    f"CAST(coalesce(sum(CASE WHEN {REQ_SQL} THEN fatal END), 0) AS BIGINT) AS fatal_filtered, "
    "CAST(coalesce(sum(fatal), 0) AS BIGINT) AS fatal_total, "
    f"CAST(coalesce(sum(CASE WHEN {REQ_SQL} THEN serious END), 0) AS BIGINT) AS sf, "
    f"CAST(coalesce(sum(CASE WHEN {REQ_SQL} THEN moderate END), 0) AS BIGINT) AS mf, "
    "CAST(coalesce(sum(serious), 0) AS BIGINT) AS st, CAST(coalesce(sum(moderate), 0) AS BIGINT) AS mt FROM dash))"))
def filter_statistics(spark, sf_dir):
    """AG11 + AP4: filtered-versus-total statistics (one conditional aggregation)."""
    return rounded(D.filter_statistics(S.dashboard_crashes(spark, sf_dir), REQUEST))


MD5 = "md5(concat_ws('-', '42', CAST(crash_id AS VARCHAR)))"
CLASS_SQL = ("CASE WHEN coalesce(fatal > 0, false) THEN 'Fatal' WHEN coalesce(serious > 0, false) OR "
        "coalesce(moderate > 0, false) THEN 'Injury' ELSE 'Property' END")


def class_map(d: dict, quote: bool) -> str:
    return "CASE cls " + " ".join(f"WHEN {q(k)} THEN {q(v) if quote else v}" for k, v in d.items()) + " END"


@register("sample_points", sql(f"SELECT crash_id FROM dash ORDER BY {MD5}, crash_id LIMIT 5000"))
def sample_points(spark, sf_dir):
    """SA1: exact seeded sample of 5000 points (hash order; all rows when fewer)."""
    return SA.exact_sample(S.dashboard_crashes(spark, sf_dir), 5000, "crash_id").select("crash_id")


@register("points_layer", sql(
    f"SELECT crash_id, round(lon, 9) AS lon, round(lat, 9) AS lat, cls AS severity, {class_map(CLASS_COLOR, True)} AS color, "
    f"{class_map(CLASS_SIZE, False)} AS size, coalesce(CASE WHEN crash_month BETWEEN 1 AND 12 AND crash_day_of_week BETWEEN 0 AND 6 "
    f"AND crash_hour IS NOT NULL THEN {list(MONTH_NAMES)}[crash_month] || ' ' || {list(DAY_NAMES)}[crash_day_of_week + 1] || ' ' || "
    "lpad(CAST(crash_hour AS VARCHAR), 2, '0') || ':00' END, 'Invalid Date') AS date_label "
    f"FROM (SELECT *, {CLASS_SQL} AS cls FROM (SELECT * FROM dash ORDER BY {MD5}, crash_id LIMIT 5000))"))
def points_layer(spark, sf_dir):
    """SP10 + SC11-SC13: crash point layer (sample, class, colour, size, date label)."""
    return rounded(D.points_layer(S.dashboard_crashes(spark, sf_dir)))


@register("choropleth_layer")
def choropleth_layer(spark, sf_dir):
    """SP8/SP9 + FI17 + SC10: polygon layer rows with band colour (zero score -> No Data)."""
    ar = S.areas_with_risk(spark, sf_dir)
    banded = R.with_risk_band(ar, thresholds=R.quantile_thresholds(ar), zero_is_no_data=True)
    return D.choropleth_layer(banded, BAND_COLORS_FILTER)


SPLIT_SQL = ("SELECT crash_id, CRASH_TYPE, row_number() OVER (PARTITION BY CRASH_TYPE ORDER BY "
              f"{MD5}, crash_id) AS rn, count(*) OVER (PARTITION BY CRASH_TYPE) AS nc FROM features")


@register("stratified_split", fsql(
    f"SELECT crash_id, CRASH_TYPE, rn <= round(nc * 0.2) AS is_test FROM ({SPLIT_SQL})"))
def stratified_split(spark, sf_dir):
    """SA2 + ML20: exact stratified 80/20 split (per class round(0.2 n) test rows, seed 42)."""
    return SA.stratified_split(_features(spark, sf_dir), "CRASH_TYPE", "crash_id").select("crash_id", "CRASH_TYPE", "is_test")


@register("stratified_folds", fsql(
    f"SELECT crash_id, CRASH_TYPE, CAST((rn - 1) % 5 AS INT) AS fold FROM ({SPLIT_SQL})"))
def stratified_folds(spark, sf_dir):
    """SA3: stratified 5-fold assignment in hash order."""
    return SA.stratified_folds(_features(spark, sf_dir), "CRASH_TYPE", "crash_id").select("crash_id", "CRASH_TYPE", "fold")


@register("example_rows", fsql(
    f"SELECT crash_id, position FROM (SELECT crash_id, row_number() OVER (ORDER BY {MD5}, crash_id) - 1 AS position "
    "FROM features) WHERE position IN (10, 100, 250)"))
def example_rows(spark, sf_dir):
    """SA4: rows at positions 10/100/250 of the hash order (fallback to row 0)."""
    return SA.example_rows(_features(spark, sf_dir), "crash_id").select("crash_id", "position")
