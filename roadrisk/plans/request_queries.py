"""Registered queries: whole dashboard requests, published result sets, coordinate systems, table profiles, completions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import crs
from ..functions import labels as L
from ..functions.recode import recode_categories, recode_causes, recode_traffic_control
from ..operators import artefacts
from ..operators import dashboard as D
from ..operators import ml as ML
from ..operators import risk as R
from ..operators.clean import coerce_coordinates
from ..operators.dbscan import eps_neighbours
from ..operators.profile import null_profile, shape, table_profile
from ..schemas import FEATURE_COLUMNS, REQUIRED_COLUMNS, TARGET
from ..session import ensure_checkpoint_dir
from . import stages as S
from .cluster_queries import dsql
from .dashboard_queries import CLASS_SQL, MD5, SPLIT_SQL, REQ_SQL, class_map
from .feature_queries import _recoded_row_sql, fsql, q
from .registry import register, rounded, sql

REQUEST = D.CrashFilter(hours=list(range(7, 19)), days=[0, 1, 2, 3, 4], years=[2023], weather=["RAIN", "CLEAR", "SLEET/HAIL"], surface=list(L.SURFACE_NAMES))


# ---- dashboard request ----


def _request(spark, sf_dir, f: D.CrashFilter, *layers: str):
    """The outputs of one request over the crashes, scored by their own weighted severity."""
    scored = R.crash_severity(S.dashboard_crashes(spark, sf_dir)).withColumn("mean_weighted_severity", F.col("weighted_severity"))
    areas = clusters = risk = None
    if "areas" in layers:
        ar = S.areas_with_risk(spark, sf_dir)
        areas = R.with_risk_band(ar, thresholds=R.quantile_thresholds(ar), zero_is_no_data=True)
    if "clusters" in layers:
        c = S.clustered(spark, sf_dir)
        clusters, risk = R.cluster_centroids(c), R.cluster_risk(c)
    return D.dashboard(scored, f, areas, clusters, risk, layers=layers)


def _stats_sql(flag: str) -> str:
    part = lambda c: f"CAST(coalesce(sum(CASE WHEN {flag} THEN {c} END), 0) AS BIGINT)"
    return f"""
SELECT filtered_count, total_count, round(CASE WHEN total_count > 0 THEN filtered_count / total_count * 100 ELSE 0.0 END, 9) AS percentage, fatal_filtered, fatal_total,
  injury_filtered, injury_total, round(rf, 9) AS mean_risk_filtered, round(rt, 9) AS mean_risk_total, round(CASE WHEN rt > 0 THEN (rf - rt) / rt * 100 ELSE 0.0 END, 9) AS risk_change
FROM (SELECT count_if({flag}) AS filtered_count, count(*) AS total_count, {part('fatal')} AS fatal_filtered, CAST(coalesce(sum(fatal), 0) AS BIGINT) AS fatal_total,
  {part('serious')} + {part('moderate')} AS injury_filtered, CAST(coalesce(sum(serious), 0) + coalesce(sum(moderate), 0) AS BIGINT) AS injury_total,
  coalesce(avg(CASE WHEN {flag} THEN weighted_severity END), 0) AS rf, coalesce(avg(weighted_severity), 0) AS rt FROM (SELECT dash.*, s.weighted_severity FROM dash JOIN severity s USING (crash_id)))"""


@register("request_statistics", sql(_stats_sql(REQ_SQL)))
def request_statistics(spark, sf_dir):
    """AP4/AG11: statistics of a request with scores (its year selection is the full domain)."""
    return rounded(_request(spark, sf_dir, REQUEST, "statistics")["statistics"])


@register("request_reset", sql(_stats_sql("true")))
def request_reset(spark, sf_dir):
    """FI15: after a reset every panel has its full domain and all crashes are shown."""
    return rounded(_request(spark, sf_dir, D.reset(), "statistics")["statistics"])


@register("request_points", sql(
    f"SELECT crash_id, cls AS severity, {class_map(L.CLASS_COLOR, True)} AS color, {class_map(L.CLASS_SIZE, False)} AS size FROM (SELECT *, {CLASS_SQL} AS cls FROM ("
    f"SELECT * FROM dash WHERE {REQ_SQL} ORDER BY {MD5}, crash_id LIMIT 5000))"))
def request_points(spark, sf_dir):
    """AP4/SP10: the point layer of a request."""
    return _request(spark, sf_dir, REQUEST, "points")["points"].select("crash_id", "severity", "color", "size")


@register("request_areas", sql(
    "SELECT area_num_1, community, risk_category, CASE risk_category " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in L.BAND_COLORS_FILTER.items()) + " END AS color, total_crashes, "
    "round(mean_weighted_severity, 9) AS mean_weighted_severity FROM (SELECT a.*, CASE WHEN mean_weighted_severity IS NULL OR mean_weighted_severity = 0 THEN 'No Data' "
    "WHEN mean_weighted_severity >= p90 THEN 'Critical' WHEN mean_weighted_severity >= p75 THEN 'High' WHEN mean_weighted_severity >= p50 THEN 'Medium' ELSE 'Low' END AS risk_category "
    "FROM area_risk a, (SELECT quantile_cont(mean_weighted_severity, 0.5) AS p50, quantile_cont(mean_weighted_severity, 0.75) AS p75, quantile_cont(mean_weighted_severity, 0.9) AS p90 FROM area_risk))"))
def request_areas(spark, sf_dir):
    """AP4/SP9: the area layer of a request, band and colour included."""
    return rounded(_request(spark, sf_dir, REQUEST, "areas")["areas"].select("area_num_1", "community", "risk_category", "color", "total_crashes", "mean_weighted_severity"))


@register("request_clusters", dsql(
    "SELECT c.cluster_id, r.total_crashes, round(r.weighted_score, 9) AS weighted_score, round(sqrt(r.total_crashes) * 2, 9) AS marker_size FROM c_cent c LEFT JOIN c_risk r USING (cluster_id)"))
def request_clusters(spark, sf_dir):
    """AP4/SP11: the cluster layer of a request."""
    return rounded(_request(spark, sf_dir, REQUEST, "clusters")["clusters"].select("cluster_id", "total_crashes", "weighted_score", "marker_size"))


@register("areas_without_fatal", sql(
    "SELECT s.a AS community_area_number FROM (SELECT CAST(range AS BIGINT) AS a FROM range(1, 78)) s "
    "WHERE s.a NOT IN (SELECT community_area_number FROM severity WHERE community_area_number IS NOT NULL AND INJURIES_FATAL > 0 AND CRASH_HOUR = 3)"))
def areas_without_fatal(spark, sf_dir):
    """FI16: areas without any crash among the fatal ones of one hour (the spine keeps them, their counts are 0)."""
    some = S.severity(spark, sf_dir).filter((F.col("INJURIES_FATAL") > 0) & (F.col("CRASH_HOUR") == 3))
    return R.community_risk(some).filter(F.col("total_crashes") == 0).select("community_area_number")


_REORDERED = D.CrashFilter(lighting=list(reversed(L.LIGHTING_NAMES)), months=[2, 1])


@register("filter_reordered", sql(
    f"SELECT crash_id FROM dash WHERE coalesce(LIGHTING_CONDITION IN ({', '.join(q(v) for v in L.LIGHTING_NAMES)}), false) AND coalesce(crash_month IN (1, 2), false)"))
def filter_reordered(spark, sf_dir):
    """FI14: a full list in another order does filter: values that it does not name, and nulls, are left out."""
    return D.apply_filters(S.dashboard_crashes(spark, sf_dir), _REORDERED).select("crash_id")


# ---- published result sets ----


@register("published_artefacts", fsql(
    f"SELECT 'probabilities' AS artefact, count(*) FILTER (WHERE rn <= round(nc * 0.2)) AS n, true AS same FROM ({SPLIT_SQL}) UNION ALL SELECT 'scored_again', "
    f"count(*) FILTER (WHERE rn <= round(nc * 0.2)), true FROM ({SPLIT_SQL}) UNION ALL SELECT 'top_attributions', 20, true UNION ALL SELECT 'feature_names', 20, true UNION ALL SELECT 'metrics', 1, true"))
def published_artefacts(spark, sf_dir):
    """IO7-IO9, IO11, IO12: probabilities, JSON records, names, metrics and the whole pipeline published as one version, read back and compared."""
    from ..operators import evaluate as EV
    from ..operators.explain import attribution_share, linear_importance
    from .ml_queries import _logreg
    split = S.split(spark, sf_dir)
    train, test = split.filter(~F.col("is_test")), split.filter(F.col("is_test"))
    pred, fitted, indexer = _logreg(spark, sf_dir)
    coefficients = fitted.coefficients.toArray().tolist()
    scored = ML.score_batch(pred, indexer).select("crash_id", "predicted_label", "confidence", "is_injury", "prob")
    scaled = ML.standardize(ML.median_impute(test, FEATURE_COLUMNS, stats_from=train), FEATURE_COLUMNS, stats_from=ML.median_impute(train, FEATURE_COLUMNS))
    top = attribution_share(linear_importance(scaled, coefficients, FEATURE_COLUMNS))
    metrics = EV.classification_metrics(pred, "label", "prediction")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/published/{uuid.uuid4().hex[:12]}"
    artefacts.publish(spark, folder, {
        "probabilities": ("parquet", scored), "top_attributions": ("json", top), "metrics": ("json", metrics),
        "feature_names": ("text", FEATURE_COLUMNS), "model": ("pipeline", ML.fit_pipeline(train, FEATURE_COLUMNS, TARGET))})
    back = artefacts.load(spark, folder)
    alike = lambda a, b: a.select(*b.columns).exceptAll(b).isEmpty() and b.exceptAll(a.select(*b.columns)).isEmpty()
    again = back["model"].transform(test.drop(TARGET)).select("crash_id", "predicted_label")
    rows = [
        ("probabilities", back["probabilities"].count(), alike(back["probabilities"], scored)), ("scored_again", again.count(), alike(again, back["probabilities"].select("crash_id", "predicted_label"))),
        ("top_attributions", back["top_attributions"].count(), alike(rounded(back["top_attributions"]), rounded(top))), ("feature_names", len(back["feature_names"]), back["feature_names"] == FEATURE_COLUMNS),
        ("metrics", back["metrics"].count(), alike(rounded(back["metrics"]), rounded(metrics)))]
    return spark.createDataFrame(rows, "artefact string, n long, same boolean")


# ---- coordinate systems ----


def _checked_points(spark, sf_dir):
    return crs.with_srid(crs.require_rows(S.points(spark, sf_dir).select("crash_id", "lon", "lat"), "crash points"), 4326)


@register("reprojected_points", sql(
    "SELECT crash_id, round(6378137.0 * radians(lon), 3) AS x, round(6378137.0 * ln(tan(pi() / 4 + radians(lat) / 2)), 3) AS y, round(lon, 9) AS lon, round(lat, 9) AS lat FROM points"))
def reprojected_points(spark, sf_dir):
    """SP2/PR7: points to spherical Mercator, on to UTM zone 16 and back to degrees; tables are checked for rows and SRID."""
    pts = _checked_points(spark, sf_dir)
    mercator = crs.reproject(pts, 3857)
    crs.require_srid(3857, mercator)
    back = crs.reproject(crs.reproject(mercator, 32616), 4326)
    crs.require_srid(4326, pts, back)
    xy = mercator.select("crash_id", F.round("lon", 3).alias("x"), F.round("lat", 3).alias("y"))
    return rounded(xy.join(back, "crash_id"))


# ---- profiles ----


def _typed(spark, sf_dir):
    from ..functions.recode import parse_ts
    return coerce_coordinates(S.raw(spark, sf_dir)).withColumn("CRASH_DATE", parse_ts("CRASH_DATE").cast("string"))


_TYPED_SQL = "(SELECT * REPLACE (CAST(try_strptime(CRASH_DATE, '%m/%d/%Y %I:%M:%S %p') AS VARCHAR) AS CRASH_DATE) FROM coerced)"
_PROFILED = REQUIRED_COLUMNS + ["CRASH_DATE", "INTERSECTION_RELATED_I"]


@register("null_profile_all", sql(" UNION ALL ".join(f"SELECT {q(c)} AS column, count(*) - count({c}) AS null_count FROM {_TYPED_SQL}" for c in _PROFILED)))
def null_profile_all(spark, sf_dir):
    """AG3: null counts of every required column and both extra ones, after coercion."""
    return null_profile(_typed(spark, sf_dir), _PROFILED)


_INTS = ["POSTED_SPEED_LIMIT", "NUM_UNITS", "CRASH_HOUR", "CRASH_DAY_OF_WEEK", "CRASH_MONTH"]
_TEXTS = [c for c in REQUIRED_COLUMNS if c.isupper() and c not in _INTS and not c.startswith("INJURIES") and c not in ("LATITUDE", "LONGITUDE")]


@register("table_profile", sql(" UNION ALL ".join(
    f"SELECT {q(c)} AS column, {q('int' if c in _INTS else 'string')} AS type, count(*) AS n_rows, count(*) - count({c}) AS n_null, CAST(min({c}) AS VARCHAR) AS least, "
    f"CAST(max({c}) AS VARCHAR) AS greatest FROM crashes" for c in _INTS + _TEXTS)))
def table_profile_q(spark, sf_dir):
    """PR9: type, rows, nulls and extremes of every number and text column in one scan."""
    return table_profile(S.raw(spark, sf_dir).select(*_INTS, *_TEXTS)).select("column", "type", "n_rows", "n_null", "least", "greatest")


@register("table_shape", sql(f"SELECT count(*) AS n_rows, CAST({len(_PROFILED)} AS INT) AS n_columns FROM crashes"))
def table_shape(spark, sf_dir):
    """PR9: rows and columns of the crash extract."""
    return shape(S.raw(spark, sf_dir).select(*_PROFILED))


@register("clean_crashes_all", sql(
    "SELECT crash_id, " + ", ".join(f"round({c}, 9) AS {c}" if c in ("LATITUDE", "LONGITUDE") else c for c in REQUIRED_COLUMNS) + " FROM clean"))
def clean_crashes_all(spark, sf_dir):
    """PR1: all 29 required columns of the clean table."""
    return rounded(S.clean(spark, sf_dir).select("crash_id", *REQUIRED_COLUMNS))


# ---- neighbours ----


@register("dbscan_neighbors", dsql("SELECT i AS crash_id, count(*) AS neighbours FROM db_nb GROUP BY i"))
def dbscan_neighbors(spark, sf_dir):
    """JO6: number of points of the same area within 250 m of each point, itself included."""
    return eps_neighbours(S.severity(spark, sf_dir))


# ---- scoring form ----

_VOCABS = [c for c in L.FEATURE_VOCAB if c != "CRASH_TIME_OF_DAY"]


def _place(c: str, vocab: list[str]) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE CAST(coalesce(list_position([{', '.join(q(v) for v in vocab)}], {c}), 0) - 1 AS INT) END"


@register("form_codes", sql(
    f"SELECT crash_id, {', '.join(f'{_place(c, L.FEATURE_VOCAB[c])} AS {c}' for c in _VOCABS)}, CASE WHEN CRASH_DAY_OF_WEEK BETWEEN 0 AND 6 THEN CRASH_DAY_OF_WEEK + 1 END AS day_code, "
    f"CASE WHEN CRASH_MONTH BETWEEN 1 AND 12 THEN CRASH_MONTH END AS month_code FROM ({_recoded_row_sql('crashes')})"))
def form_codes(spark, sf_dir):
    """SC20/AP1: codes of all scoring-form vocabularies, and of day and month names as the form's lists give them."""
    df = recode_traffic_control(recode_categories(recode_causes(S.raw(spark, sf_dir))))
    days, months = (F.array(*[F.lit(n) for n in names]) for names in (L.FORM_DAYS, L.FORM_MONTHS))
    named = df.withColumns({"_day": F.get(days, F.col("CRASH_DAY_OF_WEEK").cast("int")), "_month": F.get(months, F.col("CRASH_MONTH").cast("int") - 1)})
    return named.select("crash_id", *[L.vocab_encode(c).alias(c) for c in _VOCABS], L.form_code("_day", L.FORM_DAYS).alias("day_code"), L.form_code("_month", L.FORM_MONTHS).alias("month_code"))


@register("damage_names", sql(
    "SELECT crash_id, CASE code " + " ".join(f"WHEN {k} THEN {q(v)}" for k, v in L.DAMAGE_NAMES.items()) + " END AS damage_name FROM (SELECT crash_id, crash_id % 9 AS code FROM crashes)"))
def damage_names(spark, sf_dir):
    """SC14: display names of damage codes (codes 0 and 8 have none)."""
    return S.raw(spark, sf_dir).select("crash_id", L.display_name(L.DAMAGE_NAMES, (F.col("crash_id") % 9).cast("int")).alias("damage_name"))
