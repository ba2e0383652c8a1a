"""Registered queries: cleaning, points, spatial join, severity and risk tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import risk as R
from ..operators.profile import coordinate_bounds, describe
from . import stages as S
from .registry import register, rounded, sql

@register("clean_crashes", sql(
    "SELECT crash_id, POSTED_SPEED_LIMIT, WEATHER_CONDITION, CRASH_TYPE, INJURIES_REPORTED_NOT_EVIDENT, "
    "CRASH_HOUR, round(LATITUDE, 9) AS LATITUDE, round(LONGITUDE, 9) AS LONGITUDE FROM clean"))
def clean_crashes(spark, sf_dir):
    """PR1 + FI3/FI5/FI6/FI7: valid rows projected to the required columns."""
    return rounded(S.clean(spark, sf_dir).select(
        "crash_id", "POSTED_SPEED_LIMIT", "WEATHER_CONDITION", "CRASH_TYPE", "INJURIES_REPORTED_NOT_EVIDENT",
        "CRASH_HOUR", "LATITUDE", "LONGITUDE"))


@register("clean_crashes_count", sql("SELECT count(*) AS n_rows, count(DISTINCT crash_id) AS n_ids FROM clean"))
def clean_crashes_count(spark, sf_dir):
    return S.clean(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("crash_id").alias("n_ids"))


@register("coerce_coords", sql(
    "SELECT crash_id, round(LATITUDE, 9) AS lat_num, round(LONGITUDE, 9) AS lon_num FROM coerced"))
def coerce_coords(spark, sf_dir):
    """SC1: lenient numeric parse of the coordinate text (junk -> NULL)."""
    from ..operators.clean import coerce_coordinates
    df = coerce_coordinates(S.raw(spark, sf_dir))
    return rounded(df.select("crash_id", F.col("LATITUDE").alias("lat_num"), F.col("LONGITUDE").alias("lon_num")))


@register("crash_points", sql("SELECT crash_id, round(lon, 9) AS lon, round(lat, 9) AS lat FROM points"))
def crash_points(spark, sf_dir):
    """SP1 + FI2/FI4: point table (lon, lat) of the clean crashes."""
    return rounded(S.points(spark, sf_dir).select("crash_id", "lon", "lat"))


@register("crash_points_qa", sql(
    "SELECT count(*) AS n_points, bool_and(isfinite(lat) AND isfinite(lon) AND lat BETWEEN -90 AND 90 "
    "AND lon BETWEEN -180 AND 180) AS all_valid FROM points"))
def crash_points_qa(spark, sf_dir):
    """SP4 + AG21: every point geometry is valid."""
    p = S.points(spark, sf_dir)
    finite = lambda c: ~F.isnan(c) & (F.abs(c) != float("inf"))
    ok = finite(F.col("lat")) & finite(F.col("lon")) & F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    return p.agg(F.count(F.lit(1)).alias("n_points"), F.bool_and(ok).alias("all_valid"))


@register("coordinate_bounds", sql(
    "SELECT round(min(lat), 9) AS lat_min, round(max(lat), 9) AS lat_max, round(min(lon), 9) AS lon_min, "
    "round(max(lon), 9) AS lon_max FROM points"))
def coordinate_bounds_q(spark, sf_dir):
    """AG6: global bounds of the points."""
    return rounded(coordinate_bounds(S.points(spark, sf_dir), "lat", "lon"))


@register("spatial_join", sql(
    "SELECT crash_id, community_area_number, community_area_name FROM joined"))
def spatial_join(spark, sf_dir):
    """JO5/SP3: point-in-polygon left join of crash points to community areas."""
    return S.joined(spark, sf_dir).select("crash_id", "community_area_number", "community_area_name")


@register("spatial_join_qa", sql(
    "SELECT count(community_area_number) AS assigned, count(*) - count(community_area_number) AS unassigned, "
    "count(DISTINCT community_area_number) AS unique_areas, "
    "(SELECT count(area_num_1) - count(DISTINCT area_num_1) + greatest(count(*) - count(area_num_1) - 1, 0) FROM areas) "
    "AS duplicate_codes, (SELECT count(*) - count(area_num_1) FROM areas) AS missing_codes FROM joined"))
def spatial_join_qa(spark, sf_dir):
    """AG14: assigned / unassigned / unique areas and boundary-code QA."""
    j = S.joined(spark, sf_dir).agg(
        F.count("community_area_number").alias("assigned"),
        (F.count(F.lit(1)) - F.count("community_area_number")).alias("unassigned"),
        F.count_distinct("community_area_number").alias("unique_areas"),
    )
    c = F.col("community_area_number")
    a = S.areas(spark).agg(
        (F.count(c) - F.count_distinct(c) + F.greatest(F.count(F.lit(1)) - F.count(c) - 1, F.lit(0))).alias("duplicate_codes"),
        (F.count(F.lit(1)) - F.count(c)).alias("missing_codes"),
    )
    return j.withColumn("_one", F.lit(1)).join(a.withColumn("_one", F.lit(1)), "_one").drop("_one")


@register("crash_severity", sql("SELECT crash_id, community_area_number, round(weighted_severity, 9) AS weighted_severity FROM severity"))
def crash_severity(spark, sf_dir):
    """SC8 (row level): weighted severity per crash."""
    return rounded(S.severity(spark, sf_dir).select("crash_id", "community_area_number", "weighted_severity"))


_CR_COLS = "community_area_number, total_crashes, fatal, serious, moderate, minor, \"none\", " \
           "round(mean_weighted_severity, 9) AS mean_weighted_severity, round(risk_index, 9) AS risk_index"


@register("community_risk", sql(f"SELECT {_CR_COLS} FROM community_risk"))
def community_risk(spark, sf_dir):
    """AG9 + JO2 + SC8: per-area risk table over the 77-area spine."""
    return rounded(S.community(spark, sf_dir))


@register("top_areas", sql(f"SELECT {_CR_COLS} FROM community_risk ORDER BY risk_index DESC, community_area_number LIMIT 10"))
def top_areas(spark, sf_dir):
    """WI1: top 10 areas by risk index."""
    return rounded(R.top_k(S.community(spark, sf_dir), "risk_index", 10, tie="community_area_number"))


@register("bottom_areas", sql(f"SELECT {_CR_COLS} FROM community_risk ORDER BY risk_index ASC, community_area_number LIMIT 10"))
def bottom_areas(spark, sf_dir):
    """WI2: bottom 10 areas by risk index."""
    return rounded(R.top_k(S.community(spark, sf_dir), "risk_index", 10, ascending=True, tie="community_area_number"))


@register("zero_crash_areas", sql("SELECT community_area_number FROM community_risk WHERE total_crashes = 0"))
def zero_crash_areas(spark, sf_dir):
    """FI16: areas without any crash."""
    return S.community(spark, sf_dir).filter(F.col("total_crashes") == 0).select("community_area_number")


@register("severity_describe", sql(
    "SELECT count(weighted_severity) AS count, round(avg(weighted_severity), 9) AS mean, "
    "round(stddev_samp(weighted_severity), 9) AS std, round(min(weighted_severity), 9) AS min, "
    "round(quantile_cont(weighted_severity, 0.25), 9) AS p25, round(quantile_cont(weighted_severity, 0.5), 9) AS p50, "
    "round(quantile_cont(weighted_severity, 0.75), 9) AS p75, round(max(weighted_severity), 9) AS max FROM severity"))
def severity_describe(spark, sf_dir):
    """AG15: describe() of the crash score (exact quartiles)."""
    return rounded(describe(S.severity(spark, sf_dir), "weighted_severity"))


@register("risk_thresholds", sql(
    "SELECT round(quantile_cont(mean_weighted_severity, 0.5), 9) AS p50, "
    "round(quantile_cont(mean_weighted_severity, 0.75), 9) AS p75, "
    "round(quantile_cont(mean_weighted_severity, 0.9), 9) AS p90 FROM community_risk "
    "WHERE mean_weighted_severity IS NOT NULL"))
def risk_thresholds(spark, sf_dir):
    """AG16: p50/p75/p90 of the area scores (linear interpolation)."""
    return rounded(R.quantile_thresholds(S.stored_community(spark, sf_dir)))


_TH = ("th AS (SELECT quantile_cont(mean_weighted_severity, 0.5) AS p50, quantile_cont(mean_weighted_severity, 0.75) AS p75, "
       "quantile_cont(mean_weighted_severity, 0.9) AS p90 FROM community_risk WHERE mean_weighted_severity IS NOT NULL)")


def _band_sql(zero: bool) -> str:
    nd = "s IS NULL OR s = 0" if zero else "s IS NULL"
    return (f"CASE WHEN {nd} THEN 'No Data' WHEN s >= p90 THEN 'Critical' WHEN s >= p75 THEN 'High' "
            "WHEN s >= p50 THEN 'Medium' ELSE 'Low' END")


def _banded(spark, sf_dir, zero=False):
    ar = S.areas_with_risk(spark, sf_dir)
    th = R.quantile_thresholds(S.stored_community(spark, sf_dir))
    return R.with_risk_band(ar, "mean_weighted_severity", thresholds=th, zero_is_no_data=zero)


@register("risk_category", sql(
    "SELECT area_num_1, community, round(mean_weighted_severity, 9) AS mean_weighted_severity, "
    + _band_sql(False).replace("s IS NULL", "mean_weighted_severity IS NULL").replace("s >=", "mean_weighted_severity >=")
    + " AS risk_category FROM area_risk, (SELECT quantile_cont(mean_weighted_severity, 0.5) AS p50, "
    "quantile_cont(mean_weighted_severity, 0.75) AS p75, quantile_cont(mean_weighted_severity, 0.9) AS p90 "
    "FROM community_risk WHERE mean_weighted_severity IS NOT NULL) th"))
def risk_category(spark, sf_dir):
    """SC9: quantile risk band per area (null score -> No Data)."""
    return rounded(_banded(spark, sf_dir).select("area_num_1", "community", "mean_weighted_severity", "risk_category"))


@register("risk_category_zero", sql(
    "SELECT area_num_1, community, round(mean_weighted_severity, 9) AS mean_weighted_severity, "
    + _band_sql(True).replace("s IS NULL OR s = 0", "mean_weighted_severity IS NULL OR mean_weighted_severity = 0")
    .replace("s >=", "mean_weighted_severity >=")
    + " AS risk_category FROM area_risk, (SELECT quantile_cont(mean_weighted_severity, 0.5) AS p50, "
    "quantile_cont(mean_weighted_severity, 0.75) AS p75, quantile_cont(mean_weighted_severity, 0.9) AS p90 "
    "FROM area_risk WHERE mean_weighted_severity IS NOT NULL) th"))
def risk_category_zero(spark, sf_dir):
    """SC10: band variant where a zero score also means No Data (thresholds from the joined areas)."""
    ar = S.areas_with_risk(spark, sf_dir)
    th = R.quantile_thresholds(ar)
    return rounded(R.with_risk_band(ar, thresholds=th, zero_is_no_data=True).select(
        "area_num_1", "community", "mean_weighted_severity", "risk_category"))


@register("risk_distribution", sql(
    "SELECT b.band_order, b.risk_category, c.areas FROM (VALUES (0, 'Critical'), (1, 'High'), (2, 'Medium'), "
    "(3, 'Low'), (4, 'No Data')) b(band_order, risk_category) LEFT JOIN (SELECT risk_category, count(*) AS areas FROM ("
    "SELECT " + _band_sql(False).replace("s IS NULL", "mean_weighted_severity IS NULL").replace("s >=", "mean_weighted_severity >=")
    + " AS risk_category FROM area_risk, (SELECT quantile_cont(mean_weighted_severity, 0.5) AS p50, "
    "quantile_cont(mean_weighted_severity, 0.75) AS p75, quantile_cont(mean_weighted_severity, 0.9) AS p90 "
    "FROM community_risk WHERE mean_weighted_severity IS NOT NULL) th) GROUP BY 1) c USING (risk_category)"))
def risk_distribution(spark, sf_dir):
    """AG18: areas per band in fixed order; absent band -> null count."""
    return R.band_distribution(_banded(spark, sf_dir))


@register("risk_summary", sql(
    "SELECT count(*) AS total_areas, count(total_crashes) AS areas_with_data, "
    "CAST(sum(total_crashes) AS BIGINT) AS total_crashes, "
    "(SELECT community FROM area_risk ORDER BY mean_weighted_severity DESC NULLS LAST, area_num_1 LIMIT 1) "
    "AS highest_risk_area, "
    "round(avg(mean_weighted_severity), 9) AS mean_risk_score, CAST(sum(fatal) AS BIGINT) AS total_fatal "
    "FROM area_risk"))
def risk_summary(spark, sf_dir):
    """AG17 + WI4: summary card (arg-max area by score, ties to the lowest area number)."""
    ar = S.areas_with_risk(spark, sf_dir)
    # max_by over (score, -area) makes the arg-max deterministic under ties
    key = F.struct(F.col("mean_weighted_severity"), (-F.col("area_num_1")).alias("neg_area"))
    return rounded(ar.agg(
        F.count(F.lit(1)).alias("total_areas"), F.count("total_crashes").alias("areas_with_data"),
        F.sum("total_crashes").cast("long").alias("total_crashes"),
        F.max_by("community", key).alias("highest_risk_area"),
        F.avg("mean_weighted_severity").alias("mean_risk_score"), F.sum("fatal").cast("long").alias("total_fatal"),
    ))


@register("top_areas_table", sql(
    "SELECT area_num_1, community, total_crashes, round(mean_weighted_severity, 2) AS risk_score, fatal, "
    + _band_sql(False).replace("s IS NULL", "mean_weighted_severity IS NULL").replace("s >=", "mean_weighted_severity >=")
    + " AS risk_category FROM area_risk, (SELECT quantile_cont(mean_weighted_severity, 0.5) AS p50, "
    "quantile_cont(mean_weighted_severity, 0.75) AS p75, quantile_cont(mean_weighted_severity, 0.9) AS p90 "
    "FROM community_risk WHERE mean_weighted_severity IS NOT NULL) th "
    "ORDER BY mean_weighted_severity DESC NULLS LAST, area_num_1 LIMIT 10"))
def top_areas_table(spark, sf_dir):
    """WI3: nlargest(10) areas by score (nulls last, ties by area number)."""
    b = _banded(spark, sf_dir)
    top = R.top_k(b, "mean_weighted_severity", 10, tie="area_num_1")
    return top.select("area_num_1", "community", "total_crashes", F.round("mean_weighted_severity", 2).alias("risk_score"),
                      "fatal", "risk_category")


@register("area_risk_map", sql(
    "SELECT area_num_1, community, community_area_number, total_crashes, round(risk_index, 9) AS risk_index FROM area_risk"))
def area_risk_map(spark, sf_dir):
    """JO3: area table left-joined to the risk table on differently named keys."""
    return rounded(S.areas_with_risk(spark, sf_dir).select(
        "area_num_1", "community", "community_area_number", "total_crashes", "risk_index"))
