"""Registered queries: recodes, date parts, feature table, encodings, profiles, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.recode import CAUSE_GROUPS, LIST_RECODES, TRAFFIC_CONTROL_KEEP, datetime_parts, recode_categories, \
    recode_causes, recode_traffic_control, time_of_day
from ..operators.clean import drop_zero_points
from ..operators.features import feature_table, label_vocab, prepare_categories
from ..operators.profile import class_distribution, null_profile, value_counts
from ..schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS
from . import stages as S
from .registry import register, rounded, sql


def q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _cause_sql(c: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in CAUSE_GROUPS.items())
    return f"CASE {c} {whens} ELSE {c} END"


def _recode_sql(c: str) -> str:
    e = c
    for col, olds, new in LIST_RECODES:
        if col == c:
            e = f"CASE WHEN ({e}) IN ({', '.join(q(o) for o in olds)}) THEN {q(new)} ELSE ({e}) END"
    return e


def _tcd_sql(c: str = "TRAFFIC_CONTROL_DEVICE") -> str:
    return f"CASE WHEN {c} IN ({', '.join(q(v) for v in TRAFFIC_CONTROL_KEEP)}) THEN {c} ELSE 'OTHER' END"


def _tod_sql(h: str = "CRASH_HOUR") -> str:
    return (f"CASE WHEN {h} >= 5 AND {h} < 12 THEN 'Morning' WHEN {h} >= 12 AND {h} < 17 THEN 'Afternoon' "
            f"WHEN {h} >= 17 AND {h} < 21 THEN 'Evening' ELSE 'Night' END")


_RECODED = ["REPORT_TYPE", "ROAD_DEFECT", "ROADWAY_SURFACE_COND", "ALIGNMENT", "TRAFFICWAY_TYPE", "WEATHER_CONDITION",
            "DEVICE_CONDITION"]
_FT_CATS = [c for c in CATEGORICAL_COLUMNS if c in (
    "TRAFFIC_CONTROL_DEVICE", "DEVICE_CONDITION", "WEATHER_CONDITION", "LIGHTING_CONDITION", "FIRST_CRASH_TYPE",
    "TRAFFICWAY_TYPE", "ALIGNMENT", "ROADWAY_SURFACE_COND", "ROAD_DEFECT", "REPORT_TYPE", "INTERSECTION_RELATED_I",
    "DAMAGE", "PRIM_CONTRIBUTORY_CAUSE", "SEC_CONTRIBUTORY_CAUSE")]


def _recoded_row_sql(src: str) -> str:
    """All categorical recodes of one raw row as a SELECT list over ``src``."""
    sel = []
    for c in ["crash_id", "POSTED_SPEED_LIMIT", "TRAFFIC_CONTROL_DEVICE", "DEVICE_CONDITION", "WEATHER_CONDITION",
              "LIGHTING_CONDITION", "FIRST_CRASH_TYPE", "TRAFFICWAY_TYPE", "ALIGNMENT", "ROADWAY_SURFACE_COND",
              "ROAD_DEFECT", "REPORT_TYPE", "INTERSECTION_RELATED_I", "DAMAGE", "PRIM_CONTRIBUTORY_CAUSE",
              "SEC_CONTRIBUTORY_CAUSE", "NUM_UNITS", "CRASH_HOUR", "CRASH_DAY_OF_WEEK", "CRASH_MONTH", "CRASH_TYPE"]:
        if c in ("PRIM_CONTRIBUTORY_CAUSE", "SEC_CONTRIBUTORY_CAUSE"):
            sel.append(f"{_cause_sql(c)} AS {c}")
        elif c == "TRAFFIC_CONTROL_DEVICE":
            sel.append(f"{_tcd_sql()} AS {c}")
        elif c in _RECODED:
            sel.append(f"{_recode_sql(c)} AS {c}")
        else:
            sel.append(c)
    return f"SELECT {', '.join(sel)} FROM {src}"


FEATURE_CTE = (
    ", ft_base AS (SELECT * FROM coerced WHERE LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL "
    "AND NOT (LATITUDE = 0 AND LONGITUDE = 0))"
    f", ft_rec AS ({_recoded_row_sql('ft_base')})"
    ", ft_fill AS (SELECT * REPLACE (" + ", ".join(
        f"coalesce({c}, {q('UNKNOWN' if c in ('REPORT_TYPE', 'INTERSECTION_RELATED_I') else 'Missing')}) AS {c}"
        for c in _FT_CATS) + f"), {_tod_sql()} AS CRASH_TIME_OF_DAY FROM ft_rec)"
    + "".join(
        f", v_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INT) AS code FROM (SELECT DISTINCT {c} AS v FROM ft_fill))"
        for c in _FT_CATS + ["CRASH_TIME_OF_DAY"])
    + ", features AS (SELECT f.crash_id, " + ", ".join(
        f"v_{c}.code AS {c}" if c in _FT_CATS + ["CRASH_TIME_OF_DAY"] else f"f.{c}" for c in FEATURE_COLUMNS)
    + ", f.CRASH_TYPE FROM ft_fill f " + " ".join(
        f"LEFT JOIN v_{c} ON v_{c}.v = f.{c}" for c in _FT_CATS + ["CRASH_TIME_OF_DAY"]) + ")\n"
)


def fsql(body: str) -> str:
    return sql(FEATURE_CTE + body)


def _features(spark, sf_dir):
    return feature_table(S.raw(spark, sf_dir))


@register("recode_causes", sql(
    f"SELECT crash_id, {_cause_sql('PRIM_CONTRIBUTORY_CAUSE')} AS PRIM_CONTRIBUTORY_CAUSE, "
    f"{_cause_sql('SEC_CONTRIBUTORY_CAUSE')} AS SEC_CONTRIBUTORY_CAUSE FROM crashes"))
def recode_causes_q(spark, sf_dir):
    """SC2: cause labels consolidated into groups (both cause columns)."""
    return recode_causes(S.raw(spark, sf_dir)).select("crash_id", "PRIM_CONTRIBUTORY_CAUSE", "SEC_CONTRIBUTORY_CAUSE")


@register("recode_categories", sql(
    "SELECT crash_id, " + ", ".join(f"{_recode_sql(c)} AS {c}" for c in _RECODED) + " FROM crashes"))
def recode_categories_q(spark, sf_dir):
    """SC3: list recodes of report type, defect, surface, alignment, trafficway, weather, device."""
    return recode_categories(S.raw(spark, sf_dir)).select("crash_id", *_RECODED)


@register("recode_traffic_control", sql(f"SELECT crash_id, {_tcd_sql()} AS TRAFFIC_CONTROL_DEVICE FROM crashes"))
def recode_traffic_control_q(spark, sf_dir):
    """SC4: keep-list else OTHER (nulls too)."""
    return recode_traffic_control(S.raw(spark, sf_dir)).select("crash_id", "TRAFFIC_CONTROL_DEVICE")


@register("time_of_day", sql(f"SELECT crash_id, CRASH_HOUR, {_tod_sql()} AS CRASH_TIME_OF_DAY FROM crashes"))
def time_of_day_q(spark, sf_dir):
    """SC7: hour -> Morning / Afternoon / Evening / Night."""
    return S.raw(spark, sf_dir).select("crash_id", "CRASH_HOUR", time_of_day("CRASH_HOUR").alias("CRASH_TIME_OF_DAY"))


@register("crash_datetime_parts", sql(
    "SELECT crash_id, CAST(try_strptime(CRASH_DATE, '%m/%d/%Y %I:%M:%S %p') AS DATE) AS CRASH_DATE_ONLY, "
    "strftime(try_strptime(CRASH_DATE, '%m/%d/%Y %I:%M:%S %p'), '%H:%M:%S') AS CRASH_TIME, "
    "strftime(try_strptime(DATE_POLICE_NOTIFIED, '%m/%d/%Y %I:%M:%S %p'), '%H:%M:%S') AS TIME_POLICE_NOTIFIED "
    "FROM crashes"))
def crash_datetime_parts(spark, sf_dir):
    """SC6: coerced timestamp parse -> date and time-of-day parts."""
    df = datetime_parts(S.raw(spark, sf_dir), "CRASH_DATE", "CRASH_DATE_ONLY", "CRASH_TIME")
    df = datetime_parts(df, "DATE_POLICE_NOTIFIED", "_d", "TIME_POLICE_NOTIFIED")
    return df.select("crash_id", "CRASH_DATE_ONLY", "CRASH_TIME", "TIME_POLICE_NOTIFIED")


@register("feature_table", fsql("SELECT * FROM features"))
def feature_table_q(spark, sf_dir):
    """ML1 + PR2 + FI1/FI2 + SC2-SC7 + SC5: integer-coded 20-feature modelling table."""
    return _features(spark, sf_dir)


@register("label_encode", fsql(" SELECT 'CRASH_TIME_OF_DAY' AS column, v AS value, code FROM v_CRASH_TIME_OF_DAY"
                               + "".join(f" UNION ALL SELECT {q(c)}, v, code FROM v_{c}" for c in _FT_CATS)))
def label_encode_q(spark, sf_dir):
    """ML1/ML2: the sorted-value vocabulary of every encoded column."""
    raw = S.raw(spark, sf_dir)
    df = prepare_categories(drop_zero_points(raw)).fillna("UNKNOWN", subset=["REPORT_TYPE", "INTERSECTION_RELATED_I"])
    df = df.fillna("Missing", subset=_FT_CATS).withColumn("CRASH_TIME_OF_DAY", time_of_day("CRASH_HOUR"))
    return label_vocab(df, _FT_CATS + ["CRASH_TIME_OF_DAY"])


@register("category_counts", sql(
    " UNION ALL ".join(f"SELECT {q(c)} AS column, {c} AS value, count(*) AS count FROM crashes WHERE {c} IS NOT NULL "
                       f"GROUP BY {c}" for c in _FT_CATS)))
def category_counts(spark, sf_dir):
    """AG1: value counts of every categorical column in one pass (nulls dropped)."""
    return value_counts(S.raw(spark, sf_dir), _FT_CATS)


_RAW_COLS = ["CRASH_DATE", "LATITUDE", "LONGITUDE", "WEATHER_CONDITION", "REPORT_TYPE", "INTERSECTION_RELATED_I",
             "INJURIES_REPORTED_NOT_EVIDENT", "TRAFFIC_CONTROL_DEVICE", "CRASH_TYPE"]


@register("null_profile", sql(" UNION ALL ".join(
    f"SELECT {q(c)} AS column, count(*) - count({c}) AS null_count FROM (SELECT * REPLACE ("
    "CAST(try_strptime(CRASH_DATE, '%m/%d/%Y %I:%M:%S %p') AS VARCHAR) AS CRASH_DATE) FROM coerced)" for c in _RAW_COLS)))
def null_profile_q(spark, sf_dir):
    """AG3: null count per column after coercion of coordinates and dates."""
    from ..operators.clean import coerce_coordinates
    from ..functions.recode import parse_ts
    df = coerce_coordinates(S.raw(spark, sf_dir)).withColumn("CRASH_DATE", parse_ts("CRASH_DATE").cast("string"))
    return null_profile(df, _RAW_COLS)


@register("class_distribution", fsql(
    "SELECT CRASH_TYPE AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share "
    "FROM features GROUP BY CRASH_TYPE"))
def class_distribution_q(spark, sf_dir):
    """AG2: normalised class shares of the target."""
    return rounded(class_distribution(_features(spark, sf_dir), "CRASH_TYPE"))


def _vocab_sql(c: str) -> str:
    vals = ", ".join(q(v) for v in L.FEATURE_VOCAB[c])
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE CAST(coalesce(list_position([{vals}], {c}), 0) - 1 AS INT) END"


_VOCAB_COLS = ["TRAFFIC_CONTROL_DEVICE", "WEATHER_CONDITION", "LIGHTING_CONDITION", "ROADWAY_SURFACE_COND",
               "REPORT_TYPE", "PRIM_CONTRIBUTORY_CAUSE", "DAMAGE", "ALIGNMENT"]


@register("vocab_encode", sql(
    f"SELECT crash_id, {', '.join(f'{_vocab_sql(c)} AS {c}' for c in _VOCAB_COLS)}, "
    f"CAST(list_position(['Morning', 'Afternoon', 'Evening', 'Night'], {_tod_sql()}) - 1 AS INT) AS CRASH_TIME_OF_DAY "
    f"FROM ({_recoded_row_sql('crashes')})"))
def vocab_encode_q(spark, sf_dir):
    """SC20 + AP1: scoring-form encoding (list position in the serving vocabulary)."""
    df = recode_traffic_control(recode_categories(recode_causes(S.raw(spark, sf_dir))))
    df = df.withColumn("CRASH_TIME_OF_DAY", time_of_day("CRASH_HOUR"))
    return df.select("crash_id", *[L.vocab_encode(c).alias(c) for c in _VOCAB_COLS + ["CRASH_TIME_OF_DAY"]])


def _rf_sql() -> str:
    causes = ", ".join(q(c) for c in L.RISKY_CAUSES)
    good = ", ".join(q(c) for c in L.GOOD_SURFACES)
    parts = [
        "CASE WHEN POSTED_SPEED_LIMIT >= 40 THEN 'High speed zone (≥40 mph)' END",
        "CASE WHEN WEATHER_CONDITION <> 'CLEAR' THEN 'Adverse weather: ' || WEATHER_CONDITION END",
        "CASE WHEN contains(LIGHTING_CONDITION, 'DARKNESS') THEN 'Low visibility (darkness)' END",
        f"CASE WHEN NOT (ROADWAY_SURFACE_COND IN ({good})) THEN 'Poor surface: ' || ROADWAY_SURFACE_COND END",
        f"CASE WHEN PRIM_CONTRIBUTORY_CAUSE IN ({causes}) THEN 'Dangerous behavior: ' || PRIM_CONTRIBUTORY_CAUSE END",
        "CASE WHEN NUM_UNITS >= 3 THEN 'Multiple vehicles (' || CAST(NUM_UNITS AS VARCHAR) || ')' END",
        "CASE WHEN CRASH_HOUR >= 22 OR CRASH_HOUR <= 5 THEN 'Late night hours' END",
    ]
    return f"concat_ws('; ', {', '.join(parts)})"


@register("risk_factors", sql(f"SELECT crash_id, {_rf_sql()} AS risk_factors FROM ({_recoded_row_sql('crashes')})"))
def risk_factors_q(spark, sf_dir):
    """SC17 + AP3: rule-based risk factors of each (recoded) crash as a request row."""
    df = recode_traffic_control(recode_categories(recode_causes(S.raw(spark, sf_dir))))
    return df.select("crash_id", F.array_join(L.risk_factors(), "; ").alias("risk_factors"))


@register("injury_flag", sql(
    "SELECT crash_id, CRASH_TYPE, NOT contains(upper(CRASH_TYPE), 'NO INJURY') AS is_injury FROM crashes"))
def injury_flag_q(spark, sf_dir):
    """SC19: injury outcome flag (the label does not name NO INJURY)."""
    return S.raw(spark, sf_dir).select("crash_id", "CRASH_TYPE", L.injury_flag("CRASH_TYPE").alias("is_injury"))


def _map_sql(mapping: dict, c: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items()) + " END"


@register("display_names", sql(
    f"SELECT crash_id, {_map_sql(L.WEATHER_NAMES, 'WEATHER_CONDITION')} AS weather_name, "
    f"{_map_sql(L.LIGHTING_NAMES, 'LIGHTING_CONDITION')} AS lighting_name, "
    f"{_map_sql(L.SURFACE_NAMES, 'ROADWAY_SURFACE_COND')} AS surface_name, "
    f"{_map_sql(L.CRASH_TYPE_NAMES, 'FIRST_CRASH_TYPE')} AS crash_type_name FROM dash"))
def display_names(spark, sf_dir):
    """SC14: display-name lookup for weather, lighting, surface and crash type."""
    d = S.dashboard_crashes(spark, sf_dir)
    return d.select("crash_id", L.display_name(L.WEATHER_NAMES, "WEATHER_CONDITION").alias("weather_name"),
                    L.display_name(L.LIGHTING_NAMES, "LIGHTING_CONDITION").alias("lighting_name"),
                    L.display_name(L.SURFACE_NAMES, "ROADWAY_SURFACE_COND").alias("surface_name"),
                    L.display_name(L.CRASH_TYPE_NAMES, "FIRST_CRASH_TYPE").alias("crash_type_name"))


_MONTHS = ", ".join(q(m) for m in L.MONTH_NAMES)
_DAYS = ", ".join(q(d) for d in L.DAY_NAMES)


@register("date_label", sql(
    "SELECT crash_id, coalesce(CASE WHEN crash_month BETWEEN 1 AND 12 AND crash_day_of_week BETWEEN 0 AND 6 "
    f"AND crash_hour IS NOT NULL THEN [{_MONTHS}][crash_month] || ' ' || [{_DAYS}][crash_day_of_week + 1] || ' ' || "
    "lpad(CAST(crash_hour AS VARCHAR), 2, '0') || ':00' END, 'Invalid Date') AS date_label FROM dash"))
def date_label(spark, sf_dir):
    """SC13: 'Mon Day HH:00' label; day code 7 (Sunday in 1..7 data) is out of range -> Invalid Date."""
    d = S.dashboard_crashes(spark, sf_dir)
    return d.select("crash_id", L.date_label("crash_month", "crash_day_of_week", "crash_hour").alias("date_label"))


@register("severity_class", sql(
    "SELECT crash_id, CASE WHEN coalesce(fatal > 0, false) THEN 'Fatal' WHEN coalesce(serious > 0, false) "
    "OR coalesce(moderate > 0, false) THEN 'Injury' ELSE 'Property' END AS severity_class FROM dash"))
def severity_class(spark, sf_dir):
    """SC11: point severity class."""
    return S.dashboard_crashes(spark, sf_dir).select("crash_id", L.severity_class().alias("severity_class"))
