"""Column lists and explicit schemas for the crash tables.

The column names below are fixed values: they must equal the names of the
public city crash extract the analysis runs on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---- fixed values: required crash columns, in the order of the clean table ----
REQUIRED_COLUMNS = [
    "POSTED_SPEED_LIMIT",
    "TRAFFIC_CONTROL_DEVICE",
    "DEVICE_CONDITION",
    "WEATHER_CONDITION",
    "LIGHTING_CONDITION",
    "FIRST_CRASH_TYPE",
    "TRAFFICWAY_TYPE",
    "ALIGNMENT",
    "ROADWAY_SURFACE_COND",
    "ROAD_DEFECT",
    "REPORT_TYPE",
    "CRASH_TYPE",
    "DAMAGE",
    "PRIM_CONTRIBUTORY_CAUSE",
    "SEC_CONTRIBUTORY_CAUSE",
    "NUM_UNITS",
    "MOST_SEVERE_INJURY",
    "INJURIES_TOTAL",
    "INJURIES_FATAL",
    "INJURIES_INCAPACITATING",
    "INJURIES_NON_INCAPACITATING",
    "INJURIES_REPORTED_NOT_EVIDENT",
    "INJURIES_NO_INDICATION",
    "INJURIES_UNKNOWN",
    "CRASH_HOUR",
    "CRASH_DAY_OF_WEEK",
    "CRASH_MONTH",
    "LATITUDE",
    "LONGITUDE",
]

# ---- fixed values: environment columns (a row with all of them null is dropped) ----
ENV_COLUMNS = [
    "TRAFFIC_CONTROL_DEVICE",
    "DEVICE_CONDITION",
    "WEATHER_CONDITION",
    "LIGHTING_CONDITION",
    "TRAFFICWAY_TYPE",
    "ALIGNMENT",
    "ROADWAY_SURFACE_COND",
    "ROAD_DEFECT",
]

# ---- fixed values: injury count columns used by the drive-away rule ----
INJURY_COLUMNS_ALL = [
    "INJURIES_TOTAL",
    "INJURIES_FATAL",
    "INJURIES_INCAPACITATING",
    "INJURIES_NON_INCAPACITATING",
    "INJURIES_REPORTED_NOT_EVIDENT",
    "INJURIES_NO_INDICATION",
    "INJURIES_UNKNOWN",
]

# ---- fixed values: the five injury columns of the severity score ----
SEVERITY_COLUMNS = [
    "INJURIES_FATAL",
    "INJURIES_INCAPACITATING",
    "INJURIES_NON_INCAPACITATING",
    "INJURIES_REPORTED_NOT_EVIDENT",
    "INJURIES_NO_INDICATION",
]

# ---- fixed values: categorical columns label-encoded for modelling ----
CATEGORICAL_COLUMNS = [
    "TRAFFIC_CONTROL_DEVICE", "DEVICE_CONDITION", "WEATHER_CONDITION", "LIGHTING_CONDITION",
    "FIRST_CRASH_TYPE", "TRAFFICWAY_TYPE", "ALIGNMENT", "ROADWAY_SURFACE_COND", "ROAD_DEFECT",
    "REPORT_TYPE", "INTERSECTION_RELATED_I", "NOT_RIGHT_OF_WAY_I", "HIT_AND_RUN_I", "DAMAGE",
    "PRIM_CONTRIBUTORY_CAUSE", "SEC_CONTRIBUTORY_CAUSE", "DOORING_I", "WORK_ZONE_I",
    "WORK_ZONE_TYPE", "WORKERS_PRESENT_I",
]

# ---- fixed values: leakage / identifier columns dropped before modelling ----
DROP_COLUMNS = [
    "STREET_NO", "STREET_DIRECTION", "STREET_NAME", "CRASH_RECORD_ID", "RD_NO",
    "BEAT_OF_OCCURRENCE", "STATEMENTS_TAKEN_I", "PHOTOS_TAKEN_I", "DATE_POLICE_NOTIFIED",
    "CRASH_DATE", "MOST_SEVERE_INJURY", "INJURIES_TOTAL", "INJURIES_FATAL",
    "INJURIES_INCAPACITATING", "INJURIES_NON_INCAPACITATING", "INJURIES_REPORTED_NOT_EVIDENT",
    "INJURIES_NO_INDICATION", "INJURIES_UNKNOWN", "LOCATION", "LATITUDE", "LONGITUDE",
]

# ---- fixed values: mostly-null columns dropped before modelling ----
DROP_HIGH_NULL_COLUMNS = [
    "NOT_RIGHT_OF_WAY_I", "DOORING_I", "WORK_ZONE_I", "WORK_ZONE_TYPE",
    "WORKERS_PRESENT_I", "LANE_CNT", "HIT_AND_RUN_I",
]

# ---- fixed values: the 20 model features, in model input order ----
FEATURE_COLUMNS = [
    "POSTED_SPEED_LIMIT", "TRAFFIC_CONTROL_DEVICE", "DEVICE_CONDITION", "WEATHER_CONDITION",
    "LIGHTING_CONDITION", "FIRST_CRASH_TYPE", "TRAFFICWAY_TYPE", "ALIGNMENT",
    "ROADWAY_SURFACE_COND", "ROAD_DEFECT", "REPORT_TYPE", "INTERSECTION_RELATED_I", "DAMAGE",
    "PRIM_CONTRIBUTORY_CAUSE", "SEC_CONTRIBUTORY_CAUSE", "NUM_UNITS", "CRASH_HOUR",
    "CRASH_DAY_OF_WEEK", "CRASH_MONTH", "CRASH_TIME_OF_DAY",
]

TARGET = "CRASH_TYPE"
NO_INJURY = "NO INJURY / DRIVE AWAY"
INJURY = "INJURY AND / OR TOW DUE TO CRASH"

_INT_COLUMNS = {
    "POSTED_SPEED_LIMIT", "NUM_UNITS", "CRASH_HOUR", "CRASH_DAY_OF_WEEK", "CRASH_MONTH",
    *INJURY_COLUMNS_ALL,
}

# Raw crash extract: every column as read from CSV. Coordinates stay strings so
# that coercion (try_cast) decides what is numeric, as the analysis requires.
CRASHES_RAW = T.StructType(
    [T.StructField("CRASH_RECORD_ID", T.StringType())]
    + [T.StructField("CRASH_DATE", T.StringType()), T.StructField("DATE_POLICE_NOTIFIED", T.StringType())]
    + [
        T.StructField(c, T.IntegerType() if c in _INT_COLUMNS else T.StringType())
        for c in REQUIRED_COLUMNS
    ]
    + [T.StructField("INTERSECTION_RELATED_I", T.StringType())]
)


def require_columns(df: DataFrame, columns, what: str = "input") -> None:
    """Raise ``KeyError`` naming every required column missing from ``df``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"Missing {what} columns: {missing}")
