"""Category consolidation, time-of-day and date parts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import col_, map_lookup

# ---- fixed values: contributory-cause consolidation (label -> group) ----
CAUSE_GROUPS = {
    "EQUIPMENT - VEHICLE CONDITION": "VEHICLE CONDITION",
    "ROAD ENGINEERING/SURFACE/MARKING DEFECTS": "ROAD DEFECTS",
    "ROAD CONSTRUCTION/MAINTENANCE": "ROAD DEFECTS",
    "VISION OBSCURED (SIGNS, TREE LIMBS, BUILDINGS, ETC.)": "OBSTRUCTION",
    "OBSTRUCTED CROSSWALKS": "OBSTRUCTION",
    "EVASIVE ACTION DUE TO ANIMAL, OBJECT, NONMOTORIST": "EVASIVE ACTION",
    "ANIMAL": "EVASIVE ACTION",
    "OPERATING VEHICLE IN ERRATIC, RECKLESS, CARELESS, NEGLIGENT OR AGGRESSIVE MANNER": "BAD DRIVING SKILLS",
    "DRIVING SKILLS/KNOWLEDGE/EXPERIENCE": "BAD DRIVING SKILLS",
    "IMPROPER BACKING": "BAD DRIVING SKILLS",
    "IMPROPER LANE USAGE": "BAD DRIVING SKILLS",
    "IMPROPER OVERTAKING/PASSING": "BAD DRIVING SKILLS",
    "IMPROPER TURNING/NO SIGNAL": "BAD DRIVING SKILLS",
    "FOLLOWING TOO CLOSELY": "BAD DRIVING SKILLS",
    "DISREGARDING TRAFFIC SIGNALS": "DISREGARDING TRAFFIC RULES",
    "DISREGARDING STOP SIGN": "DISREGARDING TRAFFIC RULES",
    "DISREGARDING OTHER TRAFFIC SIGNS": "DISREGARDING TRAFFIC RULES",
    "DISREGARDING ROAD MARKINGS": "DISREGARDING TRAFFIC RULES",
    "DISREGARDING YIELD SIGN": "DISREGARDING TRAFFIC RULES",
    "DRIVING ON WRONG SIDE/WRONG WAY": "DISREGARDING TRAFFIC RULES",
    "TURNING RIGHT ON RED": "DISREGARDING TRAFFIC RULES",
    "FAILING TO YIELD RIGHT-OF-WAY": "DISREGARDING TRAFFIC RULES",
    "EXCEEDING AUTHORIZED SPEED LIMIT": "OVERSPEEDING",
    "EXCEEDING SAFE SPEED FOR CONDITIONS": "OVERSPEEDING",
    "FAILING TO REDUCE SPEED TO AVOID CRASH": "OVERSPEEDING",
    "DISTRACTION - FROM OUTSIDE VEHICLE": "DISTRACTION",
    "DISTRACTION - OTHER ELECTRONIC DEVICE (NAVIGATION DEVICE, DVD PLAYER, ETC.)": "DISTRACTION",
    "DISTRACTION - FROM INSIDE VEHICLE": "DISTRACTION",
    "TEXTING": "TEXTING",
    "CELL PHONE USE OTHER THAN TEXTING": "TEXTING",
    "HAD BEEN DRINKING (USE WHEN ARREST IS NOT MADE)": "DRINKING",
    "UNDER THE INFLUENCE OF ALCOHOL/DRUGS (USE WHEN ARREST IS EFFECTED)": "DRINKING",
    "BICYCLE ADVANCING LEGALLY ON RED LIGHT": "BICYCLE/MOTORCYCLE ON RED",
    "MOTORCYCLE ADVANCING LEGALLY ON RED LIGHT": "BICYCLE/MOTORCYCLE ON RED",
}

# ---- fixed values: list recodes per column, applied in this order ----
# (column, [old values], new value). The report-type rule is kept literally
# (no space before the parenthesis), so it only matches that spelling.
LIST_RECODES = [
    ("REPORT_TYPE", ["NOT ON SCENE(DESK REPORT)"], "NOT ON SCENE"),
    ("ROAD_DEFECT", ["RUT, HOLES", "WORN SURFACE", "OTHER", "SHOULDER DEFECT", "DEBRIS ON ROADWAY"], "DEFECT"),
    ("ROADWAY_SURFACE_COND", ["SNOW OR SLUSH"], "SNOW"),
    ("ROADWAY_SURFACE_COND", ["SAND, MUD, DIRT"], "SAND/MUD/DIRT"),
    ("ALIGNMENT", ["STRAIGHT AND LEVEL", "STRAIGHT ON GRADE", "STRAIGHT ON HILLCREST"], "STRAIGHT"),
    ("ALIGNMENT", ["CURVE, LEVEL", "CURVE ON GRADE", "CURVE ON HILLCREST"], "CURVE"),
    ("TRAFFICWAY_TYPE", ["UNKNOWN INTERSECTION TYPE", "NOT REPORTED"], "UNKNOWN"),
    ("TRAFFICWAY_TYPE", ["Y-INTERSECTION", "L-INTERSECTION", "T-INTERSECTION"], "INTERSECTION"),
    ("TRAFFICWAY_TYPE", ["DIVIDED - W/MEDIAN (NOT RAISED)", "DIVIDED - W/MEDIAN BARRIER"], "DIVIDED"),
    ("WEATHER_CONDITION", ["CLOUDY/OVERCAST"], "CLOUDY"),
    ("WEATHER_CONDITION", ["FREEZING RAIN/DRIZZLE"], "RAIN"),
    ("WEATHER_CONDITION", ["FOG/SMOKE/HAZE"], "FOG"),
    ("WEATHER_CONDITION", ["SLEET/HAIL"], "HAIL"),
    ("WEATHER_CONDITION", ["SEVERE CROSS WIND GATE"], "SEVERE CROSS WIND"),
    ("WEATHER_CONDITION", ["BLOWING SAND, SOIL, DIRT"], "SANDSTORM"),
    ("DEVICE_CONDITION", ["MISSING", "UNKNOWN"], "UNKNOWN"),
    ("DEVICE_CONDITION", ["WORN REFLECTIVE MATERIAL"], "FUNCTIONING IMPROPERLY"),
]

# ---- fixed values: traffic-control values kept; everything else (nulls too) -> OTHER ----
TRAFFIC_CONTROL_KEEP = ["NO CONTROLS", "TRAFFIC SIGNAL", "STOP SIGN/FLASHER", "UNKNOWN"]

CAUSE_COLUMNS = ["PRIM_CONTRIBUTORY_CAUSE", "SEC_CONTRIBUTORY_CAUSE"]


def recode_causes(df: DataFrame, columns=CAUSE_COLUMNS) -> DataFrame:
    """Replace cause labels by their group; unmapped labels and nulls pass through."""
    return df.withColumns({c: map_lookup(CAUSE_GROUPS, c, F.col(c)) for c in columns if c in df.columns})


def recode_categories(df: DataFrame, recodes=LIST_RECODES) -> DataFrame:
    """Apply the list recodes. Each column's rules, applied in their order, compose into one flat CASE expression."""
    final: dict[str, dict[str, str]] = {}
    for c, olds, _ in recodes:
        if c in df.columns:
            final.setdefault(c, {}).update({v: v for v in olds})
    for c, olds, new in recodes:
        for v, now in final.get(c, {}).items():
            if now in olds:
                final[c][v] = new
    exprs: dict[str, Column] = {}
    for c, values in final.items():
        cases = F
        for new in dict.fromkeys(values.values()):
            cases = cases.when(F.col(c).isin([v for v, now in values.items() if now == new]), F.lit(new))
        exprs[c] = cases.otherwise(F.col(c))
    return df.withColumns(exprs)


def recode_traffic_control(df: DataFrame, c: str = "TRAFFIC_CONTROL_DEVICE") -> DataFrame:
    """Keep-list else 'OTHER' (null goes to 'OTHER' as well)."""
    return df.withColumn(c, F.when(F.col(c).isin(TRAFFIC_CONTROL_KEEP), F.col(c)).otherwise(F.lit("OTHER")))


def time_of_day(hour) -> Column:
    """Morning [5,12), Afternoon [12,17), Evening [17,21), else (and null) Night."""
    h = col_(hour)
    return (
        F.when((h >= 5) & (h < 12), "Morning")
        .when((h >= 12) & (h < 17), "Afternoon")
        .when((h >= 17) & (h < 21), "Evening")
        .otherwise("Night")
    )


CRASH_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def parse_ts(c, fmt: str = CRASH_TS_FORMAT) -> Column:
    """Coerced timestamp parse: text that does not match gives NULL."""
    return F.try_to_timestamp(col_(c), F.lit(fmt))


def datetime_parts(df: DataFrame, c: str, date_col: str, time_col: str, fmt: str = CRASH_TS_FORMAT) -> DataFrame:
    """Add ``date_col`` (DATE) and ``time_col`` ('HH:mm:ss' text) parsed from ``c``."""
    ts = parse_ts(c, fmt)
    return df.withColumns({date_col: F.to_date(ts), time_col: F.date_format(ts, "HH:mm:ss")})
