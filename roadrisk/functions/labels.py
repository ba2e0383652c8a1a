"""Display labels, bands, classes and rule lists as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col_, map_lookup

# ---- fixed values: display names for the dashboard ----
WEATHER_NAMES = {
    "CLEAR": "Clear Weather", "CLOUDY/OVERCAST": "Cloudy", "RAIN": "Rain", "SNOW": "Snow",
    "BLOWING SNOW": "Blowing Snow", "BLOWING SAND, SOIL, DIRT": "Blowing Sand/Dirt",
    "FOG/SMOKE/HAZE": "Fog/Smoke/Haze", "FREEZING RAIN/DRIZZLE": "Freezing Rain",
    "SLEET/HAIL": "Sleet/Hail", "SEVERE CROSS WIND GATE": "Severe Wind", "OTHER": "Other",
    "UNKNOWN": "Unknown",
}
LIGHTING_NAMES = {
    "DAYLIGHT": "Daylight", "DAWN": "Dawn", "DUSK": "Dusk", "DARKNESS": "Darkness - No Lights",
    "DARKNESS, LIGHTED ROAD": "Darkness - Street Lights", "UNKNOWN": "Unknown",
}
SURFACE_NAMES = {
    "DRY": "Dry Surface", "WET": "Wet Surface", "SNOW OR SLUSH": "Snow/Slush", "ICE": "Ice",
    "SAND, MUD, DIRT": "Sand/Mud/Dirt", "OTHER": "Other", "UNKNOWN": "Unknown",
}
CRASH_TYPE_NAMES = {
    "REAR END": "Rear End", "ANGLE": "Angle", "SIDESWIPE SAME DIRECTION": "Sideswipe - Same Direction",
    "SIDESWIPE OPPOSITE DIRECTION": "Sideswipe - Opposite Direction", "HEAD ON": "Head On",
    "TURNING": "Turning", "PEDESTRIAN": "Pedestrian", "PEDALCYCLIST": "Cyclist",
    "FIXED OBJECT": "Fixed Object", "PARKED MOTOR VEHICLE": "Parked Vehicle", "OVERTURNED": "Overturned",
    "OTHER OBJECT": "Other Object", "OTHER NONCOLLISION": "Non-Collision", "ANIMAL": "Animal",
    "REAR TO FRONT": "Rear to Front", "REAR TO SIDE": "Rear to Side", "REAR TO REAR": "Rear to Rear",
    "TRAIN": "Train",
}
DAMAGE_NAMES = {
    1: "$1-500", 2: "$501-1,500", 3: "$1,501-2,500", 4: "$2,501-5,000", 5: "$5,001-10,000",
    6: "$10,001+", 7: "Unknown",
}

# ---- fixed values: band colours (two palettes: area map and filter dashboard) ----
BAND_COLORS_MAP = {"No Data": "#f0f0f0", "Low": "#2E8B57", "Medium": "#FFD700", "High": "#FF6347", "Critical": "#DC143C"}
BAND_COLORS_FILTER = {"Critical": "#DC143C", "High": "#FF6347", "Medium": "#FFD700", "Low": "#90EE90", "No Data": "#D3D3D3"}
BAND_ORDER = ["Critical", "High", "Medium", "Low", "No Data"]

# ---- fixed values: point marker colour and size per severity class ----
CLASS_COLOR = {"Fatal": "#000080", "Injury": "#0000CD", "Property": "#4169E1"}
CLASS_SIZE = {"Fatal": 8, "Injury": 6, "Property": 4}

# ---- fixed values: month and day names of the point date label ----
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# ---- fixed values: preventive measure per feature ----
PREVENTIVE_MEASURES = {
    "FIRST_CRASH_TYPE": "Target high-risk collision types with engineering (roundabouts, protected turns), education and enforcement.",
    "LOCATION_CLUSTER": "Install engineering countermeasures (speed cushions, signage), hotspot redesigns and increased enforcement.",
    "CRASH_HOUR": "Focus lighting, policing and awareness campaigns at high-risk hours.",
    "PRIM_CONTRIBUTORY_CAUSE": "Behavioral interventions: distracted driving campaigns, DUI checkpoints, enforcement for speeding.",
    "TRAFFICWAY_TYPE": "Road design changes: medians, separated lanes and speed management.",
    "POSTED_SPEED_LIMIT": "Lower speed limits where needed; speed cameras and traffic calming.",
    "NUM_UNITS": "Improve intersection control and sightlines; redesign merges/diverges.",
    "LIGHTING_CONDITION": "Upgrade street lighting and reflective signage.",
    "WEATHER_CONDITION": "Weather-responsive signage and maintenance in seasonal risk months.",
    "ROADWAY_SURFACE_COND": "Improve pavement maintenance and anti-skid surfacing.",
    "DEVICE_CONDITION": "Maintain traffic control devices and signals.",
    "ROAD_DEFECT": "Promptly repair defects and inspect high-risk sections frequently.",
    "DEFAULT": "Investigate and apply targeted engineering, enforcement or education depending on feature context.",
}

# ---- fixed values: scoring-form vocabularies (list position = code) ----
FEATURE_VOCAB = {
    "TRAFFIC_CONTROL_DEVICE": ["NO CONTROLS", "TRAFFIC SIGNAL", "STOP SIGN/FLASHER", "UNKNOWN", "OTHER"],
    "DEVICE_CONDITION": ["NO CONTROLS", "UNKNOWN", "FUNCTIONING PROPERLY", "OTHER", "NOT FUNCTIONING",
                         "FUNCTIONING IMPROPERLY"],
    "WEATHER_CONDITION": ["CLEAR", "RAIN", "UNKNOWN", "CLOUDY", "SNOW", "FOG", "OTHER", "SEVERE CROSS WIND",
                          "HAIL", "BLOWING SNOW", "SANDSTORM"],
    "LIGHTING_CONDITION": ["DAYLIGHT", "DARKNESS, LIGHTED ROAD", "UNKNOWN", "DARKNESS", "DAWN", "DUSK"],
    "FIRST_CRASH_TYPE": ["TURNING", "REAR END", "OTHER OBJECT", "SIDESWIPE SAME DIRECTION", "ANGLE",
                         "PARKED MOTOR VEHICLE", "SIDESWIPE OPPOSITE DIRECTION", "FIXED OBJECT", "PEDALCYCLIST",
                         "REAR TO FRONT", "PEDESTRIAN", "HEAD ON", "REAR TO SIDE", "OTHER NONCOLLISION",
                         "REAR TO REAR", "ANIMAL", "OVERTURNED", "TRAIN"],
    "TRAFFICWAY_TYPE": ["NOT DIVIDED", "INTERSECTION", "DIVIDED", "PARKING LOT", "ONE-WAY", "FOUR WAY", "UNKNOWN",
                        "ALLEY", "CENTER TURN LANE", "OTHER", "RAMP", "FIVE POINT, OR MORE", "TRAFFIC ROUTE",
                        "ROUNDABOUT", "DRIVEWAY"],
    "ALIGNMENT": ["STRAIGHT", "CURVE"],
    "ROADWAY_SURFACE_COND": ["UNKNOWN", "DRY", "WET", "ICE", "OTHER", "SNOW", "SAND/MUD/DIRT"],
    "ROAD_DEFECT": ["NO DEFECTS", "DEFECT", "UNKNOWN"],
    "REPORT_TYPE": ["NOT ON SCENE (DESK REPORT)", "ON SCENE", "UNKNOWN", "AMENDED"],
    "INTERSECTION_RELATED_I": ["UNKNOWN", "Y", "N"],
    "DAMAGE": ["OVER $1,500", "$501 - $1,500", "$500 OR LESS"],
    "PRIM_CONTRIBUTORY_CAUSE": ["BAD DRIVING SKILLS", "NOT APPLICABLE", "UNABLE TO DETERMINE",
                                "DISREGARDING TRAFFIC RULES", "OVERSPEEDING", "WEATHER", "DRINKING",
                                "VEHICLE CONDITION", "DISTRACTION", "OBSTRUCTION", "PHYSICAL CONDITION OF DRIVER",
                                "RELATED TO BUS STOP", "ROAD DEFECTS", "EVASIVE ACTION",
                                "PASSING STOPPED SCHOOL BUS", "TEXTING", "BICYCLE/MOTORCYCLE ON RED"],
    "SEC_CONTRIBUTORY_CAUSE": ["UNABLE TO DETERMINE", "NOT APPLICABLE", "BAD DRIVING SKILLS", "OVERSPEEDING",
                               "DISREGARDING TRAFFIC RULES", "WEATHER", "VEHICLE CONDITION", "DISTRACTION",
                               "OBSTRUCTION", "DRINKING", "RELATED TO BUS STOP", "ROAD DEFECTS",
                               "PHYSICAL CONDITION OF DRIVER", "EVASIVE ACTION", "TEXTING",
                               "BICYCLE/MOTORCYCLE ON RED", "PASSING STOPPED SCHOOL BUS"],
    "CRASH_TIME_OF_DAY": ["Morning", "Afternoon", "Evening", "Night"],
}

# ---- fixed values: day and month lists of the scoring form ----
FORM_DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
FORM_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]

# ---- fixed values: risk-factor rule thresholds and texts ----
RISKY_CAUSES = ["DRINKING", "OVERSPEEDING", "DISTRACTION", "TEXTING"]
GOOD_SURFACES = ["DRY", "UNKNOWN"]


def display_name(mapping: dict, c) -> Column:
    return map_lookup(mapping, c)


def risk_band(score, p50: Column, p75: Column, p90: Column, zero_is_no_data: bool = False) -> Column:
    """Critical >= p90, High >= p75, Medium >= p50, else Low; null (and 0 if asked) -> No Data."""
    s = col_(score)
    no_data = s.isNull() | (s == 0) if zero_is_no_data else s.isNull()
    return (
        F.when(no_data, "No Data")
        .when(s >= p90, "Critical")
        .when(s >= p75, "High")
        .when(s >= p50, "Medium")
        .otherwise("Low")
    )


def severity_class(fatal="fatal", serious="serious", moderate="moderate") -> Column:
    """Fatal if fatal > 0, Injury if serious/moderate > 0, else Property (nulls compare false)."""
    f, s, m = col_(fatal), col_(serious), col_(moderate)
    return (
        F.when(F.coalesce(f > 0, F.lit(False)), "Fatal")
        .when(F.coalesce(s > 0, F.lit(False)) | F.coalesce(m > 0, F.lit(False)), "Injury")
        .otherwise("Property")
    )


def date_label(month, day_of_week, hour, day_base: int = 0) -> Column:
    """'Mon Day HH:00'; out-of-range month/day or null parts -> 'Invalid Date'.

    ``day_base`` is the day code that means Monday (0 as the dashboard uses).
    """
    months = F.array(*[F.lit(m) for m in MONTH_NAMES])
    days = F.array(*[F.lit(d) for d in DAY_NAMES])
    m_idx = col_(month).cast("int")
    d_idx = col_(day_of_week).cast("int") - day_base
    m_name = F.when((m_idx >= 1) & (m_idx <= 12), F.get(months, m_idx - 1))
    d_name = F.when((d_idx >= 0) & (d_idx <= 6), F.get(days, d_idx))
    hh = F.lpad(col_(hour).cast("int").cast("string"), 2, "0")
    return F.coalesce(F.concat(m_name, F.lit(" "), d_name, F.lit(" "), hh, F.lit(":00")), F.lit("Invalid Date"))


def preventive_measure(feature) -> Column:
    return map_lookup(PREVENTIVE_MEASURES, feature, PREVENTIVE_MEASURES["DEFAULT"])


def injury_flag(label) -> Column:
    """True for the injury outcome: the label does not name 'NO INJURY'."""
    return ~F.upper(col_(label)).contains("NO INJURY")


def vocab_encode(c: str, vocab=None) -> Column:
    """0-based list position of the value in the scoring vocabulary (-1 if absent)."""
    vocab = vocab or FEATURE_VOCAB[c]
    return (F.array_position(F.array(*[F.lit(v) for v in vocab]), F.col(c)) - 1).cast("int")


def form_code(c, names: list[str]) -> Column:
    """1-based place of a name in one of the form's lists; null for other names."""
    at = F.array_position(F.array(*[F.lit(n) for n in names]), col_(c)).cast("int")
    return F.when(at > 0, at)


def risk_factors(speed="POSTED_SPEED_LIMIT", weather="WEATHER_CONDITION", lighting="LIGHTING_CONDITION",
                 surface="ROADWAY_SURFACE_COND", cause="PRIM_CONTRIBUTORY_CAUSE", units="NUM_UNITS",
                 hour="CRASH_HOUR") -> Column:
    """Ordered list of the rule-based risk factors that apply to a request row."""
    sp, we, li, su, ca, un, hr = (col_(c) for c in (speed, weather, lighting, surface, cause, units, hour))
    rules = [
        F.when(sp >= 40, F.lit("High speed zone (≥40 mph)")),
        F.when(we != "CLEAR", F.concat(F.lit("Adverse weather: "), we)),
        F.when(li.contains("DARKNESS"), F.lit("Low visibility (darkness)")),
        F.when(~su.isin(GOOD_SURFACES), F.concat(F.lit("Poor surface: "), su)),
        F.when(ca.isin(RISKY_CAUSES), F.concat(F.lit("Dangerous behavior: "), ca)),
        F.when(un >= 3, F.concat(F.lit("Multiple vehicles ("), un.cast("string"), F.lit(")"))),
        F.when((hr >= 22) | (hr <= 5), F.lit("Late night hours")),
    ]
    return F.array_compact(F.array(*rules))
