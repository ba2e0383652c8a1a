"""Edge semantics: coercion, severity, bands, hours, date labels, filters."""

from pyspark.sql import functions as F

from roadrisk.functions.core import coerce_double, weighted_severity
from roadrisk.functions.labels import date_label, risk_band, risk_factors, vocab_encode
from roadrisk.functions.recode import time_of_day
from roadrisk.operators import dashboard as D
from roadrisk.operators.risk import community_risk, quantile_thresholds, with_risk_band


def test_coerce_double(spark):
    df = spark.createDataFrame([("41.5",), (" 41.5 ",), ("abc",), ("",), ("NaN",), (None,), ("0",)], "v string")
    got = [r[0] for r in df.select(coerce_double("v")).collect()]
    assert got == [41.5, 41.5, None, None, None, None, 0.0]


def test_weighted_severity_edges(spark):
    rows = [(0, 0, 0, 0, 0), (1, 0, 0, None, 0), (0, 0, 0, 0, 3), (2, 0, 0, 0, 0), (1, 1, 1, 1, 1)]
    df = spark.createDataFrame(rows, "f int, s int, m int, mi int, n int")
    got = [r[0] for r in df.select(weighted_severity("f", "s", "m", "mi", "n")).collect()]
    assert got == [0.0, 0.0, 0.0, 3.0, 6.5 / 5]


def test_community_risk_all_null_group_and_spine(spark):
    rows = [(1, 1, 0, 0, None, 1), (1, 0, 0, 0, None, 0), (None, 1, 1, 1, 1, 1), (99, 1, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "community_area_number int, INJURIES_FATAL int, INJURIES_INCAPACITATING int, "
                                     "INJURIES_NON_INCAPACITATING int, INJURIES_REPORTED_NOT_EVIDENT int, "
                                     "INJURIES_NO_INDICATION int")
    out = {r["community_area_number"]: r for r in community_risk(df).collect()}
    assert len(out) == 77 and 99 not in out
    assert out[1]["total_crashes"] == 2 and out[1]["minor"] == 0 and out[1]["fatal"] == 1
    assert out[2]["total_crashes"] == 0 and out[2]["risk_index"] == 0.0 and out[2]["mean_weighted_severity"] == 0.0


def test_quantile_bands_linear_interpolation(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 5)] + [(None,)], "mean_weighted_severity double")
    th = quantile_thresholds(df).first()
    assert (round(th["p50"], 6), round(th["p75"], 6), round(th["p90"], 6)) == (1.5, 2.75, 4.1)
    bands = [r["risk_category"] for r in with_risk_band(df, zero_is_no_data=True).orderBy("mean_weighted_severity").collect()]
    assert bands == ["No Data", "No Data", "Low", "Medium", "Critical"]


def test_risk_band_ties(spark):
    df = spark.createDataFrame([(1.0,)] * 4, "s double")
    got = {r[0] for r in df.select(risk_band("s", F.lit(1.0), F.lit(1.0), F.lit(1.0))).collect()}
    assert got == {"Critical"}


def test_time_of_day_boundaries(spark):
    hours = [4, 5, 11, 12, 16, 17, 20, 21, 0, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r[0] for r in df.select(time_of_day("h")).collect()]
    assert got == ["Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night", "Night", "Night"]


def test_date_label(spark):
    rows = [(1, 0, 7), (12, 6, 23), (0, 1, 5), (13, 1, 5), (3, 7, 5), (3, 1, None)]
    df = spark.createDataFrame(rows, "m int, d int, h int")
    got = [r[0] for r in df.select(date_label("m", "d", "h")).collect()]
    assert got == ["Jan Mon 07:00", "Dec Sun 23:00", "Invalid Date", "Invalid Date", "Invalid Date", "Invalid Date"]


def test_filter_elision_and_nulls(spark):
    rows = [(1, "RAIN", 0, 0, 0, 0, 0), (2, None, 1, 0, 0, 0, 0), (3, "CLEAR", 0, 1, 0, 0, 0)]
    df = spark.createDataFrame(rows, "crash_hour int, WEATHER_CONDITION string, fatal int, serious int, moderate int, "
                                     "minor int, none int")
    full = D.CrashFilter(weather=list(D.WEATHER_NAMES))
    assert D.apply_filters(df, full).count() == 3  # full domain in order -> no filter, null kept
    reordered = D.CrashFilter(weather=list(reversed(list(D.WEATHER_NAMES))))
    assert D.apply_filters(df, reordered).count() == 2  # reordered full list still filters (null dropped)
    assert D.apply_filters(df, D.CrashFilter(weather=[])).count() == 3
    assert D.apply_filters(df, D.CrashFilter(severity=["Fatal", "Injury"])).count() == 2
    st = D.filter_statistics(df, D.CrashFilter(hours=[1])).first()
    assert st["filtered_count"] == 1 and st["total_count"] == 3 and st["fatal_total"] == 1


def test_risk_factors_and_vocab(spark):
    df = spark.createDataFrame([(45, "RAIN", "DARKNESS", "WET", "TEXTING", 3, 23), (20, "CLEAR", "DAYLIGHT", "DRY", "WEATHER", 1, 12)],
                               "POSTED_SPEED_LIMIT int, WEATHER_CONDITION string, LIGHTING_CONDITION string, "
                               "ROADWAY_SURFACE_COND string, PRIM_CONTRIBUTORY_CAUSE string, NUM_UNITS int, CRASH_HOUR int")
    got = [r[0] for r in df.select(risk_factors()).collect()]
    assert len(got[0]) == 7 and got[1] == []
    codes = [r[0] for r in df.select(vocab_encode("WEATHER_CONDITION")).collect()]
    assert codes == [1, 0]
