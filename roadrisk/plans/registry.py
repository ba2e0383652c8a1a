"""Registry of report queries: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ENV_COLUMNS, INJURY_COLUMNS_ALL, REQUIRED_COLUMNS
from ..sources.fixture import AREAS_CTE, CRASHES_CTE

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

DIGITS = 9


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (report precision; engines sum in different orders)."""
    return df.withColumns({
        f.name: F.round(F.col(f.name), digits) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)
    })


# --------------------------------------------------------------------------
# SQL side: the same stages as CTEs (DuckDB dialect).
# --------------------------------------------------------------------------

def _sev_sql(f, s, m, mi, n) -> str:
    d = lambda c: f"CAST({c} AS DOUBLE)"
    num = f"(3 * {d(f)} + 2 * {d(s)} + 1 * {d(m)} + 0.5 * {d(mi)})"
    den = f"({d(f)} + {d(s)} + {d(m)} + {d(mi)} + {d(n)})"
    return f"CASE WHEN {den} > 0 THEN {num} / {den} ELSE 0.0 END"


STAGES_CTE = f"""
coerced AS (
  SELECT * REPLACE (
    CASE WHEN isnan(TRY_CAST(LATITUDE AS DOUBLE)) THEN NULL ELSE TRY_CAST(LATITUDE AS DOUBLE) END AS LATITUDE,
    CASE WHEN isnan(TRY_CAST(LONGITUDE AS DOUBLE)) THEN NULL ELSE TRY_CAST(LONGITUDE AS DOUBLE) END AS LONGITUDE)
  FROM crashes
), clean AS (
  SELECT crash_id, {", ".join(REQUIRED_COLUMNS)} FROM coerced
  WHERE LATITUDE BETWEEN -90 AND 90 AND LONGITUDE BETWEEN -180 AND 180
    AND LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL AND LATITUDE <> 0 AND LONGITUDE <> 0
    AND coalesce({", ".join(ENV_COLUMNS)}) IS NOT NULL
    AND NOT coalesce(({" + ".join(f"coalesce({c}, 0)" for c in INJURY_COLUMNS_ALL)}) = 0
                     AND CRASH_TYPE = 'NO INJURY / DRIVE AWAY', false)
), points AS (
  SELECT clean.*, LONGITUDE AS lon, LATITUDE AS lat FROM clean
  WHERE NOT (LATITUDE = 0 AND LONGITUDE = 0)
), joined AS (
  SELECT p.*, CAST(a.area_num_1 AS BIGINT) AS community_area_number, a.community,
         'Polygon' AS geom_type, a.community AS community_area_name
  FROM points p LEFT JOIN areas a
    ON p.lat > a.lat_lo AND p.lat < a.lat_hi AND p.lon > a.lon_lo AND p.lon < a.lon_hi
), severity AS (
  SELECT joined.*, {_sev_sql("INJURIES_FATAL", "INJURIES_INCAPACITATING", "INJURIES_NON_INCAPACITATING",
                             "INJURIES_REPORTED_NOT_EVIDENT", "INJURIES_NO_INDICATION")} AS weighted_severity
  FROM joined
), risk_agg AS (
  SELECT CAST(community_area_number AS BIGINT) AS community_area_number, count(*) AS total_crashes,
    CAST(coalesce(sum(INJURIES_FATAL), 0) AS BIGINT) AS fatal,
    CAST(coalesce(sum(INJURIES_INCAPACITATING), 0) AS BIGINT) AS serious,
    CAST(coalesce(sum(INJURIES_NON_INCAPACITATING), 0) AS BIGINT) AS moderate,
    CAST(coalesce(sum(INJURIES_REPORTED_NOT_EVIDENT), 0) AS BIGINT) AS minor,
    CAST(coalesce(sum(INJURIES_NO_INDICATION), 0) AS BIGINT) AS "none",
    avg(weighted_severity) AS mean_weighted_severity
  FROM severity GROUP BY 1
), community_risk AS (
  SELECT s.a AS community_area_number, coalesce(r.total_crashes, 0) AS total_crashes,
    coalesce(r.fatal, 0) AS fatal, coalesce(r.serious, 0) AS serious, coalesce(r.moderate, 0) AS moderate,
    coalesce(r.minor, 0) AS minor, coalesce(r."none", 0) AS "none",
    coalesce(r.mean_weighted_severity, 0.0) AS mean_weighted_severity,
    {_sev_sql("coalesce(r.fatal, 0)", "coalesce(r.serious, 0)", "coalesce(r.moderate, 0)", "coalesce(r.minor, 0)",
              'coalesce(r."none", 0)')} AS risk_index
  FROM (SELECT CAST(range AS BIGINT) AS a FROM range(1, 78)) s LEFT JOIN risk_agg r ON r.community_area_number = s.a
), dash AS (
  SELECT joined.*, CRASH_HOUR AS crash_hour, CRASH_DAY_OF_WEEK AS crash_day_of_week, CRASH_MONTH AS crash_month,
    2023 AS crash_year, INJURIES_FATAL AS fatal, INJURIES_INCAPACITATING AS serious,
    INJURIES_NON_INCAPACITATING AS moderate, INJURIES_REPORTED_NOT_EVIDENT AS minor, INJURIES_NO_INDICATION AS "none"
  FROM joined
), area_risk AS (
  SELECT a.area_num_1, a.community, 'Polygon' AS geom_type, r.*
  FROM areas a LEFT JOIN community_risk r ON CAST(a.area_num_1 AS BIGINT) = r.community_area_number
)"""


def sql(body: str, recursive: bool = False) -> str:
    """Full oracle statement: fixture views + shared stages as CTEs, then ``body``."""
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + CRASHES_CTE + "," + AREAS_CTE + "," + STAGES_CTE + "\n" + body


def sev_sql(*cols) -> str:
    return _sev_sql(*cols)
