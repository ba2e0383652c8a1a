"""Crash-shaped view over the supplied TPC-H-style tables.

No crash extract ships with the test data, so every registered query reads a
crash table derived row-for-row from ``orders`` (one crash per order) and the
77 rectangular community areas laid on a 7 x 11 grid. The derivation is
deterministic integer arithmetic, so Spark and DuckDB produce identical rows;
coordinates are formed in integer micro-degrees before the one division.

``crashes_from_orders`` is the Spark form; ``CRASHES_CTE``/``AREAS_CTE`` are
the same definition as SQL text for the DuckDB oracle.

Edge cases built in: unparsable latitude (k % 101), null coordinates (k % 97),
both zero (k % 103), longitude only zero (k % 107), all environment columns
null (k % 109), null injury count (k % 113), a point outside every area
(k % 127), a dense spot per area (k % 3 = 0), unparsable date (k % 131).
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_AREAS = 77
FILE_BYTES = 4 << 20  # an ingested table has a file for so many bytes of its source


def _pick_sql(values, h: str, env_null: bool = False) -> str:
    """Value number (h % n) of a literal list; same rows as a CASE chain on h % n."""
    lits = ", ".join("CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    e = f"element_at(array({lits}), CAST({h} % {len(values)} + 1 AS INT))"
    return f"CASE WHEN k % 109 = 0 THEN CAST(NULL AS STRING) ELSE {e} END" if env_null else e


def _ts_sql_spark(h: str, mi: str) -> str:
    return (
        "concat(lpad(CAST(month(od) AS STRING), 2, '0'), '/', lpad(CAST(day(od) AS STRING), 2, '0'), '/', "
        f"CAST(year(od) AS STRING), ' ', lpad(CAST(CASE WHEN ({h}) % 12 = 0 THEN 12 ELSE ({h}) % 12 END AS STRING), 2, '0'), "
        f"':', lpad(CAST({mi} AS STRING), 2, '0'), ':00 ', CASE WHEN ({h}) < 12 THEN 'AM' ELSE 'PM' END)"
    )


def crashes_from_orders(orders: DataFrame) -> DataFrame:
    """Raw crash table (strings for coordinates/dates) derived from ``orders``.

    Built from SQL expression strings so the driver sends three plan steps to
    the JVM instead of hundreds of column objects.
    """
    b = orders.selectExpr(
        "o_orderkey AS k", "o_custkey % 77 + 1 AS a", "o_orderdate AS od",
        "(o_orderkey * 7919) % 10007 AS h1", "(o_orderkey * 104729) % 10009 AS h2",
        "(o_orderkey * 1299709) % 10037 AS h3",
    )
    g = b.selectExpr(
        "*", "41650000 + 35000 * ((a - 1) DIV 7) AS lat0", "-87850000 + 45000 * ((a - 1) % 7) AS lon0")
    p = g.selectExpr(
        "*",
        "(CASE WHEN k % 3 = 0 THEN lat0 + 17500 + (h1 % 200 - 100) * 10 ELSE lat0 + 1000 + h1 * 3 END"
        " + CASE WHEN k % 127 = 0 THEN 5000000 ELSE 0 END) / 1e6 AS lat",
        "(CASE WHEN k % 3 = 0 THEN lon0 + 22500 + (h2 % 200 - 100) * 10 ELSE lon0 + 1000 + h2 * 4 END) / 1e6 AS lon",
    )
    inj = "CASE WHEN h1 % 211 = 0 THEN 1 ELSE 0 END", "CASE WHEN h2 % 37 = 0 THEN 1 ELSE 0 END", \
        "CASE WHEN h3 % 11 = 0 THEN 2 ELSE 0 END"
    return p.selectExpr(
        "k AS crash_id",
        "concat('CR', lpad(CAST(k AS STRING), 10, '0')) AS CRASH_RECORD_ID",
        f"CASE WHEN k % 131 = 0 THEN 'not a date' ELSE {_ts_sql_spark('h1 % 24', 'h3 % 60')} END AS CRASH_DATE",
        f"{_ts_sql_spark('(h1 + 1) % 24', 'h2 % 60')} AS DATE_POLICE_NOTIFIED",
        "CASE WHEN k % 97 = 0 THEN NULL WHEN k % 101 = 0 THEN 'bad' WHEN k % 103 = 0 THEN '0'"
        " ELSE CAST(lat AS STRING) END AS LATITUDE",
        "CASE WHEN k % 97 = 0 THEN NULL WHEN k % 103 = 0 OR k % 107 = 0 THEN '0' ELSE CAST(lon AS STRING) END AS LONGITUDE",
        "CAST(h1 % 24 AS INT) AS CRASH_HOUR", "CAST(1 + h2 % 7 AS INT) AS CRASH_DAY_OF_WEEK",
        "CAST(month(od) AS INT) AS CRASH_MONTH", "CAST(5 * (h3 % 15) AS INT) AS POSTED_SPEED_LIMIT",
        "CAST(1 + h2 % 4 AS INT) AS NUM_UNITS",
        _pick_sql(["RAIN", "CLOUDY/OVERCAST", "FREEZING RAIN/DRIZZLE", "SLEET/HAIL", "CLEAR", "CLEAR"], "h1", True)
        + " AS WEATHER_CONDITION",
        _pick_sql(["DARKNESS", "DAWN", "DARKNESS, LIGHTED ROAD", "DAYLIGHT"], "h2", True) + " AS LIGHTING_CONDITION",
        _pick_sql(["WET", "SNOW OR SLUSH", "DRY", "DRY"], "h3", True) + " AS ROADWAY_SURFACE_COND",
        _pick_sql(["YIELD", "TRAFFIC SIGNAL", "NO CONTROLS", "NO CONTROLS", "NO CONTROLS"], "h1", True)
        + " AS TRAFFIC_CONTROL_DEVICE",
        _pick_sql(["FUNCTIONING PROPERLY", "NO CONTROLS", "MISSING", "WORN REFLECTIVE MATERIAL", "UNKNOWN"], "h3", True)
        + " AS DEVICE_CONDITION",
        _pick_sql(["NOT DIVIDED", "T-INTERSECTION", "DIVIDED - W/MEDIAN BARRIER", "ONE-WAY", "UNKNOWN INTERSECTION TYPE",
                   "PARKING LOT", "FOUR WAY"], "h1", True) + " AS TRAFFICWAY_TYPE",
        _pick_sql(["STRAIGHT AND LEVEL", "STRAIGHT ON GRADE", "CURVE, LEVEL", "CURVE ON GRADE", "STRAIGHT ON HILLCREST",
                   "CURVE ON HILLCREST"], "h2", True) + " AS ALIGNMENT",
        _pick_sql(["NO DEFECTS", "RUT, HOLES", "WORN SURFACE", "UNKNOWN", "DEBRIS ON ROADWAY", "NO DEFECTS"], "h3", True)
        + " AS ROAD_DEFECT",
        "CASE WHEN k % 89 = 0 THEN CAST(NULL AS STRING) ELSE "
        + _pick_sql(["ON SCENE", "NOT ON SCENE (DESK REPORT)", "AMENDED", "NOT ON SCENE(DESK REPORT)"], "h1")
        + " END AS REPORT_TYPE",
        _pick_sql(["$500 OR LESS", "$501 - $1,500", "OVER $1,500"], "h2") + " AS DAMAGE",
        _pick_sql(["TEXTING", "ANIMAL", "IMPROPER BACKING", "WEATHER", "WEATHER"], "h2") + " AS PRIM_CONTRIBUTORY_CAUSE",
        _pick_sql(["NOT APPLICABLE", "UNABLE TO DETERMINE", "FOLLOWING TOO CLOSELY", "DISREGARDING STOP SIGN",
                   "EXCEEDING SAFE SPEED FOR CONDITIONS", "CELL PHONE USE OTHER THAN TEXTING"], "h3")
        + " AS SEC_CONTRIBUTORY_CAUSE",
        _pick_sql(["Y", None, "N"], "h3") + " AS INTERSECTION_RELATED_I",
        _pick_sql(["REAR END", "ANGLE", "TURNING"], "h3") + " AS FIRST_CRASH_TYPE",
        "CASE WHEN h1 % 211 = 0 THEN 'FATAL' WHEN h2 % 37 = 0 THEN 'INCAPACITATING INJURY'"
        " WHEN h3 % 11 = 0 THEN 'NONINCAPACITATING INJURY' ELSE 'NO INDICATION OF INJURY' END AS MOST_SEVERE_INJURY",
        f"CAST({inj[0]} + {inj[1]} + {inj[2]} AS INT) AS INJURIES_TOTAL",
        f"CAST({inj[0]} AS INT) AS INJURIES_FATAL",
        f"CAST({inj[1]} AS INT) AS INJURIES_INCAPACITATING",
        f"CAST({inj[2]} AS INT) AS INJURIES_NON_INCAPACITATING",
        "CAST(CASE WHEN k % 113 = 0 THEN NULL WHEN h1 % 17 = 0 THEN 1 ELSE 0 END AS INT) AS INJURIES_REPORTED_NOT_EVIDENT",
        "CAST(h2 % 4 AS INT) AS INJURIES_NO_INDICATION",
        "CAST(0 AS INT) AS INJURIES_UNKNOWN",
        "CASE WHEN h1 % 211 = 0 OR h2 % 37 = 0 OR h3 % 11 = 0 OR h1 % 4 = 0 THEN 'INJURY AND / OR TOW DUE TO CRASH'"
        " ELSE 'NO INJURY / DRIVE AWAY' END AS CRASH_TYPE",
    )


def load_crashes(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """Crash table for a test-data folder, derived from ``orders.parquet``.

    With ``materialize`` the derived table is ingested once per source file
    into Parquet under the session's shared checkpoint folder and read from
    there, just as a crash CSV extract is ingested before analysis; every
    later query scans plain typed columns with filter pushdown.
    """
    src = f"{sf_dir}/orders.parquet"
    if not materialize:
        return crashes_from_orders(spark.read.parquet(src))
    def build() -> DataFrame:
        orders, held = spark.read.parquet(src), source_bytes(spark, src)
        if held > FILE_BYTES:  # the few columns of the source are dealt out, not the wide rows made of them
            orders = orders.select("o_orderkey", "o_custkey", "o_orderdate").repartition(_file_count(spark, held))
        return crashes_from_orders(orders)

    return ingest(spark, src, "crashes", build)


def source_bytes(spark: SparkSession, src: str) -> int:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(src)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def _file_count(spark: SparkSession, held: int) -> int:
    """At least one file per core so every later scan is parallel, more for a larger source."""
    return max(spark.sparkContext.defaultParallelism, -(-held // FILE_BYTES))


def ingest(spark: SparkSession, src: str, name: str, build, n_files: int | None = None) -> DataFrame:
    """Write ``build()`` once to ``<checkpoint dir>/ingest/<name>-<key>`` and read it back.

    The key covers the path, the number and size of its files, the latest
    modification below it and this package's own code with its parameters, so a
    changed source or a changed operator is ingested again. The table is written under a new
    name and renamed when complete; of two sessions that write at once, one renames
    and the other reads what is there. A table of a source of at most ``FILE_BYTES`` is dealt into a file
    for each core; rows of a larger one are not shuffled again, they are written in the partitions that
    ``build`` leaves. ``n_files`` sets the number of files.
    """
    from ..session import ensure_checkpoint_dir

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_path = jvm.org.apache.hadoop.fs.Path(src)
    fs = src_path.getFileSystem(conf)
    held = fs.getContentSummary(src_path)
    files, latest = fs.listFiles(src_path, True), fs.getFileStatus(src_path).getModificationTime()
    while files.hasNext():
        latest = max(latest, files.next().getModificationTime())
    where = fs.getFileStatus(src_path).getPath().toString()
    key = hashlib.md5(f"{where}|{held.getLength()}|{held.getFileCount()}|{latest}|{_code_version()}".encode()).hexdigest()[:16]
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest/{name}-{key}"
    done, out_path = (jvm.org.apache.hadoop.fs.Path(p) for p in (out + "/_SUCCESS", out))
    shared = done.getFileSystem(conf)
    if not shared.exists(done):
        df = build()
        # asking ``df.rdd`` for its partitions would run every shuffle before the write does
        if n_files is None:
            n_files = _file_count(spark, held.getLength()) if held.getLength() <= FILE_BYTES else 0
        new = f"{out}-{uuid.uuid4().hex[:12]}"
        (df.repartition(n_files) if n_files else df).write.parquet(new)
        if not shared.exists(done) and not shared.rename(jvm.org.apache.hadoop.fs.Path(new), out_path):
            return spark.read.parquet(new)
    return spark.read.parquet(out)


@functools.cache
def _code_version() -> str:
    """Checksum of the package's modules (text operators aside): tables written by other code are not read."""
    root = Path(__file__).resolve().parents[1]
    files = sorted(f for f in root.rglob("*.py") if "llm" not in f.relative_to(root).parts)
    return hashlib.md5(b"".join(f.read_bytes() for f in files)).hexdigest()


def load_areas(spark: SparkSession) -> DataFrame:
    """77 rectangular community areas in the raw boundary layout.

    Columns mimic a boundary export: ``area_num_1`` (int), ``community``
    (name), ``rings`` (ring 0 exterior, further rings holes) plus bounds.
    """
    a = F.col("id")
    row = F.expr("(id - 1) DIV 7")
    lat_lo = (41650000 + 35000 * row) / F.lit(1e6)
    lat_hi = (41685000 + 35000 * row) / F.lit(1e6)
    lon_lo = (-87850000 + 45000 * ((a - 1) % 7)) / F.lit(1e6)
    lon_hi = (-87805000 + 45000 * ((a - 1) % 7)) / F.lit(1e6)

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(pt(lon_lo, lat_lo), pt(lon_hi, lat_lo), pt(lon_hi, lat_hi), pt(lon_lo, lat_hi), pt(lon_lo, lat_lo))
    return spark.range(1, N_AREAS + 1, numPartitions=1).select(
        a.cast("int").alias("area_num_1"),
        F.concat(F.lit("AREA_"), a.cast("string")).alias("community"),
        F.array(ring).alias("rings"),
        F.lit("Polygon").alias("geom_type"),
    )


# --------------------------------------------------------------------------
# The same definitions as DuckDB SQL text (CTE list, no leading WITH).
# --------------------------------------------------------------------------

def _ts_sql(m: str, d: str, y: str, h: str, mi: str) -> str:
    return (
        f"concat(lpad(CAST({m} AS VARCHAR), 2, '0'), '/', lpad(CAST({d} AS VARCHAR), 2, '0'), '/', CAST({y} AS VARCHAR), ' ', "
        f"lpad(CAST(CASE WHEN ({h}) % 12 = 0 THEN 12 ELSE ({h}) % 12 END AS VARCHAR), 2, '0'), ':', "
        f"lpad(CAST({mi} AS VARCHAR), 2, '0'), ':00 ', CASE WHEN ({h}) < 12 THEN 'AM' ELSE 'PM' END)"
    )


CRASHES_CTE = f"""
fx_b AS (
  SELECT o_orderkey AS k, o_custkey % 77 + 1 AS a, o_orderdate AS od,
         (o_orderkey * 7919) % 10007 AS h1, (o_orderkey * 104729) % 10009 AS h2,
         (o_orderkey * 1299709) % 10037 AS h3
  FROM orders
), fx_g AS (
  SELECT fx_b.*, 41650000 + 35000 * CAST(floor((a - 1) / 7e0) AS BIGINT) AS lat0,
              -87850000 + 45000 * ((a - 1) % 7) AS lon0 FROM fx_b
), fx_p AS (
  SELECT fx_g.*,
    (CASE WHEN k % 3 = 0 THEN lat0 + 17500 + (h1 % 200 - 100) * 10
          ELSE lat0 + 1000 + h1 * 3 END + CASE WHEN k % 127 = 0 THEN 5000000 ELSE 0 END) / 1e6 AS lat,
    (CASE WHEN k % 3 = 0 THEN lon0 + 22500 + (h2 % 200 - 100) * 10
          ELSE lon0 + 1000 + h2 * 4 END) / 1e6 AS lon
  FROM fx_g
), crashes AS (
SELECT k AS crash_id,
  concat('CR', lpad(CAST(k AS VARCHAR), 10, '0')) AS CRASH_RECORD_ID,
  CASE WHEN k % 131 = 0 THEN 'not a date' ELSE {_ts_sql('month(od)', 'day(od)', 'year(od)', 'h1 % 24', 'h3 % 60')} END AS CRASH_DATE,
  {_ts_sql('month(od)', 'day(od)', 'year(od)', '(h1 + 1) % 24', 'h2 % 60')} AS DATE_POLICE_NOTIFIED,
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 101 = 0 THEN 'bad' WHEN k % 103 = 0 THEN '0'
       ELSE CAST(lat AS VARCHAR) END AS LATITUDE,
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 103 = 0 OR k % 107 = 0 THEN '0'
       ELSE CAST(lon AS VARCHAR) END AS LONGITUDE,
  CAST(h1 % 24 AS INT) AS CRASH_HOUR, CAST(1 + h2 % 7 AS INT) AS CRASH_DAY_OF_WEEK,
  CAST(month(od) AS INT) AS CRASH_MONTH,
  CAST(5 * (h3 % 15) AS INT) AS POSTED_SPEED_LIMIT, CAST(1 + h2 % 4 AS INT) AS NUM_UNITS,
  CASE WHEN k % 109 = 0 THEN NULL WHEN h1 % 6 = 0 THEN 'RAIN' WHEN h1 % 6 = 1 THEN 'CLOUDY/OVERCAST'
       WHEN h1 % 6 = 2 THEN 'FREEZING RAIN/DRIZZLE' WHEN h1 % 6 = 3 THEN 'SLEET/HAIL' ELSE 'CLEAR' END AS WEATHER_CONDITION,
  CASE WHEN k % 109 = 0 THEN NULL WHEN h2 % 4 = 0 THEN 'DARKNESS' WHEN h2 % 4 = 1 THEN 'DAWN'
       WHEN h2 % 4 = 2 THEN 'DARKNESS, LIGHTED ROAD' ELSE 'DAYLIGHT' END AS LIGHTING_CONDITION,
  CASE WHEN k % 109 = 0 THEN NULL WHEN h3 % 4 = 0 THEN 'WET' WHEN h3 % 4 = 1 THEN 'SNOW OR SLUSH' ELSE 'DRY' END AS ROADWAY_SURFACE_COND,
  CASE WHEN k % 109 = 0 THEN NULL WHEN h1 % 5 = 0 THEN 'YIELD' WHEN h1 % 5 = 1 THEN 'TRAFFIC SIGNAL' ELSE 'NO CONTROLS' END AS TRAFFIC_CONTROL_DEVICE,
  CASE WHEN k % 109 = 0 THEN NULL WHEN h3 % 5 = 0 THEN 'FUNCTIONING PROPERLY' WHEN h3 % 5 = 1 THEN 'NO CONTROLS'
       WHEN h3 % 5 = 2 THEN 'MISSING' WHEN h3 % 5 = 3 THEN 'WORN REFLECTIVE MATERIAL' ELSE 'UNKNOWN' END AS DEVICE_CONDITION,
  CASE WHEN k % 109 = 0 THEN NULL WHEN h1 % 7 = 0 THEN 'NOT DIVIDED' WHEN h1 % 7 = 1 THEN 'T-INTERSECTION'
       WHEN h1 % 7 = 2 THEN 'DIVIDED - W/MEDIAN BARRIER' WHEN h1 % 7 = 3 THEN 'ONE-WAY'
       WHEN h1 % 7 = 4 THEN 'UNKNOWN INTERSECTION TYPE' WHEN h1 % 7 = 5 THEN 'PARKING LOT' ELSE 'FOUR WAY' END AS TRAFFICWAY_TYPE,
  CASE WHEN k % 109 = 0 THEN NULL WHEN h2 % 6 = 0 THEN 'STRAIGHT AND LEVEL' WHEN h2 % 6 = 1 THEN 'STRAIGHT ON GRADE'
       WHEN h2 % 6 = 2 THEN 'CURVE, LEVEL' WHEN h2 % 6 = 3 THEN 'CURVE ON GRADE'
       WHEN h2 % 6 = 4 THEN 'STRAIGHT ON HILLCREST' ELSE 'CURVE ON HILLCREST' END AS ALIGNMENT,
  CASE WHEN k % 109 = 0 THEN NULL WHEN h3 % 6 = 0 THEN 'NO DEFECTS' WHEN h3 % 6 = 1 THEN 'RUT, HOLES'
       WHEN h3 % 6 = 2 THEN 'WORN SURFACE' WHEN h3 % 6 = 3 THEN 'UNKNOWN'
       WHEN h3 % 6 = 4 THEN 'DEBRIS ON ROADWAY' ELSE 'NO DEFECTS' END AS ROAD_DEFECT,
  CASE WHEN k % 89 = 0 THEN NULL WHEN h1 % 4 = 0 THEN 'ON SCENE' WHEN h1 % 4 = 1 THEN 'NOT ON SCENE (DESK REPORT)'
       WHEN h1 % 4 = 2 THEN 'AMENDED' ELSE 'NOT ON SCENE(DESK REPORT)' END AS REPORT_TYPE,
  CASE WHEN h2 % 3 = 0 THEN '$500 OR LESS' WHEN h2 % 3 = 1 THEN '$501 - $1,500' ELSE 'OVER $1,500' END AS DAMAGE,
  CASE WHEN h2 % 5 = 0 THEN 'TEXTING' WHEN h2 % 5 = 1 THEN 'ANIMAL' WHEN h2 % 5 = 2 THEN 'IMPROPER BACKING' ELSE 'WEATHER' END AS PRIM_CONTRIBUTORY_CAUSE,
  CASE WHEN h3 % 6 = 0 THEN 'NOT APPLICABLE' WHEN h3 % 6 = 1 THEN 'UNABLE TO DETERMINE'
       WHEN h3 % 6 = 2 THEN 'FOLLOWING TOO CLOSELY' WHEN h3 % 6 = 3 THEN 'DISREGARDING STOP SIGN'
       WHEN h3 % 6 = 4 THEN 'EXCEEDING SAFE SPEED FOR CONDITIONS' ELSE 'CELL PHONE USE OTHER THAN TEXTING' END AS SEC_CONTRIBUTORY_CAUSE,
  CASE WHEN h3 % 3 = 0 THEN 'Y' WHEN h3 % 3 = 1 THEN NULL ELSE 'N' END AS INTERSECTION_RELATED_I,
  CASE WHEN h3 % 3 = 0 THEN 'REAR END' WHEN h3 % 3 = 1 THEN 'ANGLE' ELSE 'TURNING' END AS FIRST_CRASH_TYPE,
  CASE WHEN h1 % 211 = 0 THEN 'FATAL' WHEN h2 % 37 = 0 THEN 'INCAPACITATING INJURY'
       WHEN h3 % 11 = 0 THEN 'NONINCAPACITATING INJURY' ELSE 'NO INDICATION OF INJURY' END AS MOST_SEVERE_INJURY,
  CAST(CASE WHEN h1 % 211 = 0 THEN 1 ELSE 0 END + CASE WHEN h2 % 37 = 0 THEN 1 ELSE 0 END
       + CASE WHEN h3 % 11 = 0 THEN 2 ELSE 0 END AS INT) AS INJURIES_TOTAL,
  CAST(CASE WHEN h1 % 211 = 0 THEN 1 ELSE 0 END AS INT) AS INJURIES_FATAL,
  CAST(CASE WHEN h2 % 37 = 0 THEN 1 ELSE 0 END AS INT) AS INJURIES_INCAPACITATING,
  CAST(CASE WHEN h3 % 11 = 0 THEN 2 ELSE 0 END AS INT) AS INJURIES_NON_INCAPACITATING,
  CAST(CASE WHEN k % 113 = 0 THEN NULL WHEN h1 % 17 = 0 THEN 1 ELSE 0 END AS INT) AS INJURIES_REPORTED_NOT_EVIDENT,
  CAST(h2 % 4 AS INT) AS INJURIES_NO_INDICATION,
  CAST(0 AS INT) AS INJURIES_UNKNOWN,
  CASE WHEN h1 % 211 = 0 OR h2 % 37 = 0 OR h3 % 11 = 0 OR h1 % 4 = 0 THEN 'INJURY AND / OR TOW DUE TO CRASH'
       ELSE 'NO INJURY / DRIVE AWAY' END AS CRASH_TYPE
FROM fx_p
)"""

AREAS_CTE = """
areas AS (
SELECT CAST(a AS INT) AS area_num_1, concat('AREA_', CAST(a AS VARCHAR)) AS community,
  (41650000 + 35000 * CAST(floor((a - 1) / 7e0) AS BIGINT)) / 1e6 AS lat_lo,
  (41685000 + 35000 * CAST(floor((a - 1) / 7e0) AS BIGINT)) / 1e6 AS lat_hi,
  (-87850000 + 45000 * ((a - 1) % 7)) / 1e6 AS lon_lo,
  (-87805000 + 45000 * ((a - 1) % 7)) / 1e6 AS lon_hi
FROM range(1, 78) AS t(a)
)"""
