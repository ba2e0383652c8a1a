"""Shared pipeline stages for the registered queries (Spark side).

raw crashes -> clean -> points -> spatial join to areas -> crash severity.
Each stage is a lazy DataFrame; Catalyst prunes the columns a query does not
use all the way down to the ``orders`` scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_crashes, crash_points
from ..operators.risk import community_risk, crash_severity
from ..operators.spatial import load_community_areas, spatial_join
from ..sources.fixture import ingest, load_areas, load_crashes


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_crashes(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_crashes(raw(spark, sf_dir), extra_columns=("crash_id",))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crash_points(clean(spark, sf_dir))


def areas(spark: SparkSession) -> DataFrame:
    return load_community_areas(load_areas(spark))


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial_join(points(spark, sf_dir), areas(spark))


def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crash_severity(joined(spark, sf_dir))


def dashboard_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash table as the dashboards use it: lower-case aliases and a constant year."""
    df = joined(spark, sf_dir)
    return df.withColumns({
        "crash_hour": F.col("CRASH_HOUR"), "crash_day_of_week": F.col("CRASH_DAY_OF_WEEK"),
        "crash_month": F.col("CRASH_MONTH"), "crash_year": F.lit(2023),
        "fatal": F.col("INJURIES_FATAL"), "serious": F.col("INJURIES_INCAPACITATING"),
        "moderate": F.col("INJURIES_NON_INCAPACITATING"), "minor": F.col("INJURIES_REPORTED_NOT_EVIDENT"),
        "none": F.col("INJURIES_NO_INDICATION"),
    })


def community(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community_risk(severity(spark, sf_dir))


def stored_community(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area risk table, written once per source: bands and thresholds read its 77 rows several times."""
    return ingest(spark, f"{sf_dir}/orders.parquet", "community", lambda: community(spark, sf_dir), n_files=1)


def areas_with_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area table left-joined to the risk table on differently named keys."""
    from ..operators.spatial import find_area_key
    a = areas(spark).select("community_area_number", "community", "rings", "geom_type").withColumnRenamed(
        "community_area_number", "area_num_1")
    key = find_area_key(a.columns)  # the boundary table's own key name
    r = stored_community(spark, sf_dir)  # 77 rows (spine-bounded): broadcast
    return a.join(F.broadcast(r), a[key] == r["community_area_number"], "left")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model feature table, written once per source."""
    from ..operators.features import feature_table
    return ingest(spark, f"{sf_dir}/orders.parquet", "features", lambda: feature_table(raw(spark, sf_dir)))


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with its stratified test flag, written once per source."""
    from ..operators.sampling import stratified_split
    from ..schemas import TARGET
    return ingest(spark, f"{sf_dir}/orders.parquet", "split", lambda: stratified_split(features(spark, sf_dir), TARGET, "crash_id"))


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash severity rows with DBSCAN hotspot labels (per community area), written once per source."""
    from ..operators.dbscan import dbscan
    return ingest(spark, f"{sf_dir}/orders.parquet", "clustered", lambda: dbscan(severity(spark, sf_dir)))
