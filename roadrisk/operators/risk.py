"""Severity scores, risk tables, quantile bands, rankings and summaries.

Aggregations are plain ``groupBy().agg()``: partial (map-side) aggregation runs
before the shuffle, so a hot area or cluster costs one row per partition in
the exchange, never a collected group. Scalar statistics (quantile thresholds)
are one-row aggregates joined back as a broadcast scalar, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import sum0, weighted_severity
from ..functions.labels import BAND_ORDER, risk_band
from ..schemas import SEVERITY_COLUMNS, require_columns

N_COMMUNITY_AREAS = 77
RISK_SUMS = ["fatal", "serious", "moderate", "minor", "none"]


def crash_severity(df: DataFrame) -> DataFrame:
    """Add the crash-level ``weighted_severity`` score."""
    require_columns(df, SEVERITY_COLUMNS, "injury")
    return df.withColumn("weighted_severity", weighted_severity(*SEVERITY_COLUMNS))


def _risk_sums() -> list[Column]:
    return [sum0(c).alias(a) for c, a in zip(SEVERITY_COLUMNS, RISK_SUMS)]


def risk_index(prefix: str = "") -> Column:
    """Group score from the five sums (fatal, serious, moderate, minor, none)."""
    return weighted_severity(*[f"{prefix}{c}" for c in RISK_SUMS])


def community_risk(crashes: DataFrame, area_col: str = "community_area_number",
                   n_areas: int = N_COMMUNITY_AREAS) -> DataFrame:
    """Per-area totals, injury sums, mean crash score and risk index for areas 1..n.

    Every area of the spine appears (zero-filled); crashes with a null or
    unknown area are left out before the aggregation, which has at most n rows.
    """
    if area_col not in crashes.columns:
        raise KeyError(f"{area_col} column missing")
    if "weighted_severity" not in crashes.columns:
        crashes = crash_severity(crashes)
    area = F.col(area_col).cast("long")
    agg = crashes.filter(area.between(1, n_areas)).groupBy(area.alias("community_area_number")).agg(
        F.count(F.lit(1)).alias("total_crashes"), *_risk_sums(),
        F.avg("weighted_severity").alias("mean_weighted_severity"),
    )
    spine = crashes.sparkSession.range(1, n_areas + 1, numPartitions=1).withColumnRenamed("id", "community_area_number")
    out = spine.join(agg, "community_area_number", "left")
    out = out.fillna(0, subset=["total_crashes", *RISK_SUMS]).fillna(0.0, subset=["mean_weighted_severity"])
    return out.withColumn("risk_index", risk_index())


def cluster_risk(clustered: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Per-cluster totals and sums with ``weighted_score``; noise (-1) excluded."""
    if cluster_col not in clustered.columns:
        raise KeyError(f"{cluster_col} column missing")
    agg = clustered.filter(F.col(cluster_col) >= 0).groupBy(F.col(cluster_col).alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("total_crashes"), *_risk_sums()
    )
    return agg.withColumn("weighted_score", risk_index())


def cluster_severity(clustered: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Per-cluster size, five injury sums and weighted score (hotspot report layout)."""
    names = ["sum_fatal", "sum_incapacitating", "sum_non_incapacitating", "sum_reported_not_evident", "sum_no_indication"]
    agg = clustered.filter(F.col(cluster_col) >= 0).groupBy(F.col(cluster_col).alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("total_crashes"), *[sum0(c).alias(n) for c, n in zip(SEVERITY_COLUMNS, names)]
    )
    return agg.withColumn("weighted_score", weighted_severity(*names))


def cluster_centroids(clustered: DataFrame, cluster_col: str = "cluster_id", x: str = "lon", y: str = "lat") -> DataFrame:
    """Mean position and size per cluster (noise excluded); empty input gives an empty table."""
    return clustered.filter(F.col(cluster_col) >= 0).groupBy(F.col(cluster_col).alias("cluster_id")).agg(
        F.avg(x).alias("centroid_lon"), F.avg(y).alias("centroid_lat"), F.count(F.lit(1)).alias("num_points")
    )


def quantile_thresholds(df: DataFrame, score: str = "mean_weighted_severity") -> DataFrame:
    """One row: exact linear-interpolation quantiles p50/p75/p90 of the non-null scores."""
    from .profile import percentiles
    q = percentiles(df, score, [0.5, 0.75, 0.9], ["p50", "p75", "p90"])
    return q.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("p50", "p75", "p90")])


def with_risk_band(df: DataFrame, score: str = "mean_weighted_severity", out: str = "risk_category",
                   thresholds: DataFrame | None = None, zero_is_no_data: bool = False) -> DataFrame:
    """Attach a quantile band; thresholds are a broadcast one-row table (scalar join)."""
    th = thresholds if thresholds is not None else quantile_thresholds(df, score)
    # one-row scalar side, attached by a broadcast equi-join on a constant key
    j = df.withColumn("_one", F.lit(1)).join(F.broadcast(th.withColumn("_one", F.lit(1))), "_one")
    return j.withColumn(out, risk_band(score, F.col("p50"), F.col("p75"), F.col("p90"), zero_is_no_data)).drop(
        "p50", "p75", "p90", "_one"
    )


def band_distribution(banded: DataFrame, band: str = "risk_category") -> DataFrame:
    """Count per band in fixed order; absent bands give a null count (reindex semantics)."""
    spine = banded.sparkSession.createDataFrame([(b, i) for i, b in enumerate(BAND_ORDER)], "risk_category string, band_order int")
    counts = banded.groupBy(F.col(band).alias("risk_category")).agg(F.count(F.lit(1)).alias("areas"))
    return spine.join(F.broadcast(counts), "risk_category", "left").select("band_order", "risk_category", "areas")


def top_k(df: DataFrame, by: str, k: int = 10, ascending: bool = False, tie: str | list[str] = None) -> DataFrame:
    """Ordered top-k with an explicit tie-break key (TakeOrderedAndProject)."""
    ties = [tie] if isinstance(tie, str) else list(tie or [])
    o = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(o, *[F.col(t).asc() for t in ties]).limit(k)
