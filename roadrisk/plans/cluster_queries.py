"""Registered queries: DBSCAN hotspots and the cluster tables built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dashboard as D
from ..operators import risk as R
from . import stages as S
from .registry import register, rounded, sev_sql, sql

_HAV = ("2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(y.la - x.la) / 2), 2) + cos(radians(x.la)) * "
        "cos(radians(y.la)) * pow(sin(radians(y.lo - x.lo) / 2), 2))))")

# DuckDB oracle: brute-force neighbour pairs (band join on latitude), core =
# >= 12 neighbours incl. self, components by recursive label propagation.
DBSCAN_CTE = f"""
, db_p AS MATERIALIZED (SELECT crash_id AS id, lat AS la, lon AS lo, community_area_number AS ar FROM severity),
db_nb AS MATERIALIZED (SELECT x.id AS i, y.id AS j FROM db_p x JOIN db_p y
  ON x.ar IS NOT DISTINCT FROM y.ar AND abs(x.la - y.la) < 0.0023 WHERE {_HAV} <= 250),
db_core AS MATERIALIZED (SELECT i FROM db_nb GROUP BY i HAVING count(*) >= 12),
db_e AS MATERIALIZED (SELECT i, j FROM db_nb WHERE i IN (SELECT i FROM db_core) AND j IN (SELECT i FROM db_core)),
db_r(i, l) AS (SELECT i, i FROM db_core UNION SELECT db_e.j, db_r.l FROM db_r JOIN db_e ON db_e.i = db_r.i WHERE db_r.l < db_e.j),
db_lab AS (SELECT i, min(l) AS l FROM db_r GROUP BY i),
db_border AS (SELECT nb.i, min(lab.l) AS l FROM db_nb nb JOIN db_lab lab ON nb.j = lab.i
  WHERE nb.i NOT IN (SELECT i FROM db_core) GROUP BY nb.i),
db_all AS (SELECT p.id, p.ar, coalesce(lab.l, b.l) AS l, lab.l IS NOT NULL AS is_core, lab.l AS core_label
  FROM db_p p LEFT JOIN db_lab lab ON lab.i = p.id LEFT JOIN db_border b ON b.i = p.id),
db_ids AS (SELECT ar, l, CAST(dense_rank() OVER (ORDER BY ar IS NULL, ar, l) - 1 AS BIGINT) AS cluster_id
  FROM (SELECT DISTINCT ar, l FROM db_all WHERE l IS NOT NULL)),
clustered AS (SELECT s.*, a.is_core, a.core_label, coalesce(db_ids.cluster_id, -1) AS cluster_id
  FROM severity s JOIN db_all a ON a.id = s.crash_id
  LEFT JOIN db_ids ON db_ids.ar IS NOT DISTINCT FROM a.ar AND db_ids.l = a.l),
c_sev AS (SELECT cluster_id, count(*) AS total_crashes,
  CAST(coalesce(sum(INJURIES_FATAL), 0) AS BIGINT) AS sum_fatal,
  CAST(coalesce(sum(INJURIES_INCAPACITATING), 0) AS BIGINT) AS sum_incapacitating,
  CAST(coalesce(sum(INJURIES_NON_INCAPACITATING), 0) AS BIGINT) AS sum_non_incapacitating,
  CAST(coalesce(sum(INJURIES_REPORTED_NOT_EVIDENT), 0) AS BIGINT) AS sum_reported_not_evident,
  CAST(coalesce(sum(INJURIES_NO_INDICATION), 0) AS BIGINT) AS sum_no_indication
  FROM clustered WHERE cluster_id >= 0 GROUP BY cluster_id),
c_risk AS (SELECT cluster_id, total_crashes, sum_fatal AS fatal, sum_incapacitating AS serious,
  sum_non_incapacitating AS moderate, sum_reported_not_evident AS minor, sum_no_indication AS "none",
  {sev_sql("sum_fatal", "sum_incapacitating", "sum_non_incapacitating", "sum_reported_not_evident", "sum_no_indication")}
  AS weighted_score FROM c_sev),
c_cent AS (SELECT cluster_id, avg(lon) AS centroid_lon, avg(lat) AS centroid_lat, count(*) AS num_points
  FROM clustered WHERE cluster_id >= 0 GROUP BY cluster_id)
"""


def dsql(body: str) -> str:
    return sql(DBSCAN_CTE + body, recursive=True)


_SEV_COLS = ("cluster_id, total_crashes, sum_fatal, sum_incapacitating, sum_non_incapacitating, "
             "sum_reported_not_evident, sum_no_indication, round(weighted_score, 9) AS weighted_score")
_SEV_SQL = (f"(SELECT *, {sev_sql('sum_fatal', 'sum_incapacitating', 'sum_non_incapacitating', 'sum_reported_not_evident', 'sum_no_indication')}"
            " AS weighted_score FROM c_sev)")


@register("dbscan", dsql("SELECT crash_id, cluster_id FROM clustered"))
def dbscan_q(spark, sf_dir):
    """SP5/SP6: per-area haversine DBSCAN (250 m, 12 points) -> cluster id or -1."""
    return S.clustered(spark, sf_dir).select("crash_id", "cluster_id")


@register("dbscan_core_labels", dsql("SELECT crash_id, core_label FROM clustered WHERE is_core"))
def dbscan_core_labels(spark, sf_dir):
    """SP5: core points and their component label (smallest core id)."""
    return S.clustered(spark, sf_dir).filter("is_core").select("crash_id", "core_label")


@register("cluster_summary", dsql(
    "SELECT count(DISTINCT CASE WHEN cluster_id >= 0 THEN cluster_id END) AS num_clusters, "
    "count_if(cluster_id = -1) AS noise_points FROM clustered"))
def cluster_summary(spark, sf_dir):
    """AG12: number of clusters and noise points."""
    c = S.clustered(spark, sf_dir)
    return c.agg(F.count_distinct(F.when(F.col("cluster_id") >= 0, F.col("cluster_id"))).alias("num_clusters"),
                 F.count_if(F.col("cluster_id") == -1).alias("noise_points"))


@register("cluster_sizes", dsql("SELECT cluster_id, count(*) AS size FROM clustered GROUP BY cluster_id"))
def cluster_sizes(spark, sf_dir):
    """AG13: size per label (noise included)."""
    return S.clustered(spark, sf_dir).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))


@register("cluster_centroids", dsql(
    "SELECT cluster_id, round(centroid_lon, 9) AS centroid_lon, round(centroid_lat, 9) AS centroid_lat, num_points FROM c_cent"))
def cluster_centroids(spark, sf_dir):
    """AG7: centroid and size per cluster."""
    return rounded(R.cluster_centroids(S.clustered(spark, sf_dir)))


@register("cluster_severity", dsql(f"SELECT {_SEV_COLS} FROM {_SEV_SQL}"))
def cluster_severity(spark, sf_dir):
    """AG8: hotspot severity table."""
    return rounded(R.cluster_severity(S.clustered(spark, sf_dir)))


@register("cluster_risk", dsql(
    "SELECT cluster_id, total_crashes, fatal, serious, moderate, minor, \"none\", round(weighted_score, 9) AS weighted_score FROM c_risk"))
def cluster_risk(spark, sf_dir):
    """AG10: cluster risk table (noise excluded)."""
    return rounded(R.cluster_risk(S.clustered(spark, sf_dir)))


@register("top_clusters", dsql(f"SELECT {_SEV_COLS} FROM {_SEV_SQL} ORDER BY weighted_score DESC, cluster_id LIMIT 10"))
def top_clusters(spark, sf_dir):
    """WI1: worst 10 clusters by severity score."""
    return rounded(R.top_k(R.cluster_severity(S.clustered(spark, sf_dir)), "weighted_score", 10, tie="cluster_id"))


@register("largest_clusters", dsql(f"SELECT {_SEV_COLS} FROM {_SEV_SQL} ORDER BY total_crashes DESC, cluster_id LIMIT 10"))
def largest_clusters(spark, sf_dir):
    """WI1: largest 10 clusters by crash count."""
    return rounded(R.top_k(R.cluster_severity(S.clustered(spark, sf_dir)), "total_crashes", 10, tie="cluster_id"))


@register("cluster_layer", dsql(
    "SELECT c.cluster_id, round(c.centroid_lon, 9) AS centroid_lon, round(c.centroid_lat, 9) AS centroid_lat, "
    "r.total_crashes, round(r.weighted_score, 9) AS weighted_score, round(sqrt(r.total_crashes) * 2, 9) AS marker_size "
    "FROM c_cent c LEFT JOIN c_risk r USING (cluster_id)"))
def cluster_layer(spark, sf_dir):
    """SP11 + JO4 + SC15: cluster markers: centroid left-joined to cluster risk, size sqrt(n)*2."""
    c = S.clustered(spark, sf_dir)
    return rounded(D.cluster_layer(R.cluster_centroids(c), R.cluster_risk(c)))


@register("centroid_head", dsql(
    "SELECT cluster_id, round(centroid_lon, 9) AS centroid_lon, round(centroid_lat, 9) AS centroid_lat FROM c_cent "
    "ORDER BY cluster_id LIMIT 10"))
def centroid_head(spark, sf_dir):
    """WI8: first 10 centroid coordinates in cluster-id order."""
    c = R.cluster_centroids(S.clustered(spark, sf_dir))
    return rounded(c.orderBy("cluster_id").limit(10).select("cluster_id", "centroid_lon", "centroid_lat"))
