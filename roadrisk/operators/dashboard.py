"""Interactive-filter core: filter request -> filtered rows, statistics, layer tables.

A request is a ``CrashFilter`` value. ``filter_predicate`` turns it into one
boolean column; statistics evaluate that predicate inside a single
conditional aggregation over the full table (one scan, no second job for the
filtered subset). Only bounded outputs (one stats row, a capped point sample,
77 area rows, cluster markers) ever leave the cluster.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import any_of, null_false
from ..functions.labels import (BAND_COLORS_FILTER, CLASS_COLOR, CLASS_SIZE, CRASH_TYPE_NAMES, LIGHTING_NAMES, SURFACE_NAMES, WEATHER_NAMES,
                                date_label, severity_class)
from ..session import ensure_checkpoint_dir
from .sampling import exact_sample

# ---- fixed values: severity categories of the filter panel ----
SEVERITY_LEVELS = ["Fatal", "Injury", "Property Damage"]


def severity_predicate(level: str) -> Column:
    if level == "Fatal":
        return null_false(F.col("fatal") > 0)
    if level == "Injury":
        return null_false(F.col("serious") > 0) | null_false(F.col("moderate") > 0)
    if level == "Property Damage":
        return null_false(F.col("minor") > 0) | null_false(F.col("none") > 0)
    return F.lit(False)


@dataclass
class CrashFilter:
    """Filter request. An empty list, or the full domain in its canonical order, means no filter."""
    hours: list = field(default_factory=list)
    days: list = field(default_factory=list)
    months: list = field(default_factory=list)
    years: list = field(default_factory=list)
    weather: list = field(default_factory=list)
    lighting: list = field(default_factory=list)
    surface: list = field(default_factory=list)
    crash_types: list = field(default_factory=list)
    severity: list = field(default_factory=list)
    risk_range: tuple | None = None


def _active(sel, full) -> bool:
    return bool(sel) and list(sel) != list(full)


def filter_predicate(df: DataFrame, f: CrashFilter, years: Column | None = None) -> Column:
    """One boolean column for the whole request (null -> not selected).

    ``years`` is a column with the sorted distinct years of the table, needed when the request names years.
    """
    preds = []
    if _active(f.hours, range(24)):
        preds.append(F.col("crash_hour").isin(list(f.hours)))
    if _active(f.days, range(7)):
        preds.append(F.col("crash_day_of_week").isin(list(f.days)))
    if _active(f.months, range(1, 13)):
        preds.append(F.col("crash_month").isin(list(f.months)))
    if f.years:
        named = F.array(*[F.lit(int(y)) for y in f.years])
        preds.append((years.cast("array<int>") == named) | null_false(F.col("crash_year").isin(list(f.years))))
    if _active(f.weather, WEATHER_NAMES.keys()):
        preds.append(F.col("WEATHER_CONDITION").isin(list(f.weather)))
    if _active(f.lighting, LIGHTING_NAMES.keys()):
        preds.append(F.col("LIGHTING_CONDITION").isin(list(f.lighting)))
    if _active(f.surface, SURFACE_NAMES.keys()):
        preds.append(F.col("ROADWAY_SURFACE_COND").isin(list(f.surface)))
    if _active(f.crash_types, CRASH_TYPE_NAMES.keys()):
        preds.append(F.col("FIRST_CRASH_TYPE").isin(list(f.crash_types)))
    if _active(f.severity, SEVERITY_LEVELS):
        preds.append(any_of(severity_predicate(s) for s in f.severity if s in SEVERITY_LEVELS))
    if f.risk_range and "risk_score" in df.columns:
        lo, hi = f.risk_range
        preds.append((F.col("risk_score") >= lo) & (F.col("risk_score") <= hi))
    out = F.lit(True)
    for p in preds:
        out = out & null_false(p)
    return out


def with_selected(df: DataFrame, f: CrashFilter, out: str = "selected") -> DataFrame:
    """``df`` with the request's flag.

    Years in their full domain mean no filter; that domain is a one-row aggregate of the year column
    alone, attached by a broadcast join, so nothing is collected. A table with a null year has no full domain.
    """
    if not f.years:
        return df.withColumn(out, filter_predicate(df, f))
    domain = df.agg(F.sort_array(F.collect_set("crash_year")).alias("_years"), F.count_if(F.col("crash_year").isNull()).alias("_none"))
    domain = domain.select(F.when(F.col("_none") == 0, F.col("_years")).otherwise(F.array()).alias("_years"), F.lit(1).alias("_one"))
    joined = df.withColumn("_one", F.lit(1)).join(F.broadcast(domain), "_one")  # one row
    return joined.withColumn(out, filter_predicate(df, f, F.col("_years"))).drop("_years", "_one")


def apply_filters(df: DataFrame, f: CrashFilter) -> DataFrame:
    return with_selected(df, f, "_selected").filter("_selected").drop("_selected")


def reset() -> CrashFilter:
    """The request after a reset: every panel at its full domain, which filters nothing."""
    return CrashFilter(hours=list(range(24)), days=list(range(7)), months=list(range(1, 13)), weather=list(WEATHER_NAMES), lighting=list(LIGHTING_NAMES),
                       surface=list(SURFACE_NAMES), crash_types=list(CRASH_TYPE_NAMES), severity=list(SEVERITY_LEVELS))


def filter_statistics(df: DataFrame, f: CrashFilter) -> DataFrame:
    """Filtered-versus-total statistics in one conditional aggregation.

    Mean risk is that of ``mean_weighted_severity`` where the table has it, else it comes from the
    injury counts; an injury column that is absent counts 0.
    """
    return statistics_of(with_selected(df, f, "_selected"), F.col("_selected"))


def statistics_of(df: DataFrame, sel: Column) -> DataFrame:
    """The statistics of rows whose flag ``sel`` is set, against all rows."""

    def s(c, cond=None):
        if c not in df.columns:
            return F.lit(0).cast("long")
        x = F.col(c) if cond is None else F.when(cond, F.col(c))
        return F.coalesce(F.sum(x), F.lit(0)).cast("long")

    scored = "mean_weighted_severity" in df.columns
    score = F.col("mean_weighted_severity") if scored else F.lit(None).cast("double")

    agg = df.agg(
        F.count_if(sel).alias("filtered_count"), F.count(F.lit(1)).alias("total_count"),
        s("fatal", sel).alias("fatal_filtered"), s("fatal").alias("fatal_total"),
        s("serious", sel).alias("_ser_f"), s("moderate", sel).alias("_mod_f"),
        s("serious").alias("_ser_t"), s("moderate").alias("_mod_t"),
        F.coalesce(F.avg(F.when(sel, score)), F.lit(0.0)).alias("_risk_f"), F.coalesce(F.avg(score), F.lit(0.0)).alias("_risk_t"),
    )
    pct = F.when(F.col("total_count") > 0, F.col("filtered_count") / F.col("total_count") * 100).otherwise(F.lit(0.0))
    mean_f = (3 * F.col("fatal_filtered") + 2 * F.col("_ser_f") + F.col("_mod_f")) / F.greatest(F.col("filtered_count"), F.lit(1))
    mean_t = (3 * F.col("fatal_total") + 2 * F.col("_ser_t") + F.col("_mod_t")) / F.greatest(F.col("total_count"), F.lit(1))
    if scored:
        mean_f, mean_t = F.col("_risk_f"), F.col("_risk_t")
    out = agg.select(
        "filtered_count", "total_count", pct.cast("double").alias("percentage"), "fatal_filtered", "fatal_total",
        (F.col("_ser_f") + F.col("_mod_f")).alias("injury_filtered"), (F.col("_ser_t") + F.col("_mod_t")).alias("injury_total"),
        mean_f.cast("double").alias("mean_risk_filtered"), mean_t.cast("double").alias("mean_risk_total"),
    )
    return out.withColumn("risk_change", F.when(F.col("mean_risk_total") > 0, (F.col("mean_risk_filtered") - F.col(
        "mean_risk_total")) / F.col("mean_risk_total") * 100).otherwise(F.lit(0.0)))


def points_layer(filtered: DataFrame, key: str = "crash_id", max_points: int = 5000, seed: int = 42) -> DataFrame:
    """Point markers: a deterministic sample (only when above the cap) with class, colour, size and date label."""
    pts = exact_sample(filtered, max_points, key, seed)
    cls = severity_class()
    return pts.select(
        key, "lon", "lat", cls.alias("severity"),
        F.element_at(F.create_map(*[F.lit(x) for kv in CLASS_COLOR.items() for x in kv]), cls).alias("color"),
        F.element_at(F.create_map(*[F.lit(x) for kv in CLASS_SIZE.items() for x in kv]), cls).alias("size"),
        date_label("crash_month", "crash_day_of_week", "crash_hour").alias("date_label"),
    )


def choropleth_layer(banded_areas: DataFrame, colors: dict, band: str = "risk_category") -> DataFrame:
    """Polygon layer rows: exterior lon/lat arrays, band colour and hover fields (polygons only)."""
    m = F.create_map(*[F.lit(x) for kv in colors.items() for x in kv])
    return banded_areas.filter(F.col("geom_type") == "Polygon").select(
        "area_num_1", "community", band, F.element_at(m, F.col(band)).alias("color"),
        F.transform(F.col("rings")[0], lambda p: p["x"]).alias("lons"),
        F.transform(F.col("rings")[0], lambda p: p["y"]).alias("lats"),
        "total_crashes", "fatal", "mean_weighted_severity",
    )


#: What statistics and point layer read of a crash.
_SELECTION = ("lon", "lat", "fatal", "serious", "moderate", "minor", "none", "mean_weighted_severity", "crash_month", "crash_day_of_week", "crash_hour")


def dashboard(df: DataFrame, f: CrashFilter, areas: DataFrame | None = None, clusters: DataFrame | None = None, cluster_risk: DataFrame | None = None, colors: dict | None = None,
              layers: tuple[str, ...] = ("statistics", "points", "areas", "clusters"), key: str = "crash_id", max_points: int = 5000) -> dict[str, DataFrame]:
    """One dashboard request: the asked ones of statistics, point layer, area layer and cluster layer.

    The crashes are read once: the request's flag and the few columns that its outputs need are written to
    the shared folder, and statistics and points read that. Areas (banded) and clusters (centroids with
    their risk) do not depend on the filter.
    """
    out: dict[str, DataFrame] = {}
    if "statistics" in layers or "points" in layers:
        flagged = with_selected(df, f)
        path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/requests/{uuid.uuid4().hex}"
        narrow = flagged.select(key, *[c for c in _SELECTION if c in df.columns], "selected")
        narrow.write.parquet(path)
        stored = df.sparkSession.read.schema(narrow.schema).parquet(path)
        if "statistics" in layers:
            out["statistics"] = statistics_of(stored, F.col("selected"))
        if "points" in layers:
            out["points"] = points_layer(stored.filter("selected"), key, max_points)
    if "areas" in layers and areas is not None:
        out["areas"] = choropleth_layer(areas, colors or BAND_COLORS_FILTER)
    if "clusters" in layers and clusters is not None:
        out["clusters"] = cluster_layer(clusters, cluster_risk)
    return out


def cluster_layer(centroids: DataFrame, risk: DataFrame) -> DataFrame:
    """Cluster markers: centroids with their risk, size by the root of the number of crashes."""
    told = risk.select("cluster_id", "total_crashes", "weighted_score")
    return centroids.join(told, "cluster_id", "left").select(
        "cluster_id", "centroid_lon", "centroid_lat", "total_crashes", "weighted_score", (F.sqrt("total_crashes") * 2).alias("marker_size"))
