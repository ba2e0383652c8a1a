"""Boundary loading and the grid-keyed point-in-polygon left join.

Spark has no spatial predicate join, and a plain theta join would be a nested
loop. The join here is two-phase:

1. Every polygon is exploded to the grid cells its bounding box covers (cell
   side chosen from the polygon table itself, so the exploded table stays a
   bounded multiple of the polygon count).
2. Points compute their own cell and equi-join on (cell_x, cell_y); the exact
   ray-casting test runs as the join condition. A left outer join keeps
   unmatched points with a null area, and a point inside two overlapping
   polygons appears twice, as a ``within`` spatial join does.

The polygon side is broadcast only when its measured size is under a limit;
above it the join shuffles both sides on the cell key (AQE splits hot cells).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import point_within, point_within_sql, ring_bounds

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
MAX_CELLS_PER_POLYGON = 64


def load_community_areas(areas: DataFrame) -> DataFrame:
    """Normalise a boundary table: area number and name columns, numeric code."""
    if "area_num_1" in areas.columns:
        areas = areas.withColumnRenamed("area_num_1", "community_area_number")
    elif "area_numbe" in areas.columns:
        areas = areas.withColumnRenamed("area_numbe", "community_area_number")
    if "community" in areas.columns and "community_area_name" not in areas.columns:
        areas = areas.withColumn("community_area_name", F.col("community"))
    if "community_area_number" in areas.columns:
        areas = areas.withColumn(
            "community_area_number", F.col("community_area_number").cast("string").try_cast("double").cast("long")
        )
    if "rings" not in areas.columns:
        raise ValueError("Community area table requires a 'rings' geometry column.")
    return areas


def polygon_cells(areas: DataFrame, cell_deg: float | None = None):
    """Explode polygons to grid cells. Returns (cells DataFrame, cell size, est. bytes).

    One aggregate gives n, sum(w), sum(h), sum(w*h) and the vertex count. For a
    cell side c every polygon covers at most (w/c + 2)(h/c + 2) cells, so
    sum(wh)/c^2 + 2(sum w + sum h)/c + 4n bounds the exploded table; c starts
    at the mean extent and doubles until the bound is <= MAX_CELLS_PER_POLYGON*n.
    """
    polys = areas.withColumns(ring_bounds("rings")).filter(F.col("lon_lo").isNotNull())
    w, h = F.col("lon_hi") - F.col("lon_lo"), F.col("lat_hi") - F.col("lat_lo")
    verts = F.aggregate(F.transform(F.col("rings"), lambda r: F.size(r)), F.lit(0), lambda a, v: a + v)
    st = polys.agg(
        F.count(F.lit(1)).alias("n"), F.sum(w).alias("sw"), F.sum(h).alias("sh"), F.sum(w * h).alias("swh"),
        F.avg(F.greatest(w, h)).alias("ext"), F.sum(verts).alias("v"),
    ).first()
    n = max(int(st["n"] or 0), 1)
    sw, sh, swh, v = float(st["sw"] or 0), float(st["sh"] or 0), float(st["swh"] or 0), int(st["v"] or 0)
    cell = cell_deg or max(float(st["ext"] or 1.0) / 4.0, 1e-9)

    def bound(c):
        return swh / (c * c) + 2 * (sw + sh) / c + 4 * n

    while cell_deg is None and bound(cell) > MAX_CELLS_PER_POLYGON * n:
        cell *= 2.0
    n_cells = bound(cell)
    est_bytes = int(n_cells * 96 + v * 16 * (n_cells / n))
    gx = F.explode(F.sequence(F.floor(F.col("lon_lo") / cell), F.floor(F.col("lon_hi") / cell)))
    gy = F.explode(F.sequence(F.floor(F.col("lat_lo") / cell), F.floor(F.col("lat_hi") / cell)))
    cells = polys.withColumn("_gx", gx).withColumn("_gy", gy).drop("lon_lo", "lon_hi", "lat_lo", "lat_hi")
    # Classify each (polygon, cell): a cell that no edge's bounding box touches
    # lies wholly inside (interior: match without a point test) or wholly
    # outside (dropped). Only boundary cells run the exact ray-cast per point.
    x0, x1, y0, y1 = f"(_gx * {cell!r})", f"((_gx + 1) * {cell!r})", f"(_gy * {cell!r})", f"((_gy + 1) * {cell!r})"
    touch = (
        "exists(rings, r -> exists(sequence(0, greatest(size(r) - 2, 0)), i -> "
        f"greatest(r[i].x, r[i + 1].x) >= {x0} AND least(r[i].x, r[i + 1].x) <= {x1} AND "
        f"greatest(r[i].y, r[i + 1].y) >= {y0} AND least(r[i].y, r[i + 1].y) <= {y1}))"
    )
    cells = cells.withColumns({
        "_boundary": F.expr(touch),
        "_centre_in": F.expr(point_within_sql("rings", f"(({x0} + {x1}) / 2)", f"(({y0} + {y1}) / 2)")),
    })
    cells = cells.filter(F.col("_boundary") | F.col("_centre_in")).drop("_centre_in")
    return cells, cell, est_bytes


def spatial_join(points: DataFrame, areas: DataFrame, x: str = "lon", y: str = "lat",
                 cell_deg: float | None = None, lsuffix: str = "_crash", rsuffix: str = "_community",
                 broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Left join of points to the polygons that strictly contain them."""
    if x not in points.columns or y not in points.columns or "rings" not in areas.columns:
        raise ValueError("Both tables must carry geometry (point x/y columns and polygon 'rings').")
    cells, cell, est_bytes = polygon_cells(areas, cell_deg)
    area_cols = [c for c in areas.columns if c not in ("rings", "parts")]
    clash = [c for c in area_cols if c in points.columns]
    if clash:
        points = points.withColumnsRenamed({c: f"{c}_{lsuffix}" for c in clash})
        cells = cells.withColumnsRenamed({c: f"{c}_{rsuffix}" for c in clash})
        area_cols = [f"{c}_{rsuffix}" if c in clash else c for c in area_cols]
    if est_bytes <= broadcast_limit:
        cells = F.broadcast(cells)
    pts = points.withColumns({"_cx": F.floor(F.col(x) / cell), "_cy": F.floor(F.col(y) / cell)})
    pts = pts.withColumns({"_px": F.col(x), "_py": F.col(y)})
    cond = (
        (pts["_cx"] == cells["_gx"]) & (pts["_cy"] == cells["_gy"])
        & (~cells["_boundary"] | point_within("rings", "_px", "_py"))
    )
    joined = pts.join(cells, cond, "left")
    return joined.select(*points.columns, *[c for c in area_cols if not c.startswith("index_")])


def bbox_rings(lon_lo, lat_lo, lon_hi, lat_hi):
    """Closed rectangle ring as an array<struct<x,y>> column."""
    def pt(px, py):
        return F.struct(px.alias("x"), py.alias("y"))
    return F.array(F.array(pt(lon_lo, lat_lo), pt(lon_hi, lat_lo), pt(lon_hi, lat_hi), pt(lon_lo, lat_hi), pt(lon_lo, lat_lo)))



# ---- fixed values: fallback names of the area-number column ----
AREA_KEY_FALLBACKS = ["area_num", "area_numbe", "area_number", "community_area_number"]


def find_area_key(columns: list[str]) -> str:
    """First column whose name contains 'area' and 'num', else a known fallback name."""
    for c in columns:
        if "area" in c.lower() and "num" in c.lower():
            return c
    for c in AREA_KEY_FALLBACKS:
        if c in columns:
            return c
    raise ValueError(f"Could not find area number column. Available columns: {columns}")
