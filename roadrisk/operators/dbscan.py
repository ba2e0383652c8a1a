"""Exact DBSCAN with the haversine metric, as a sequence of Spark joins.

Semantics (per group, e.g. community area; a null group is its own group):
core = at least ``min_samples`` points within ``eps`` metres, the point itself
included; clusters = connected components of core points under "within eps";
border = non-core point within eps of a core point, labelled with the
smallest cluster id among those cores; everything else is noise (-1).
Cluster ids are 0..k-1 in (group nulls last, smallest core id) order.

Plan, built so no step is quadratic in a hot spot:

1. Identical coordinates collapse to one weighted point (partial aggregation).
2. Latitude rows, each cut evenly around the globe into its own number of
   cells, so that any two points of one cell are within eps at every latitude
   and cells meet across 180 degrees. A cell holding >= min_samples points is
   *dense*: all its points are core and connected, so no pairs are generated
   inside it; it becomes one graph node.
3. Points in sparse cells probe the cells that eps can reach at their latitude.
   Sparse neighbours are compared point by point (at most min_samples per
   cell); of dense neighbours, whole micro boxes (bounding boxes of 1/8 x 1/8
   sub-cells) surely within eps count at once, and only undecided ones compare
   points.
4. Dense cells whose touching micro boxes are surely within eps are linked at
   once. Only cell pairs that these links and those of step 3 leave in different
   components are compared further: by micro boxes, of which undecided pairs are
   split into smaller boxes, round by round, until they are decided or hold few
   points. So an area that is dense throughout costs its touching boxes.
5. Connected components of the cells with a core point (operators.components),
   before that comparison and after it.
6. Cluster ids: a distributed dense rank (range partitioning + per-partition
   offsets), never a single-task window.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_M
from ..session import ensure_checkpoint_dir, send_package
from .components import connected_components
from .nearby import neighbour_counter

NULL_GROUP = -(2 ** 62)
MICRO = 8
POINT_PAIRS = 4096  # box pairs of at most so many point pairs compare points
TILE = 4  # side of a tile of ``eps_neighbours``, in eps
PART = 250_000  # points that one task of a tile counts for at most, nearly


def _hav_sql(la1: str, lo1: str, la2: str, lo2: str) -> str:
    return (f"2 * {EARTH_RADIUS_M!r} * asin(sqrt(least(1.0, pow(sin(radians({la2} - {la1}) / 2), 2) + "
            f"cos(radians({la1})) * cos(radians({la2})) * pow(sin(radians({lo2} - {lo1}) / 2), 2))))")


def _checkpoint(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _stored(df: DataFrame, name: str = "points") -> DataFrame:
    """``df`` as Parquet in the shared folder, read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_rank_distributed(df: DataFrame, order_cols: list, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based dense rank of the distinct rows of ``df`` ordered by ``order_cols``.

    Range-partitions by the order, numbers rows inside each partition, and adds
    the row counts of all earlier partitions (a table with one row per partition).
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = df.distinct().repartitionByRange(n, *order_cols).withColumn("_part", F.spark_partition_id())
    r = _checkpoint(r)
    counts = r.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn("_off", F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = Window.partitionBy("_part").orderBy(*order_cols)
    ranked = r.withColumn("_rn", F.row_number().over(w)).join(F.broadcast(offs.select("_part", "_off")), "_part")
    return ranked.withColumn(out, (F.col("_off") + F.col("_rn") - 1).cast("long")).drop("_part", "_rn", "_off")


class Grid:
    """Latitude rows of one height, each cut into equal cells of at most the same width on the ground."""

    def __init__(self, eps_m: float, side_m: float | None = None):
        self.eps_m = eps_m
        half = math.sin(min(math.pi / 2, eps_m / (2 * EARTH_RADIUS_M)))
        self.q = half * half  # haversine of eps
        # radians; without ``side_m`` so small that any two points of a cell are within eps
        self.side = 2 * half / math.sqrt(2) * (1 - 1e-6) if side_m is None else min(math.pi, side_m / EARTH_RADIUS_M)
        self.dlat = math.degrees(self.side)
        self.rows = math.ceil(math.degrees(eps_m / EARTH_RADIUS_M) / self.dlat)
        self.first, self.last = math.floor(-90 / self.dlat), math.floor(90 / self.dlat)

    def row(self, la: str) -> str:
        return f"CAST(floor({la} / {self.dlat!r}) AS BIGINT)"

    def columns(self, cy: str) -> str:
        """Number of cells of a row: its edge nearer to the equator sets the width."""
        edge = f"(CASE WHEN {cy} >= 0 THEN {cy} ELSE -({cy} + 1) END) * {self.dlat!r}"
        return f"greatest(CAST(1 AS BIGINT), CAST(ceil({2 * math.pi!r} * cos(radians(least(90.0, {edge}))) / {self.side!r}) AS BIGINT))"

    def reach(self, la: str, cy: str) -> str:
        """Largest difference in longitude, in degrees, of points within eps at latitude ``la`` and in row ``cy``."""
        far = f"least(90.0, greatest(abs({cy}), abs({cy} + 1)) * {self.dlat!r})"
        q = f"{self.q!r} / greatest(1e-30, cos(radians({la})) * cos(radians({far})))"
        return f"(CASE WHEN {q} >= 1 THEN 360.0 ELSE degrees(2 * asin(sqrt(least(1.0, {q})))) * (1 + 1e-9) + 1e-9 END)"

    def neighbours(self, df: DataFrame, la: str, x0: str, x1: str, cy: str, out_x: str, out_y: str) -> DataFrame:
        """``df`` once for every cell (out_x, out_y) that eps can reach from latitude ``la``, x0 to x1 in row ``cy``."""
        df = df.withColumn(out_y, F.explode(F.expr(f"sequence(greatest({cy} - {self.rows}, {self.first}L), least({cy} + {self.rows}, {self.last}L))")))
        df = df.withColumns({"_n": F.expr(self.columns(out_y)), "_r": F.expr(self.reach(la, out_y))})
        df = df.withColumns({"_lo": F.expr(f"CAST(floor(({x0} - _r) * _n / 360.0) AS BIGINT)"), "_hi": F.expr(f"CAST(floor(({x1} + _r) * _n / 360.0) AS BIGINT)")})
        df = df.withColumn("_i", F.explode(F.expr("sequence(if(_hi - _lo + 1 >= _n, 0L, _lo), if(_hi - _lo + 1 >= _n, _n - 1, _hi))")))
        return df.withColumn(out_x, F.expr("pmod(_i, _n)")).drop("_n", "_r", "_lo", "_hi", "_i")

    def within_reach(self, df: DataFrame, la: str, x: str, out_x: str, out_y: str) -> DataFrame:
        """As ``neighbours``, for points and without the rows that eps does not reach from the point's latitude."""
        far = math.degrees(self.eps_m / EARTH_RADIUS_M) * (1 + 1e-9) + 1e-9
        df = df.withColumn("_y", F.expr(self.row(la)))
        df = self.neighbours(df, la, x, x, "_y", out_x, out_y).drop("_y")
        return df.filter(f"{out_y} BETWEEN {self.row(f'({la} - {far!r})')} AND {self.row(f'({la} + {far!r})')}")


def eps_neighbours(points: DataFrame, id_col: str = "crash_id", lat: str = "lat", lon: str = "lon", group_col: str | None = "community_area_number", eps_m: float = 250.0) -> DataFrame:
    """(id, neighbours): how many points of its group lie within eps metres of each point, itself included.

    Equal coordinates are one weighted point. Points are dealt to tiles of TILE x eps a side, each also to the
    tiles that eps reaches from it (about twice in all), and a tile counts its own points' neighbours in arrays
    (operators.nearby). A tile of more than PART points is dealt to several tasks, each with a part of the points
    to count for; the points they are compared with stream past in blocks.
    """
    tiles = Grid(eps_m, TILE * eps_m)
    g = F.coalesce(F.col(group_col).cast("long"), F.lit(NULL_GROUP)) if group_col else F.lit(0).cast("long")
    base = points.select(F.col(id_col).alias("_id"), g.alias("g"), F.col(lat).cast("double").alias("la"), F.col(lon).cast("double").alias("lo"))
    base = base.filter(F.col("la").isNotNull() & F.col("lo").isNotNull())
    wp = _celled(base.groupBy("g", "la", "lo").agg(F.count(F.lit(1)).alias("w")), tiles)
    pts = _checkpoint(wp.select("g", "la", "lo", "w", "x", "cx", "cy"))
    heavy = pts.groupBy("g", "cx", "cy").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PART)
    heavy = F.broadcast(heavy.select("g", "cx", "cy", F.expr(f"CAST(ceil(n / {PART}) AS INT)").alias("parts")))
    dealt = ["g", "cx", "cy", "part"]
    own = pts.join(heavy, ["g", "cx", "cy"], "left").withColumn("part", F.expr("CAST(pmod(xxhash64(la, lo), coalesce(parts, 1)) AS INT)"))
    met = tiles.within_reach(pts.drop("cx", "cy"), "la", "x", "cx", "cy").join(heavy, ["g", "cx", "cy"], "left")
    met = met.withColumn("part", F.explode(F.expr("sequence(0, coalesce(parts, 1) - 1)")))
    both = own.select(*dealt, F.lit(False).alias("met"), "la", "lo", F.lit(0).cast("long").alias("w")).unionByName(
        met.select(*dealt, F.lit(True).alias("met"), "la", "lo", "w"))
    send_package(points.sparkSession)
    counts = both.repartition(*dealt).sortWithinPartitions(*dealt, "met").mapInArrow(
        neighbour_counter(eps_m), "g long, la double, lo double, neighbours long")
    return base.join(counts, ["g", "la", "lo"]).select(F.col("_id").alias(id_col), "neighbours")


def _celled(wp: DataFrame, grid: Grid) -> DataFrame:
    """Weighted points with their cell; x is the longitude from 0 to 360, (ux, uy) the place within the cell from 0 to 1."""
    wp = wp.withColumns({"x": F.expr("pmod(lo + 180.0, 360.0)"), "cy": F.expr(grid.row("la"))})
    wp = wp.withColumn("_u", F.expr(f"x * {grid.columns('cy')} / 360.0")).withColumn("cx", F.expr(f"least(CAST(floor(_u) AS BIGINT), {grid.columns('cy')} - 1)"))
    return wp.withColumns({"ux": F.col("_u") - F.col("cx"), "uy": F.expr(f"la / {grid.dlat!r} - cy")}).drop("_u")


def dbscan(points: DataFrame, id_col: str = "crash_id", lat: str = "lat", lon: str = "lon",
           group_col: str | None = "community_area_number", eps_m: float = 250.0, min_samples: int = 12,
           axis_order: str = "latlon") -> DataFrame:
    """Label every point: the input columns plus is_core, core_label, cluster_id.

    ``axis_order='lonlat'`` feeds (lon, lat) to the haversine metric the way
    the original analysis did (its distances are then not metres on the
    ground); the default uses the correct (lat, lon) order.
    """
    if axis_order == "lonlat":
        lat, lon = lon, lat
    grid = Grid(eps_m)
    g = F.coalesce(F.col(group_col).cast("long"), F.lit(NULL_GROUP)) if group_col else F.lit(0).cast("long")
    keep = [c for c in points.columns if c not in ("_id", "g", "la", "lo", "pid")]
    base = points.withColumns({"_id": F.col(id_col).cast("long"), "g": g,
                               "la": F.col(lat).cast("double"), "lo": F.col(lon).cast("double")})
    base = _stored(base.filter(F.col("la").isNotNull() & F.col("lo").isNotNull()))  # read at the start and at the end

    # 1. weighted distinct points
    wp = base.groupBy("g", "la", "lo").agg(F.min("_id").alias("pid"), F.count(F.lit(1)).alias("w"))

    # 2. cells
    wp = _checkpoint(_celled(wp, grid))
    cells = wp.groupBy("g", "cx", "cy").agg(F.sum("w").alias("cn"))
    pts = _checkpoint(wp.join(cells, ["g", "cx", "cy"]).withColumn("dense", F.col("cn") >= min_samples).drop("cn"))
    boxes = _checkpoint(_boxes(pts.filter("dense"), 0))

    # 3. sparse-cell points probe the cells within reach
    probe = pts.filter(~F.col("dense")).select("g", "pid", "la", "lo", "x", F.col("cx").alias("pcx"), F.col("cy").alias("pcy"))
    probe = grid.neighbours(probe, "la", "x", "x", "pcy", "cx", "cy")
    sparse = pts.filter(~F.col("dense")).select("g", "cx", "cy", F.col("pid").alias("qpid"), F.col("w").alias("qw"),
                                                F.col("la").alias("qla"), F.col("lo").alias("qlo"))
    near = F.expr(_hav_sql("la", "lo", "qla", "qlo")) <= eps_m
    met = probe.join(sparse, ["g", "cx", "cy"]).filter(near).select("g", "pid", "pcx", "pcy", "qpid", "qw", "cx", "cy")
    as_box = {"pla0": F.col("la"), "pla1": F.col("la"), "px0": F.col("x"), "px1": F.col("x")}
    hit = probe.join(boxes.select(*[F.col(c).alias("q" + c if c in BOX else c) for c in boxes.columns]), ["g", "cx", "cy"])
    hit = hit.withColumns(as_box).filter(_box_lower("p", "q") <= eps_m).withColumn("sure", _box_upper("p", "q") <= eps_m * (1 - 1e-9))
    inside = pts.filter("dense").select("g", "cx", "cy", *_box_index(0), F.col("w").alias("qw"), F.col("la").alias("qla"), F.col("lo").alias("qlo"))
    seen = hit.filter("sure").select("g", "pid", "pcx", "pcy", "cx", "cy", F.col("w").alias("qw")).unionByName(
        hit.filter("not sure").drop("w").join(inside, ["g", "cx", "cy", "bx", "by"]).filter(near).select("g", "pid", "pcx", "pcy", "cx", "cy", "qw"))
    seen = seen.groupBy("g", "pid", "pcx", "pcy", "cx", "cy").agg(F.sum("qw").alias("qw")).withColumn("qpid", F.lit(None).cast("long"))
    pairs = _checkpoint(met.unionByName(seen))  # qpid is null for a dense cell, whose points are all core
    counts = pairs.groupBy("pid").agg(F.sum("qw").alias("nbrs"))
    pts = _checkpoint(pts.join(counts, "pid", "left").withColumn("core", F.col("dense") | (F.coalesce(F.col("nbrs"), F.lit(0)) >= min_samples)))

    # Any two points of one cell are within eps, so all core points of a cell are
    # directly connected: each cell holding a core point is ONE graph node, named
    # by its smallest core id (so component minima are smallest core ids).
    core_cells = _checkpoint(pts.filter("core").groupBy("g", "cx", "cy").agg(F.min("pid").alias("cnode")))
    core_of = pts.filter(~F.col("dense")).select("pid", "core")
    sp = pairs.join(core_of, "pid").join(core_of.select(F.col("pid").alias("qpid"), F.col("core").alias("qcore")), "qpid", "left")
    sp = sp.withColumn("qcore", F.coalesce("qcore", F.lit(True)))
    # sparse core <-> any core, as distinct cell pairs
    cc_pairs = sp.filter(F.col("core") & F.col("qcore")).select("g", "pcx", "pcy", "cx", "cy").distinct()
    src_cells = core_cells.select("g", F.col("cx").alias("pcx"), F.col("cy").alias("pcy"), F.col("cnode").alias("src"))
    dst_cells = core_cells.select("g", "cx", "cy", F.col("cnode").alias("dst"))
    e1 = cc_pairs.join(src_cells, ["g", "pcx", "pcy"]).join(dst_cells, ["g", "cx", "cy"]).select("src", "dst")

    # 4. dense <-> dense cells: those that touch, then those that are still apart; 5. components, a cell without an edge is its own
    touch = _touching(boxes, grid)
    e2 = touch.join(src_cells.withColumnsRenamed({"pcx": "acx", "pcy": "acy"}), ["g", "acx", "acy"]).join(
        dst_cells.withColumnsRenamed({"cx": "bcx", "cy": "bcy"}), ["g", "bcx", "bcy"]).select("src", "dst")
    labels = connected_components(e1.unionByName(e2), "src", "dst").withColumnRenamed("node", "cnode")
    cell_label = _checkpoint(core_cells.join(labels, "cnode", "left").select("g", "cx", "cy", F.coalesce("label", "cnode").alias("label")))
    e3 = _dense_links(pts.filter("dense"), boxes, grid, cell_label)
    if not e3.isEmpty():
        whole = connected_components(e3, "alabel", "blabel").select(F.col("node").alias("label"), F.col("label").alias("least"))
        cell_label = _checkpoint(cell_label.join(whole, "label", "left").select("g", "cx", "cy", F.coalesce("least", "label").alias("label")))

    core_lab = pts.filter("core").join(cell_label, ["g", "cx", "cy"]).select("pid", F.col("label").alias("core_label"))
    # border: non-core with a core neighbour -> smallest neighbouring component label
    border = sp.filter(~F.col("core") & F.col("qcore")).join(cell_label, ["g", "cx", "cy"]).groupBy("pid").agg(
        F.min("label").alias("border_label"))
    allp = pts.select("pid", "g", "la", "lo", "core").join(core_lab, "pid", "left").join(border, "pid", "left")
    allp = allp.withColumn("label", F.coalesce("core_label", "border_label"))

    # 6. cluster ids in (group nulls last, label) order
    keys = cell_label.select((F.col("g") == NULL_GROUP).alias("gnull"), "g", "label")
    ranked = dense_rank_distributed(keys, ["gnull", "g", "label"], out="cluster_id")
    allp = allp.join(ranked.select("g", "label", "cluster_id"), ["g", "label"], "left")
    allp = allp.withColumn("cluster_id", F.coalesce(F.col("cluster_id"), F.lit(-1)).cast("long"))
    out = base.join(allp.select("g", "la", "lo", "core", "core_label", "cluster_id"), ["g", "la", "lo"])
    return out.select(*keep, F.col("core").alias("is_core"),
                      F.when(F.col("core"), F.col("core_label")).alias("core_label"), "cluster_id")


#: A box: latitudes from la0 to la1, longitudes (from 0 to 360) from x0 to x1.
BOX = ("la0", "la1", "x0", "x1")


def _box_index(level: int) -> list:
    """Numbers (bx, by) of a point's box within its cell: MICRO * 4^level boxes each way."""
    n = MICRO * 4 ** level
    return [F.least(F.floor(F.col(u) * n), F.lit(n - 1)).cast("long").alias(b) for u, b in (("ux", "bx"), ("uy", "by"))]


def _boxes(pts: DataFrame, level: int) -> DataFrame:
    """Bounding boxes of the points by cell and box, with their weight and number of points."""
    return pts.select("g", "cx", "cy", "la", "x", "w", *_box_index(level)).groupBy("g", "cx", "cy", "bx", "by").agg(
        F.min("la").alias("la0"), F.max("la").alias("la1"), F.min("x").alias("x0"), F.max("x").alias("x1"),
        F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))


def _box_lower(a: str, b: str):
    """Lower bound (metres) of the distance between two boxes {a,b}{la0,la1,x0,x1}; longitudes wrap."""
    gap_la = F.greatest(F.lit(0.0), F.col(f"{b}la0") - F.col(f"{a}la1"), F.col(f"{a}la0") - F.col(f"{b}la1"))
    gap_x = F.greatest(F.lit(0.0), F.col(f"{b}x0") - F.col(f"{a}x1"), F.col(f"{a}x0") - F.col(f"{b}x1"))
    around = F.greatest(F.lit(0.0), 360.0 - (F.greatest(f"{a}x1", f"{b}x1") - F.least(f"{a}x0", f"{b}x0")))
    gap_x = F.least(gap_x, around)
    amax = F.greatest(F.abs(f"{a}la0"), F.abs(f"{a}la1"), F.abs(f"{b}la0"), F.abs(f"{b}la1"))
    h = F.pow(F.sin(F.radians(gap_la) / 2), 2) + F.pow(F.cos(F.radians(amax)), 2) * F.pow(F.sin(F.radians(gap_x) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), h))) * (1 - 1e-9)


def _box_upper(a: str, b: str):
    """Upper bound (metres): the largest differences of latitude and longitude at the latitude nearest the equator."""
    dla = F.greatest(F.col(f"{b}la1") - F.col(f"{a}la0"), F.col(f"{a}la1") - F.col(f"{b}la0"))
    dx = F.greatest(F.col(f"{b}x1") - F.col(f"{a}x0"), F.col(f"{a}x1") - F.col(f"{b}x0"))
    wide = (F.col(f"{a}x1") - F.col(f"{a}x0")) + (F.col(f"{b}x1") - F.col(f"{b}x0"))
    around = 360.0 - F.greatest(F.col(f"{b}x0") - F.col(f"{a}x1"), F.col(f"{a}x0") - F.col(f"{b}x1"))   # the other way round
    dx = F.least(F.lit(180.0), F.greatest(wide, F.least(dx, around)))
    cos_a, cos_b = (F.when((F.col(f"{s}la0") <= 0) & (F.col(f"{s}la1") >= 0), F.lit(1.0)).otherwise(
        F.cos(F.radians(F.least(F.abs(f"{s}la0"), F.abs(f"{s}la1"))))) for s in (a, b))
    h = F.pow(F.sin(F.radians(dla) / 2), 2) + cos_a * cos_b * F.pow(F.sin(F.radians(dx) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def _side(b: DataFrame, p: str) -> DataFrame:
    return b.select("g", *[F.col(c).alias(p + c) for c in b.columns if c != "g"])


PAIR = ("g", "acx", "acy", "bcx", "bcy")


def _forward():
    return (F.col("bcy") > F.col("acy")) | ((F.col("bcy") == F.col("acy")) & (F.col("bcx") > F.col("acx")))


def _touching(boxes: DataFrame, grid: Grid) -> DataFrame:
    """(g, acx, acy, bcx, bcy) of dense cells with micro boxes that touch across the border and are surely within eps."""
    # boxes of the next micro rows and columns; rows differ in their columns, so columns come from the longitude
    a = _side(boxes, "a").withColumn("_y", F.explode(F.expr(f"transform(sequence(-1, 1), i -> acy * {MICRO} + aby + i)")))
    a = a.withColumn("bcy", F.expr(f"CAST(floor(_y / {MICRO}) AS BIGINT)")).withColumns({"bby": F.expr(f"_y - bcy * {MICRO}"), "_n": F.expr(grid.columns("bcy")) * MICRO})
    a = a.withColumn("_x", F.explode(F.expr("sequence(CAST(floor(ax0 * _n / 360.0) AS BIGINT) - 1, CAST(floor(ax1 * _n / 360.0) AS BIGINT) + 1)")))
    a = a.withColumn("_x", F.expr("pmod(_x, _n)")).withColumns({"bcx": F.expr(f"_x DIV {MICRO}"), "bbx": F.expr(f"_x % {MICRO}")}).filter(_forward())
    touch = a.drop("_x", "_y", "_n").join(_side(boxes, "b"), ["g", "bcx", "bcy", "bbx", "bby"])
    return _checkpoint(touch.filter(_box_upper("a", "b") <= grid.eps_m * (1 - 1e-9)).select(*PAIR).distinct())


def _dense_links(pts: DataFrame, boxes: DataFrame, grid: Grid, labels: DataFrame) -> DataFrame:
    """(alabel, blabel) of components (``labels`` by cell) with dense cells that hold a pair of points within eps.

    Pairs of cells of two components compare their micro boxes, each only those that reach the other cell's
    bounds: surely-close pairs link, surely-far ones drop, pairs of few points compare points, and the others
    are split into 4 x 4 boxes each for the next round, without the components linked meanwhile.
    """
    eps_m, sure_m = grid.eps_m, grid.eps_m * (1 - 1e-9)
    pair, both = list(PAIR), ["alabel", "blabel"]
    cell = boxes.groupBy("g", "cx", "cy").agg(*[(F.min if c[-1] == "0" else F.max)(c).alias(c) for c in BOX]).join(labels, ["g", "cx", "cy"])
    far = F.expr("greatest(abs(ala0), abs(ala1))")
    near = grid.neighbours(_side(cell, "a").withColumn("_far", far), "_far", "ax0", "ax1", "acy", "bcx", "bcy").drop("_far").filter(_forward())
    near = near.join(_side(cell, "b"), ["g", "bcx", "bcy"]).filter((F.col("alabel") != F.col("blabel")) & (_box_lower("a", "b") <= eps_m))
    near = _checkpoint(near.select(*pair, *both, *[F.col(p + c).alias(f"{p}w{c}") for p in "ab" for c in BOX]))
    if near.isEmpty():
        return near.select(*both)
    reach = {p: near.join(_side(boxes, p), ["g", f"{p}cx", f"{p}cy"]).filter(_box_lower(p, f"{o}w") <= eps_m) for p, o in (("a", "b"), ("b", "a"))}
    held = {p: [c for c in _side(boxes, p).columns if c not in pair] for p in "ab"}
    open_ = reach["a"].select(*pair, *both, *held["a"]).join(reach["b"].select(*pair, *held["b"]), pair)
    found, level = None, 0
    point = pts.select("g", "cx", "cy", "la", "lo", "x", "ux", "uy", "w")
    while True:
        open_ = _checkpoint(open_.filter(_box_lower("a", "b") <= eps_m).withColumn("sure", _box_upper("a", "b") <= sure_m))
        sure = open_.filter("sure").select(*both).distinct()
        if open_.isEmpty():
            return sure if found is None else found
        rest = open_.join(sure, both, "left_anti")
        few = (F.col("an") * F.col("bn") <= POINT_PAIRS) | F.lit(level >= 20)
        p = point.select("g", "cx", "cy", "la", "lo", *_box_index(level))
        checked = rest.filter(few).select(*pair, *both, "abx", "aby", "bbx", "bby").join(_side(p, "a"), ["g", "acx", "acy", "abx", "aby"]).join(
            _side(p, "b"), ["g", "bcx", "bcy", "bbx", "bby"])
        checked = checked.filter(F.expr(_hav_sql("ala", "alo", "bla", "blo")) <= eps_m).select(*both)
        now = _checkpoint(sure.unionByName(checked).distinct())
        found = now if found is None else found.unionByName(now)
        rest = rest.filter(~few).join(now, both, "left_anti").select(*pair, *both, "abx", "aby", "bbx", "bby")
        level += 1
        smaller = _boxes(point, level).withColumns({"_px": F.expr("bx DIV 4"), "_py": F.expr("by DIV 4")})
        a, b = (_side(smaller, p).withColumnsRenamed({f"{p}_px": f"{p}px", f"{p}_py": f"{p}py"}) for p in "ab")
        rest = rest.withColumnsRenamed({"abx": "apx", "aby": "apy", "bbx": "bpx", "bby": "bpy"})
        open_ = rest.join(a, ["g", "acx", "acy", "apx", "apy"]).join(b, ["g", "bcx", "bcy", "bpx", "bpy"]).drop("apx", "apy", "bpx", "bpy")
