"""DBSCAN against a brute-force numpy DBSCAN (core partition, noise, border rule)."""

import numpy as np

from roadrisk.operators.dbscan import dbscan

R = 6371000.0


def _brute(lat, lon, grp, eps, ms):
    n = len(lat)
    la, lo = np.radians(lat), np.radians(lon)
    d = 2 * R * np.arcsin(np.sqrt(np.minimum(1.0, np.sin((la[:, None] - la[None, :]) / 2) ** 2
                                             + np.cos(la[:, None]) * np.cos(la[None, :]) * np.sin((lo[:, None] - lo[None, :]) / 2) ** 2)))
    same = grp[:, None] == grp[None, :]
    nb = (d <= eps) & same
    core = nb.sum(1) >= ms
    label = np.where(core, np.arange(n), -1)
    changed = True
    while changed:
        changed = False
        for i in np.where(core)[0]:
            js = np.where(nb[i] & core)[0]
            m = label[js].min()
            if m < label[i]:
                label[i] = m
                changed = True
    border = {}
    for i in np.where(~core)[0]:
        js = np.where(nb[i] & core)[0]
        if len(js):
            border[i] = label[js].min()
    return core, label, border


def test_dbscan_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    pts = []
    # a hot spot (many duplicates and a dense blob), a chain of cores, sparse noise, two groups
    for _ in range(300):
        pts.append((41.80 + rng.normal(0, 0.0004), -87.60 + rng.normal(0, 0.0005), 1))
    pts += [(41.80, -87.60, 1)] * 40
    for k in range(60):
        pts.append((41.81 + k * 0.0012 + rng.normal(0, 0.0001), -87.62 + rng.normal(0, 0.0001), 1))
        pts.append((41.81 + k * 0.0012 + rng.normal(0, 0.0001), -87.62 + rng.normal(0, 0.0001), 1))
        pts.append((41.81 + k * 0.0012 + rng.normal(0, 0.0001), -87.6202 + rng.normal(0, 0.0001), 1))
    for _ in range(200):
        pts.append((41.7 + rng.random() * 0.2, -87.7 + rng.random() * 0.2, 1 if rng.random() < 0.5 else 2))
    for _ in range(80):
        pts.append((41.80 + rng.normal(0, 0.0006), -87.60 + rng.normal(0, 0.0006), 2))
    lat = np.array([p[0] for p in pts]); lon = np.array([p[1] for p in pts]); grp = np.array([p[2] for p in pts])
    core, label, border = _brute(lat, lon, grp, 250.0, 12)
    rows = [(i, float(lat[i]), float(lon[i]), int(grp[i])) for i in range(len(pts))]
    df = spark.createDataFrame(rows, "crash_id long, lat double, lon double, community_area_number int")
    out = {r["crash_id"]: r for r in dbscan(df).collect()}
    assert len(out) == len(pts)
    for i in range(len(pts)):
        r = out[i]
        assert bool(r["is_core"]) == bool(core[i]), i
    # same core partition: label equality <-> component equality
    lab_s = {i: out[i]["core_label"] for i in range(len(pts)) if core[i]}
    for i in lab_s:
        assert lab_s[i] == label[i], i
    # border and noise
    cid = {i: out[i]["cluster_id"] for i in range(len(pts))}
    core_cid = {label[i]: cid[i] for i in range(len(pts)) if core[i]}
    for i in range(len(pts)):
        if not core[i]:
            exp = core_cid[border[i]] if i in border else -1
            assert cid[i] == exp, i
    # ids are 0..k-1 ordered by (group, smallest core id)
    keys = sorted({(int(grp[i]), int(label[i])) for i in range(len(pts)) if core[i]})
    for rank, (g, l) in enumerate(keys):
        assert core_cid[l] == rank


def test_dense_cells_linked_only_within_eps(spark):
    import math
    lat0, lon0 = 41.85, -87.65
    m_lat = 1 / 111194.93  # degrees per metre along a meridian (R = 6371 km)
    m_lon = m_lat / math.cos(math.radians(lat0))
    rows, k = [], 0
    for bearing, gap, grp in [(0, 240, 1), (0, 260, 2), (90, 240, 3), (90, 260, 4), (45, 240, 5), (45, 262, 6)]:
        dy, dx = math.cos(math.radians(bearing)) * gap, math.sin(math.radians(bearing)) * gap
        for c in range(2):  # two tight clumps of 15 points (dense cells), gap metres apart
            for i in range(15):
                rows.append((k, lat0 + (dy * c + (i % 3) * 0.05) * m_lat, lon0 + (dx * c + (i // 3) * 0.05) * m_lon, grp))
                k += 1
    lat = np.array([r[1] for r in rows]); lon = np.array([r[2] for r in rows]); grp = np.array([r[3] for r in rows])
    core, label, _ = _brute(lat, lon, grp, 250.0, 12)
    df = spark.createDataFrame(rows, "crash_id long, lat double, lon double, community_area_number int")
    out = {r["crash_id"]: r for r in dbscan(df).collect()}
    for i in range(len(rows)):
        assert out[i]["is_core"] and out[i]["core_label"] == label[i], i
    merged = {g: len({out[i]["cluster_id"] for i in range(len(rows)) if grp[i] == g}) for g in range(1, 7)}
    assert merged == {1: 1, 2: 2, 3: 1, 4: 2, 5: 1, 6: 2}


def _check(spark, pts, eps=250.0, ms=12):
    """Core flags, component labels, border labels and noise against the brute force."""
    lat, lon, grp = (np.array([p[k] for p in pts]) for k in range(3))
    core, label, border = _brute(lat, lon, grp, eps, ms)
    df = spark.createDataFrame([(i, float(a), float(o), int(g)) for i, (a, o, g) in enumerate(pts)],
                               "crash_id long, lat double, lon double, community_area_number int")
    out = {r["crash_id"]: r for r in dbscan(df, eps_m=eps, min_samples=ms).collect()}
    assert len(out) == len(pts)
    cluster = {}
    for i in range(len(pts)):
        assert out[i]["is_core"] == bool(core[i]), (i, pts[i])
        if core[i]:
            assert out[i]["core_label"] == label[i], (i, pts[i])
            cluster[label[i]] = out[i]["cluster_id"]
    for i in range(len(pts)):
        if not core[i]:
            assert out[i]["cluster_id"] == (cluster[border[i]] if i in border else -1), (i, pts[i])
    return out


def test_poles_date_line_and_stray_latitudes(spark):
    rng = np.random.default_rng(3)
    m = 1 / 111194.93
    pts = [(10 + rng.normal(0, 60 * m), ((180 + rng.normal(0, 60 * m)) + 180) % 360 - 180, 1) for _ in range(40)]  # one cluster over the line
    pts += [(90 - abs(rng.normal(0, 90 * m)), rng.uniform(-180, 180), 1) for _ in range(40)]  # around a pole
    pts += [(-89.9 + rng.normal(0, 50 * m), rng.normal(20, 0.02), 1) for _ in range(30)]
    pts += [(41.6 + rng.normal(0, 100 * m), -87.6 + rng.normal(0, 100 * m), 1) for _ in range(40)]
    pts += [(90.0, 7.0, 1), (-90.0, 0.0, 1), (0.0, 180.0, 1), (0.0, -180.0, 1), (89.0, 0.0, 1)]
    pts += [(60 + rng.normal(0, 300 * m), rng.choice([-179.9999, 179.9999]) + rng.normal(0, 1e-5), 1) for _ in range(30)]
    out = _check(spark, pts)
    assert len({out[i]["cluster_id"] for i in range(40)} - {-1}) == 1


def test_long_chain_is_one_cluster(spark):
    """330 dense cells in a row, ids running against the chain and at random."""
    m = 1 / 111194.93
    for order in ("down", "random"):
        ids = list(range(330 * 12))
        ids.reverse() if order == "down" else np.random.default_rng(1).shuffle(ids)
        rows = [(int(ids[k * 12 + j]), 41.0 + k * 200 * m, -87.0 + j * 0.5 * m, 1) for k in range(330) for j in range(12)]
        df = spark.createDataFrame(rows, "crash_id long, lat double, lon double, community_area_number int")
        out = dbscan(df).select("cluster_id", "core_label").distinct().collect()
        assert [tuple(r) for r in out] == [(0, 0)]


def test_hot_neighbouring_boxes_are_not_compared_point_by_point(spark):
    """Two bands of 30,000 distinct points each, their nearest points 249 m or 251 m apart."""
    m = 1 / 111194.93
    rng = np.random.default_rng(5)
    for gap, clusters in ((249.0, 1), (251.0, 2)):
        a = [(41.0 - rng.uniform(0.0, 3.0) * m, -87.0 + rng.uniform(0, 3) * m) for _ in range(30_000)] + [(41.0, -87.0)]
        b = [(41.0 + (gap + rng.uniform(0.0, 3.0)) * m, -87.0 + rng.uniform(0, 3) * m) for _ in range(30_000)] + [(41.0 + gap * m, -87.0)]
        rows = [(i, la, lo, 1) for i, (la, lo) in enumerate(a + b)]
        df = spark.createDataFrame(rows, "crash_id long, lat double, lon double, community_area_number int")
        assert dbscan(df).select("cluster_id").distinct().count() == clusters


def test_dense_area_compares_touching_boxes_only(spark, monkeypatch):
    """A field that is dense throughout is one component by its touching boxes: no further pair of cells is opened."""
    from roadrisk.operators import dbscan as module

    rng = np.random.default_rng(9)
    rows = [(i, 41.0 + float(a) * 0.02, -87.0 + float(b) * 0.02, 1) for i, (a, b) in enumerate(rng.random((6000, 2)))]
    df = spark.createDataFrame(rows, "crash_id long, lat double, lon double, community_area_number int")
    sizes, plain = [], module._checkpoint

    def kept(d):
        out = plain(d)
        if "sure" in out.columns:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(module, "_checkpoint", kept)
    assert [tuple(r) for r in dbscan(df).select("cluster_id", "core_label").distinct().collect()] == [(0, 0)]
    assert not any(sizes)


def test_neighbour_counts_of_tiles_in_parts(spark, monkeypatch):
    """Hot tiles dealt to several tasks, blocks of few points, the date line, a pole and copies: counts as by all pairs."""
    from roadrisk.operators import dbscan as module
    from roadrisk.operators import nearby

    rng = np.random.default_rng(5)
    pts = [(41.7 + rng.uniform(0, 0.008), -87.8 + rng.uniform(0, 0.011), 1) for _ in range(700)] + [(41.703, -87.795, 1)] * 30
    pts += [(10 + rng.uniform(0, 0.008), (179.995 + rng.uniform(0, 0.01) + 180) % 360 - 180, g) for g in (1, None) for _ in range(150)]
    pts += [(89.999 + rng.uniform(0, 0.001), rng.uniform(-180, 180), 2) for _ in range(150)]
    la, lo, grp = (np.array([-1 if p[k] is None else p[k] for p in pts]) for k in range(3))
    df = spark.createDataFrame([(i, *map(float, p[:2]), p[2]) for i, p in enumerate(pts)], "crash_id long, lat double, lon double, community_area_number int")
    a, o = np.radians(la), np.radians(lo)
    d = 2 * R * np.arcsin(np.sqrt(np.minimum(1.0, np.sin((a[:, None] - a) / 2) ** 2 + np.cos(a[:, None]) * np.cos(a) * np.sin((o[:, None] - o) / 2) ** 2)))
    want = ((d <= 250) & (grp[:, None] == grp)).sum(1)
    monkeypatch.setattr(module, "PART", 60)
    got = {r["crash_id"]: r["neighbours"] for r in module.eps_neighbours(df).collect()}
    assert [got[i] for i in range(len(pts))] == want.tolist()
    monkeypatch.setattr(nearby, "FEW", 0)
    monkeypatch.setattr(nearby, "PAIRS", 100)
    for some in (grp == 1) & (la > 41), grp == -1, grp == 2:
        assert nearby.count_within(la[some], lo[some], la[some], lo[some], np.ones(some.sum(), int), 250.0).tolist() == want[some].tolist()


def test_points_are_dealt_to_few_tiles(spark):
    """A point goes to the tiles within its reach, twice or three times in all, not to each cell in reach."""
    from roadrisk.operators.dbscan import TILE, Grid

    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(float(rng.uniform(41.6, 41.9)), float(rng.uniform(92, 92.4))) for _ in range(2000)], "la double, x double")
    assert Grid(250.0, TILE * 250.0).within_reach(df, "la", "x", "cx", "cy").count() < 3 * 2000
