"""Spatial and clustering operators against brute force on small inputs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidyrent.operators import cluster as C
from tidyrent.operators import spatial as SP
from tidyrent.plans.catalog import typed_stage


def angles(lat1, lon1, lat2, lon2):
    """Haversine angle for every pair (inputs already in radians)."""
    dlat = lat2[None, :] - lat1[:, None]
    dlon = lon2[None, :] - lon1[:, None]
    a = np.sin(dlat / 2) ** 2 + np.cos(lat1)[:, None] * np.cos(lat2)[None, :] * np.sin(dlon / 2) ** 2
    return 2 * np.arcsin(np.sqrt(np.clip(a, 0, 1)))


def brute_noise(pdf, eps, min_samples, legacy):
    pts = pdf.groupby(["latitud", "longitud"]).size().reset_index(name="w")
    la, lo = pts.latitud.to_numpy(), pts.longitud.to_numpy()
    if not legacy:
        la, lo = np.radians(la), np.radians(lo)
    near = angles(la, lo, la, lo) <= eps
    counts = near @ pts.w.to_numpy()
    core = counts >= min_samples
    kept = core | (near[:, core].any(axis=1))
    return set(zip(pts.latitud[~kept], pts.longitud[~kept]))


@pytest.fixture(scope="module")
def listings(spark, small_dir):
    t = typed_stage(spark, small_dir)
    return t, t.select("row_id", "latitud", "longitud", "distrito").toPandas().dropna(subset=["latitud", "longitud"])


@pytest.mark.parametrize("eps_km,legacy,eps", [(111.19, False, None), (2.0, False, None), (0.3, False, None),
                                               (None, True, 1.0), (None, True, 0.002)])
def test_density_noise_matches_brute_force(spark, listings, eps_km, legacy, eps):
    t, pdf = listings
    kw = {"legacy": legacy}
    if legacy:
        kw["eps"] = eps
        ang = eps
    else:
        kw["eps_km"] = eps_km
        ang = eps_km / 6371.0
    got = {(r.latitud, r.longitud) for r in SP.density_noise_points(t, **kw).collect()}
    assert got == brute_noise(pdf, ang, 5, legacy)


def brute_knn(pdf, k):
    la, lo = np.radians(pdf.latitud.to_numpy()), np.radians(pdf.longitud.to_numpy())
    d = angles(la, lo, la, lo)
    labels = pdf.distrito.to_numpy()
    out = {}
    for i in range(len(pdf)):
        order = np.lexsort((labels, d[i]))  # distance, then label
        top = labels[order[:k]]
        vals, cnt = np.unique(top, return_counts=True)
        best = sorted(zip(-cnt, vals))[0][1]
        out[(pdf.latitud.iloc[i], pdf.longitud.iloc[i])] = best
    return out


def test_knn_vote_matches_brute_force(spark, listings):
    t, pdf = listings
    got = {(r.latitud, r.longitud): r.predicted for r in SP.knn_vote(t, "distrito", 10).collect()}
    want = brute_knn(pdf, 10)
    assert set(got) == set(want)
    diff = [k for k in want if got[k] != want[k]]
    assert not diff, diff[:5]


def test_nearest_reference(spark, listings):
    t, pdf = listings
    refs = spark.createDataFrame([("a", -12.10, -77.10), ("b", -12.15, -77.15), ("c", -12.20, -77.05)],
                                 "name string, latitud double, longitud double")
    got = {(r.latitud, r.longitud): r.name for r in SP.nearest_reference(t, refs, "name").collect()}
    rp = refs.toPandas()
    d = angles(np.radians(pdf.latitud.to_numpy()), np.radians(pdf.longitud.to_numpy()),
               np.radians(rp.latitud.to_numpy()), np.radians(rp.longitud.to_numpy()))
    want = dict(zip(zip(pdf.latitud, pdf.longitud), rp.name.to_numpy()[d.argmin(axis=1)]))
    assert got == want


def test_candidates_hold_the_nearest_at_any_start_side(spark):
    # a dense city, a sparse region, far points and equal coordinates
    rng = np.random.default_rng(4)
    lat = np.concatenate([rng.normal(-12.0, 0.01, 300), rng.uniform(-30, -10, 60), [50.0, 51.0, -12.0, -12.0]])
    lon = np.concatenate([rng.normal(-77.0, 0.01, 300), rng.uniform(-80, -60, 60), [100.0, 10.0, -77.0, -77.0]])
    pts = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))],
                                "i long, lat double, lon double")
    x, y, z = SP._unit(F.col("lat"), F.col("lon"), False)
    pts = pts.select("i", x.alias("x"), y.alias("y"), z.alias("z"))
    qs = pts.select(F.col("i").alias("qid"), "x", "y", "z")
    refs = pts.select(F.col("i").alias("rid"), F.col("i").cast("string").alias("label"), F.lit(1).alias("w"), "x", "y", "z")
    xyz = np.array([[r.x, r.y, r.z] for r in pts.orderBy("i").collect()])
    d = np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(-1))
    for k, side in ((2, 1e-9), (10, 1e-3), (400, 0.5)):
        got = {}
        for r in SP._knn_candidates(qs, refs, k, side).collect():
            got.setdefault(r.qid, []).append(r.d)
        for i in range(len(lat)):
            want = np.sort(d[i])[:k]
            assert np.allclose(sorted(got[i])[:k], want, atol=1e-12)
        if k <= 10:  # a small multiple of k, also for the far points
            assert max(len(v) for v in got.values()) <= max(SP.DIRECT_PER_K, 30) * k
    assert SP._knn_candidates(qs, refs.where("false"), 2, 1e-9).count() == 0


def brute_dbscan_labels(X, ids, eps, min_samples):
    """Reference semantics used here: core = ≥ min_samples within eps (self
    included); components over core–core edges; border → smallest neighbouring
    cluster; cluster id = smallest row id."""
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)) <= eps
    core = d.sum(1) >= min_samples
    n = len(X)
    comp = np.where(core, np.arange(n), -1)
    changed = True
    while changed:
        changed = False
        for i in np.where(core)[0]:
            nb = np.where(d[i] & core)[0]
            m = comp[nb].min()
            if m < comp[i]:
                comp[i] = m
                changed = True
    label_of = {}
    for c in set(comp[core]):
        members = np.where(comp == c)[0]
        label_of[c] = ids[members].min()
    out = np.full(n, -1)
    for i in range(n):
        if core[i]:
            out[i] = label_of[comp[i]]
        else:
            nb = np.where(d[i] & core)[0]
            if len(nb):
                out[i] = min(label_of[comp[j]] for j in nb)
    return out


def test_cluster_labels_match_brute_force(spark, small_dir):
    t = typed_stage(spark, small_dir).where("area <= 700 AND precio <= 2e4 AND latitud > -13")
    got = {r.row_id: r.cluster for r in C.cluster_labels(t).collect()}
    pdf = t.select("row_id", *C.FEATURES).toPandas().dropna()
    X = pdf[C.FEATURES].to_numpy(dtype=float)
    mn, mx = X.min(0), X.max(0)
    span = np.where(mx > mn, mx - mn, 1.0)
    Xs = np.where(mx > mn, (X - mn) / span, 0.0)
    want = dict(zip(pdf.row_id, brute_dbscan_labels(Xs, pdf.row_id.to_numpy(), C.EPS, C.MIN_SAMPLES)))
    assert got == want
    assert sum(v >= 0 for v in got.values()) > 0  # the fixture has near-duplicate groups


def test_collapse_is_idempotent_on_its_output_keys(spark, small_dir):
    t = typed_stage(spark, small_dir).where("area <= 700 AND precio <= 2e4 AND latitud > -13")
    out = C.collapse_near_duplicates(t)
    assert out.count() == out.dropDuplicates(C.FEATURES).count()
    assert out.count() <= t.count()


def test_order_and_partitioning_do_not_change_noise(spark, listings):
    t, _ = listings
    a = {tuple(r) for r in SP.density_noise_points(t, eps_km=0.3).collect()}
    b = {tuple(r) for r in SP.density_noise_points(t.repartition(3).orderBy(F.rand(5)), eps_km=0.3).collect()}
    assert a == b


def test_brute_force_helper_sanity():
    pdf = pd.DataFrame({"latitud": [0.0, 0.0, 0.0, 0.0, 0.0, 50.0], "longitud": [0, 0, 0, 0, 0, 50.0]})
    assert brute_noise(pdf, 0.01, 5, False) == {(50.0, 50.0)}


def test_connected_components_long_chain(spark):
    # a 400-node path (diameter 399), a star and a pair, nodes numbered out of order
    perm = np.random.default_rng(1).permutation(400) + 1000
    path = [(int(perm[i]), int(perm[i + 1])) for i in range(399)]
    star = [(5, j) for j in range(6, 30)]
    pair = [(100, 99)]
    edges = spark.createDataFrame(path + star + pair, "a long, b long")
    got = {r.node: r.label for r in C.connected_components(edges).collect()}
    assert {got[int(p)] for p in perm} == {int(perm.min())}
    assert {got[j] for j in range(5, 30)} == {5}
    assert got[100] == got[99] == 99
    assert len(got) == 400 + 25 + 2


def test_few_references_meet_every_query(spark, monkeypatch):
    """As many references as 27 cells may hold are compared in one pass, with the same result."""
    rows = spark.createDataFrame([(i, -12.0 - (i * 37 % 101) / 50, -77.0 + (i * 53 % 97) / 50) for i in range(200)] + [(200, None, 1.0), (0, -12.0, -77.0)],
                                 "row_id long, latitud double, longitud double")
    refs = spark.createDataFrame([("b", -12.5, -76.5), ("a", -12.5, -76.5), ("c", -13.5, -75.5), ("d", None, 1.0), ("e", 40.0, 2.0)],
                                 "distrito string, latitud double, longitud double")
    few = sorted(map(tuple, SP.nearest_reference(rows, refs, "distrito").collect()))
    assert len(few) == rows.dropna().select("latitud", "longitud").distinct().count() and {r[2] for r in few} == {"a", "c"}
    assert SP.nearest_reference(rows, refs.where("false"), "distrito").count() == 0
    monkeypatch.setattr(SP, "_knn_candidates", lambda *a: pytest.fail("searched round by round"))
    assert sorted(map(tuple, SP.nearest_reference(rows, refs, "distrito").collect())) == few
    monkeypatch.undo()
    monkeypatch.setattr(SP, "DIRECT_PER_K", 1)
    assert sorted(map(tuple, SP.nearest_reference(rows, refs, "distrito").collect())) == few


def test_release_trims_the_driver(spark):
    from tidyrent.session import release, trim_native
    frame = spark.range(10)
    release(spark)
    assert frame.count() == 10 and "Trim" in trim_native(spark)
