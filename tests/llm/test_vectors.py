"""Top-k and cover tree against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidyrent.llm import cover_tree, topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, w string"


def rows_of(seed, n=300, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    v = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * rng.choice([0.01, 0.2, 1.0], (n, 1))
    v[: n // 3] = v[0]  # a third are copies
    rows = [(k, [float(np.float32(x)) for x in u], int(k % 3), "x") for k, u in enumerate(v)]
    odd = [(1000, None, 1, "x"), (1001, [0.0] * dim, 1, "x"), (1002, [None] + [1.0] * (dim - 1), 1, "x"), (1003, [float("nan")] * dim, 1, "x"),
           (1004, [float("inf")] * dim, 1, "x"), (1005, rows[5][1], None, "x"), (1006, [], 1, "x"), (1007, [1.0, 2.0], 1, "x"), (None, rows[6][1], 0, "x")]
    return rows + odd


def finite(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("block_rows", [64, 100_000])
def test_top_k(spark, block_rows):
    rows = rows_of(1)
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, 5, 256.0, block_rows=block_rows)
    q = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, *_ in rows if i is not None and finite(v)]
    expected = set()
    for i, a in q:
        if i % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), j) for j, b in q if j != i)[:5]
            expected |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == expected
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0, 5, 256.0).count() == 0


@pytest.mark.parametrize("threshold,chunk", [(0.93, 16), (0.5, 1024)])
def test_cover_tree(spark, threshold, chunk):
    rows = rows_of(2)
    got = cover_tree.near_duplicates(spark.createDataFrame(rows, SCHEMA), threshold, pivots=3, chunk=chunk).collect()
    ok = [(i, np.array(v, dtype=float), g) for i, v, g, _ in rows if finite(v) and len(v) and any(v) and g is not None]
    links = {k: {m for m, (_, b, h) in enumerate(ok) if m != k and g == h and len(a) == len(b)
                 and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold} for k, (_, a, g) in enumerate(ok)}
    expected = {}
    for k, (i, _, _) in enumerate(ok):
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        if i is not None:
            expected[i] = (len(links[k]), min(ok[m][0] for m in seen if ok[m][0] is not None))
    for i, *_ in rows:
        if i is not None:
            expected.setdefault(i, (0, i))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == expected
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got) and len(got) == len(rows)
    assert cover_tree.near_duplicates(spark.createDataFrame([], SCHEMA), threshold).count() == 0


def test_leaves_are_small_and_far_ones_never_meet(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 16))
    rows = [(k, [float(x) for x in centres[k % 40] + rng.normal(size=16) * 0.05], 1, "x") for k in range(2000)]
    rows += [(5000 + k, [float((k + 1) * x) for x in centres[0]], 1, "x") for k in range(300)]  # one direction, no way to part them
    _, points = cover_tree.points_of(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label")
    leaves, pairs = cover_tree.leaves_of(points, 0.93, pivots=4, chunk=16)
    sizes = {r.path: r["count"] for r in leaves.groupBy("path").count().collect()}
    assert sum(sizes.values()) == points.count() == leaves.select("pid").distinct().count() and max(sizes.values()) <= 16
    met = {(r.path_a, r.path_b) for r in pairs.collect()}
    assert len(met) == pairs.count() and {(p, p) for p in sizes} <= met
    share = len(met) / (len(sizes) * (len(sizes) + 1) / 2)
    assert share < 0.25, share
    v = {r.path: np.array([x.vector for x in leaves.where(F.col("path") == r.path).collect()]) for r in leaves.select("path").distinct().limit(12).collect()}
    for a in v:  # brute force over a few leaves: no pair of leaves with a link is left out
        for b in v:
            if a < b and (cover_tree._unit(v[a]) @ cover_tree._unit(v[b]).T).max() >= 0.93:
                assert (a, b) in met or (b, a) in met


@pytest.mark.parametrize("deal", [1, 64])
def test_top_k_is_the_same_however_queries_are_dealt(spark, deal, monkeypatch):
    monkeypatch.setattr(topk, "DEAL", deal)
    monkeypatch.setattr(topk, "BATCH", 2)
    rows = rows_of(4, 200)
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 10 == 0, 3, 256.0, block_rows=50)
    q = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, *_ in rows if i is not None and finite(v)]
    expected = {(i, k + 1, j, -s) for i, a in q if i % 10 == 0
                for k, (s, j) in enumerate(sorted((-sum(x * y for x, y in zip(a, b, strict=False)), j) for j, b in q if j != i)[:3])}
    assert {tuple(r) for r in got.collect()} == expected


def test_tree_levels_cover_and_nest():
    unit = cover_tree._unit(np.random.default_rng(3).normal(size=(200, 5)))
    tree = cover_tree.Tree(unit)
    for k, (centre, radius, _) in enumerate(tree.levels):
        for c, r, own in zip(centre, radius, tree.members(k), strict=True):
            assert np.linalg.norm(unit[own] - unit[c], axis=1).max() <= r + 1e-7
        if k:
            assert set(tree.levels[k - 1][0]) <= set(centre)
    assert sorted(tree.levels[-1][0]) == list(range(200))
