"""Embedding near-dedup: exact threshold pairs by dual traversal of cover trees.

Vectors of one label are scaled to unit length, where cosine >= ``threshold``
means distance <= ``t``. Equal vectors are first one weighted point. The tree's
upper levels are made by Spark: a label's points are one cell, and a cell with more
than ``CHUNK`` points is split around ``PIVOTS`` of its own, level by level, until
each leaf is a compact cell of at most ``CHUNK`` points. Pairs of cells descend with
the levels: a pair goes on to the pairs of its children only if their balls come
within ``t``. A task builds one leaf's cover tree: nested levels whose radii halve,
each node with the true covering radius of its points.

Trees of the pairs of leaves that remain are joined, and a task traverses the two
together: a node pair is pruned when centre distance less both
radii exceeds ``t``, linked as a whole when centre distance plus both radii is
below ``t``, and else replaced by the pairs of its children; pairs of points are
decided by their cosine in double precision. Tasks return counts of links per
point and a spanning forest of the links — never the pairs themselves — so a
group of near copies costs its size in output.

Defined results: a vector that is null, empty, zero or holds null or non-finite
components, or has no label, links with nothing; so do rows with null ids, which
are returned with a null component; vectors of different lengths do not
link; rows that share an id are rows of their own for counting and one node for
components; exact repeats link with each other; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.cluster import connected_components
from .common import small_side, stage

PIVOTS = 16
CHUNK = 1024
#: rows of a cell that are dealt to its pivots at once, about
PART = 8192
#: distances are good to about 1e-8; within this margin bounds decide nothing
SLACK = 1e-6

KEY = ["label", "dim"]
CELLED = "label string, dim int, parent string, path string, pid bigint, w bigint, vector array<double>, dist double"
TREE = ("label string, dim int, path string, pids binary, weights binary, vectors binary,"
        "levels array<struct<centre:binary,radius:binary,parent:binary>>")
LINKS = "pid bigint, other bigint, n bigint"


class Tree:
    """Cover tree of the rows of ``unit``: levels of nodes, coarse to fine.

    ``levels[k]`` is ``(centre row, radius, points, parent)``; a node's centre is a
    row, it keeps that row as a centre on every finer level (nesting), centres of
    one parent are more than the level's radius apart, every row lies within the
    level's radius of its node's centre, and the last level has every row as a
    node of radius 0."""

    def __init__(self, unit: np.ndarray, levels: list | None = None):
        self.unit = unit
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = levels or []
        if not levels:
            self._build()

    def _build(self) -> None:
        unit, n = self.unit, len(self.unit)
        centre = np.zeros(1, dtype=np.int64)
        owner = np.zeros(n, dtype=np.int64)  # of each row: index of its node
        reach = _distances(unit, unit[:1])[:, 0]  # of each row: distance to its node's centre
        parent = np.zeros(1, dtype=np.int64)
        step = float(reach.max()) if n else 0.0
        while True:
            radius = np.zeros(len(centre))
            np.maximum.at(radius, owner, reach)
            self.levels.append((centre, radius, parent))
            if len(centre) == n:
                return
            step /= 2
            kids, kid_parent = list(centre), list(range(len(centre)))
            if step < 1e-6:  # closer than any bound can tell: all rows are nodes
                new = np.setdiff1d(np.arange(n), centre)
                kids += list(new)
                kid_parent += list(owner[new])
                centre = np.array(kids, dtype=np.int64)
                owner = np.empty(n, dtype=np.int64)
                owner[centre] = np.arange(n)
                reach = np.zeros(n)
            else:
                owner_new = owner.copy()
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(len(centre) + 1))
                for node in range(len(centre)):
                    own = order[cuts[node] : cuts[node + 1]]
                    far = own[reach[own] > step]
                    while len(far):  # the farthest row becomes a centre and takes what is nearer to it
                        c = far[np.argmax(reach[far])]
                        d = _distances(unit[own], unit[c : c + 1])[:, 0]
                        closer = d < reach[own]
                        closer[own == c] = True
                        d[own == c] = 0.0
                        owner_new[own[closer]] = len(kids)
                        reach[own[closer]] = d[closer]
                        kids.append(c)
                        kid_parent.append(node)
                        far = own[reach[own] > step]
                owner = owner_new
                centre = np.array(kids, dtype=np.int64)
            parent = np.array(kid_parent, dtype=np.int64)

    def members(self, level: int) -> list[np.ndarray]:
        """Rows below each node of a level."""
        owner = np.arange(len(self.unit))
        rows = self.levels[-1][0]
        for k in range(len(self.levels) - 1, level, -1):
            owner = self.levels[k][2][owner]
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(self.levels[level][0]) + 1))
        return [rows[order[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class Links:
    """Link counts of the points of one or two chunks, and their components."""

    def __init__(self, weights: np.ndarray):
        self.w = weights
        self.count = np.zeros(len(weights), dtype=np.int64)
        self.root = np.arange(len(weights))

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins the components of ``a[k]`` and ``b[k]`` for all k; a root is the
        smallest point of its component."""
        root = self.root
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (root[root] != root).any():
                root[:] = root[root]

    def whole(self, a: np.ndarray, b: np.ndarray) -> None:
        """All of ``a`` link with all of ``b``; ``a is b``: with one another."""
        if a is b:
            self.count[a] += self.w[a].sum() - self.w[a]
        else:
            self.count[a] += self.w[b].sum()
            self.count[b] += self.w[a].sum()
        both = np.concatenate([a, b])
        self.union(np.full(len(both), a[0]), both)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.count, a, self.w[b])
        np.add.at(self.count, b, self.w[a])
        self.union(a, b)


def traverse(one: Tree, two: Tree, raw_one: np.ndarray, raw_two: np.ndarray, threshold: float, links: Links, shift: int) -> None:
    """Adds to ``links`` all pairs between two trees (``one is two``: within one);
    the second tree's points are numbered from ``shift``."""
    t = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    same = one is two
    a, b = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    depth = max(len(one.levels), len(two.levels))
    for k in range(depth):
        ka, kb = min(k, len(one.levels) - 1), min(k, len(two.levels) - 1)
        if k:
            a, b = _children(one, k, a, b)
            b, a = _children(two, k, b, a)
            if same:  # two children of one node meet once
                up = one.levels[k][2]
                keep = (up[a] != up[b]) | (a <= b)
                a, b = a[keep], b[keep]
        (ca, ra, _), (cb, rb, _) = one.levels[ka], two.levels[kb]
        last = k == depth - 1
        if last:
            break
        d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * _dots(one.unit[ca], two.unit[cb], a, b)))
        reach = ra[a] + rb[b]
        whole = d + reach < t - SLACK
        keep = d - reach <= t + SLACK
        if whole.any():
            below_a, below_b = one.members(ka), two.members(kb)
            for x, y in zip(a[whole].tolist(), b[whole].tolist(), strict=True):
                own = below_a[x]
                links.whole(own, own if same and x == y else below_b[y] + shift)
        keep &= ~whole
        a, b = a[keep], b[keep]
        if not len(a):
            return
    rows_a, rows_b = one.levels[-1][0], two.levels[-1][0]
    near = _dots(one.unit[rows_a], two.unit[rows_b], a, b) >= threshold - SLACK
    x, y = rows_a[a[near]], rows_b[b[near]]
    if same:
        x, y = x[x != y], y[x != y]
    norm_a, norm_b = np.linalg.norm(raw_one, axis=1), np.linalg.norm(raw_two, axis=1)
    for lo in range(0, len(x), 1 << 16):
        p, q = x[lo : lo + (1 << 16)], y[lo : lo + (1 << 16)]
        hit = np.einsum("ij,ij->i", raw_one[p], raw_two[q]) / (norm_a[p] * norm_b[q]) >= threshold
        links.pairs(p[hit], q[hit] + shift)


def _dots(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows ``a[x]`` and ``b[y]``; by one matrix product where
    most pairs are asked for."""
    if 8 * len(x) >= len(a) * len(b):
        return (a @ b.T)[x, y]
    out = np.empty(len(x))
    for lo in range(0, len(x), 1 << 16):
        out[lo : lo + (1 << 16)] = np.einsum("ij,ij->i", a[x[lo : lo + (1 << 16)]], b[y[lo : lo + (1 << 16)]])
    return out


def _children(tree: Tree, level: int, nodes: np.ndarray, partners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node pairs with ``nodes`` replaced by their children on ``level``."""
    if level >= len(tree.levels):
        return nodes, partners
    parent = tree.levels[level][2]
    order = np.argsort(parent, kind="stable")
    first = np.searchsorted(parent[order], np.arange(len(tree.levels[level - 1][0]) + 1))
    n = first[nodes + 1] - first[nodes]
    ends = np.cumsum(n)
    at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - n - first[nodes], n)
    return order[at], np.repeat(partners, n)


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def points_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, points)``: all rows as ``vec_id, label, dim, vector`` (vector null
    if it can link with nothing), and the distinct points, staged with numbers."""
    v = F.col("vector")
    fine = (F.col("label").isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("vector"))
            .withColumn("vector", F.when(fine, v)).withColumn("dim", F.size("vector")))
    points = rows.where("vector is not null").groupBy(*KEY, "vector").agg(F.count(F.lit(1)).alias("w"))
    return rows, stage(points.withColumn("pid", F.monotonically_increasing_id()), "cover-points")


def _centre(vector: str) -> Column:
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(vector, lambda x: x / norm)


def leaves_of(points: DataFrame, threshold: float, pivots: int = PIVOTS, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """``(leaves, pairs)``: points with the ``path`` of their leaf, which has ``chunk``
    points at most, and the pairs of leaves (``path_a``, ``path_b``) whose balls and
    whose ancestors' balls come within the threshold's distance, each leaf with itself
    among them.

    A cell with more points than ``chunk`` is split around ``pivots`` of its points, a
    point goes to the nearest (to one of those that lie in the same direction, by hash),
    so every split makes progress. A cell is met in parts of ``PART`` rows or so."""
    t = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    cell = [*KEY, "path"]
    at = points.select(*KEY, F.lit("0").alias("path"), "pid", "w", "vector")
    nodes = stage(at.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).withColumns({
        "parent": F.col("path"), "centre": F.lit(None).cast("array<double>"), "radius": F.lit(None).cast("double")}), "cover-cells")
    pairs = nodes.select(*KEY, F.col("path").alias("path_a"), F.col("path").alias("path_b"), *[(F.col("n") <= chunk).alias(f"shut_{s}") for s in "ab"])
    leaves, done, shut = [], [], []
    level = 0

    def assign(own: pd.DataFrame, picked: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame(columns=[*KEY, "parent", "path", "pid", "w", "vector", "dist"])
        picked = picked.sort_values("k")
        dots = _unit(np.array(own["vector"].tolist(), dtype=np.float64)) @ np.array(picked["centre"].tolist(), dtype=np.float64).T
        best = dots.max(axis=1)
        same = dots >= best[:, None] - 1e-12
        turn = own["turn"].to_numpy() % same.sum(axis=1) + 1
        place = ((np.cumsum(same, axis=1) == turn[:, None]) & same).argmax(axis=1)
        return own[[*KEY, "path", "pid", "w", "vector"]].rename(columns={"path": "parent"}).assign(
            path=picked["child"].to_numpy()[place], dist=np.sqrt(np.maximum(0.0, 2.0 - 2.0 * best)))

    while True:
        done.append(pairs.where("shut_a and shut_b").select(*KEY, "path_a", "path_b"))
        pairs = pairs.where("not (shut_a and shut_b)")
        small, crowded = nodes.where(F.col("n") <= chunk), nodes.where(F.col("n") > chunk)
        leaves.append(at.join(small_side(small.select(*cell), "cover-small"), cell, "left_semi").select(*cell, "pid", "w", "vector"))
        if crowded.isEmpty():
            break
        shut.append(small.withColumn("parent", F.col("path")))
        parts = small_side(crowded.select(*cell, F.ceil(F.col("n") / PART).cast("int").alias("parts")), "cover-crowded")
        rows = at.join(parts, cell).withColumns({
            "part": F.pmod(F.xxhash64("pid"), F.col("parts")).cast("int"),
            "turn": F.pmod(F.xxhash64("pid", F.lit(-1 - level)), F.lit(1 << 30))})
        first = Window.partitionBy(*cell).orderBy(F.xxhash64("pid", F.lit(level)), "pid")
        chosen = stage(rows.select(*cell, "pid", "vector", "parts").withColumn("k", F.row_number().over(first)).where(F.col("k") <= pivots)
                       .select(*cell, "k", F.concat_ws(".", "path", "k").alias("child"), _centre("vector").alias("centre"), "parts"), "cover-pivots")
        met = chosen.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        key = [*cell, "part"]
        at = stage(rows.groupBy(*key).cogroup(met.groupBy(*key)).applyInPandas(assign, CELLED), "cover-level")
        sizes = at.groupBy(*cell, "parent").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius"))
        nodes = stage(sizes.join(chosen.select(*KEY, F.col("child").alias("path"), "centre"), cell), "cover-cells")
        columns = [*KEY, "parent", "path", "n", "centre", "radius"]
        front = nodes.select(*columns)
        for old in shut:
            front = front.unionByName(old.select(*columns))
        front = stage(front, "cover-front")
        one, two = (front.select(*KEY, F.col("parent").alias(f"path_{s}"), F.col("path").alias(f"kid_{s}"), (F.col("n") <= chunk).alias(f"shut_{s}"),
                                 F.col("centre").alias(f"centre_{s}"), F.col("radius").alias(f"radius_{s}")) for s in "ab")
        squares = F.zip_with("centre_a", "centre_b", lambda x, y: (x - y) * (x - y))
        apart = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda x, y: x + y))
        near = (F.col("kid_a") == F.col("kid_b")) | (apart - F.col("radius_a") - F.col("radius_b") <= t + SLACK)
        once = (F.col("path_a") != F.col("path_b")) | (F.col("kid_a") <= F.col("kid_b"))
        pairs = stage(pairs.drop("shut_a", "shut_b").join(one, [*KEY, "path_a"]).join(two, [*KEY, "path_b"]).where(once & near)
                      .select(*KEY, F.col("kid_a").alias("path_a"), F.col("kid_b").alias("path_b"), "shut_a", "shut_b"), "cover-pairs")
        level += 1
    return reduce(DataFrame.unionByName, leaves), reduce(DataFrame.unionByName, done)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    raw = np.array(pdf["vector"].tolist(), dtype=np.float64)
    tree = Tree(_unit(raw))
    return pd.DataFrame([{
        "label": pdf["label"].iloc[0], "dim": int(pdf["dim"].iloc[0]), "path": pdf["path"].iloc[0],
        "pids": pdf["pid"].to_numpy("<i8").tobytes(), "weights": pdf["w"].to_numpy("<i8").tobytes(),
        "vectors": raw.astype("<f8").tobytes(),
        "levels": [{"centre": c.astype("<i8").tobytes(), "radius": r.astype("<f8").tobytes(), "parent": p.astype("<i8").tobytes()} for c, r, p in tree.levels],
    }])


def _tree(row, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, Tree]:
    raw = np.frombuffer(getattr(row, f"vectors_{side}"), dtype="<f8").reshape(-1, row.dim)
    levels = [(np.frombuffer(x["centre"], "<i8"), np.frombuffer(x["radius"], "<f8"), np.frombuffer(x["parent"], "<i8")) for x in getattr(row, f"levels_{side}")]
    return (np.frombuffer(getattr(row, f"pids_{side}"), "<i8"), np.frombuffer(getattr(row, f"weights_{side}"), "<i8"), raw, Tree(_unit(raw), levels))


def link_points(points: DataFrame, threshold: float, pivots: int = PIVOTS, chunk: int = CHUNK) -> DataFrame:
    """Staged rows of two kinds: ``(pid, null, n)``, links of a point by weight as
    one task saw them, and ``(pid, other, 0)``, a link of a spanning forest."""
    leaves, near = leaves_of(points, threshold, pivots, chunk)
    trees = stage(leaves.groupBy(*KEY, "path").applyInPandas(_build, TREE), "cover-trees")
    body = ["pids", "weights", "vectors", "levels"]
    side = {s: trees.select(*KEY, F.col("path").alias(f"path_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in body]) for s in "ab"}
    pairs = (near.repartition(*KEY, "path_a", "path_b").join(side["a"], [*KEY, "path_a"]).join(side["b"], [*KEY, "path_b"])
             .drop("label"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                pids, w, raw, tree = _tree(row, "a")
                if row.path_a == row.path_b:
                    links = Links(w)
                    traverse(tree, tree, raw, raw, threshold, links, 0)
                else:
                    pids_b, w_b, raw_b, tree_b = _tree(row, "b")
                    links = Links(np.concatenate([w, w_b]))
                    traverse(tree, tree_b, raw, raw_b, threshold, links, len(pids))
                    pids = np.concatenate([pids, pids_b])
                some, leaf = np.flatnonzero(links.count), np.flatnonzero(links.root != np.arange(len(pids)))
                yield pd.DataFrame({
                    "pid": np.concatenate([pids[some], pids[leaf]]),
                    "other": pd.array([None] * len(some) + pids[links.root[leaf]].tolist(), dtype="Int64"),
                    "n": np.concatenate([links.count[some], np.zeros(len(leaf), dtype=np.int64)]),
                })

    return stage(pairs.mapInPandas(run, LINKS), "cover-links")


def near_duplicates(vectors: DataFrame, threshold: float, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", pivots: int = PIVOTS, chunk: int = CHUNK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold: a cosine above 0, 1 at most")
    rows, points = points_of(vectors, id_col, vector_col, label_col)
    links = link_points(points, threshold, pivots, chunk)
    counts = links.where("other is null").groupBy("pid").agg(F.sum("n").alias("n"))
    edges = links.where("other is not null").select(F.col("pid").alias("a"), F.col("other").alias("b"))
    comps = connected_components(edges)
    known = (points.join(counts, "pid", "left").join(comps.select(F.col("node").alias("pid"), F.col("label").alias("comp")), "pid", "left")
             .select(*KEY, "vector", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"),
                     F.coalesce("comp", "pid").alias("comp")))
    found = stage(rows.join(known, [*KEY, "vector"], "left").select("vec_id", "n_links", "comp"), "cover-found")
    least = found.where("comp is not null").groupBy("comp").agg(F.min("vec_id").alias("component_id"))
    out = found.join(least, "comp", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
