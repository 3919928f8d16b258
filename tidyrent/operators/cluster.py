"""Near-duplicate collapse (M3): density clustering on min-max scaled features,
cluster members take the cluster mean, then two keep-first passes.

* identical feature tuples are pre-aggregated into one weighted point (a group
  of a million copies is one point, never a million rows in a join);
* integer-valued features whose scaled step exceeds ``eps`` must be equal for two
  points to be within ``eps``: they are keys; the other features get grid cells of
  diagonal ``eps``, so the points of one cell are within ``eps`` of each other. A
  cell of ``min_samples`` weight is all core and one node of the graph, whatever
  it holds; only the few points of lighter cells are counted one by one, up to
  ``min_samples`` (``near.enough_near``);
* core cells link by their closest pair of points, which bounding boxes decide or
  open level by level (``near.touching``); what is written is one row per pair of
  cells, never pairs of points;
* clusters are connected components of core cells, found with the alternating
  large-star / small-star edge rewrites (Kiveris et al., "Connected Components
  in MapReduce and Beyond", 2014): O(log n) rounds of joins and grouped
  minimums instead of one round per hop of the longest chain; each round's
  edges are checkpointed (reliable checkpoint) so lineage stays short and
  executor loss is survivable;
* a border point joins the smallest neighbouring cluster; the cluster id is the
  smallest ``row_id`` in it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, stage_table
from .dedupe import keep_first
from .joins import join_groups
from .near import DIRECT_PAIRS, enough_near, grid_reach, probes, touching
from .stats import minmax_scale

# --- fixed values: clustering settings of the source ---
FEATURES = ["latitud", "longitud", "dormitorios", "banos", "area", "precio"]
EPS = 0.005
MIN_SAMPLES = 5
SECOND_KEYS = ["area", "dormitorios", "banos", "descripcion"]
# --- end of fixed values ---


def _canon(edges: DataFrame) -> DataFrame:
    """Undirected edge set as (a > b) pairs without self loops or repeats."""
    return (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are re-attached to the node's smallest
    neighbour-or-self."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    m = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return _canon(both.join(m, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are attached to the smallest of them."""
    m = edges.groupBy("a").agg(F.min("b").alias("m"))
    out = edges.join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        m.select("a", F.col("m").alias("b")))
    return _canon(out)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node that has an edge; label = smallest node
    of its component. ``edges``: columns ``a``, ``b`` (undirected). Rounds go on
    until the edges form stars; each round lowers node labels towards their
    component's minimum, so it always ends."""
    cur = cut_lineage(_canon(edges))
    while True:
        cur = cut_lineage(_small_star(_large_star(cur)))
        # converged once the edges form stars: each node (a) has one edge, to a
        # center (b) that is never itself a leaf — then both rewrites are no-ops
        multi = cur.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("a")
        chained = cur.join(cur.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
        if multi.unionByName(chained).isEmpty():
            break
    # converged: stars around each component's minimum
    both = cur.select(F.col("a").alias("node"), F.col("b").alias("n")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("a").alias("n")))
    return both.groupBy("node").agg(F.least(F.col("node"), F.min("n")).alias("label"))


def _split_dims(df: DataFrame, cols: Sequence[str], eps: float) -> tuple[list[str], list[str]]:
    stats = df.agg(*[F.min(c).alias(f"mn_{c}") for c in cols], *[F.max(c).alias(f"mx_{c}") for c in cols],
                   *[F.count_if(F.col(c) != F.floor(F.col(c))).alias(f"nf_{c}") for c in cols]).first()
    eq, grid = [], []
    for c in cols:
        span = (stats[f"mx_{c}"] or 0) - (stats[f"mn_{c}"] or 0)
        if stats[f"nf_{c}"] == 0 and (span == 0 or 1.0 / span > eps):
            eq.append(c)
        else:
            grid.append(c)
    return eq, grid


def cluster_labels(df: DataFrame, cols: Sequence[str] = FEATURES, eps: float = EPS,
                   min_samples: int = MIN_SAMPLES, id_col: str = "row_id", direct: int = DIRECT_PAIRS) -> DataFrame:
    """``(row_id, cluster)`` for rows with every feature present; -1 = noise."""
    cols = list(cols)
    d = df.dropna(subset=cols).select(id_col, *cols)
    eq, grid = _split_dims(d, cols, eps)
    scaled = minmax_scale(d, cols)
    s = [f"{c}_s" for c in cols]
    side = eps / math.sqrt(max(len(grid), 1))  # any two points of one cell are within eps
    dims = [f"{c}_s" for c in grid]
    keys = [f"{c}_s" for c in eq]
    at = {f"i_{c}": F.floor(F.col(c) / F.lit(side)).cast("bigint") for c in dims}
    pts = stage_table(scaled.groupBy(*s).agg(F.count(F.lit(1)).alias("w"), F.min(id_col).alias("pid")).withColumns(at))
    cell = [*keys, *at]
    # a cell of min_samples weight is all core, and one node
    heavy = pts.groupBy(*cell).agg(F.sum("w").alias("cw"), F.count(F.lit(1)).alias("_n"))
    pts = stage_table(join_groups(pts, heavy, cell, "_n").withColumn("heavy", F.col("cw") >= min_samples).drop("cw"))
    light = pts.where("not heavy").withColumnRenamed("pid", "qid")
    core_light = cut_lineage(enough_near(light.select("qid", *keys, *dims), pts.select(*keys, *dims, "w"), dims, keys, eps, min_samples))
    core = pts.where("heavy").unionByName(pts.where("not heavy").join(core_light.withColumnRenamed("qid", "pid"), "pid", "left_semi").select(*pts.columns))
    nodes = core.groupBy(*cell).agg(F.min("pid").alias("cell"), F.count(F.lit(1)).alias("_n"))
    core = stage_table(join_groups(core, nodes, cell, "_n").select(*cell, *dims, "pid", "cell"))
    nodes = core.select("cell", *cell).distinct()
    border = light.join(core_light, "qid", "left_anti").select(F.col("qid").alias("cell"), *cell, *dims)

    reach = grid_reach(len(dims))
    coarse = [f"k_{c}" for c in dims]
    placed = nodes.select(F.col("cell").alias("b"), *keys, *[F.floor(F.col(f"i_{c}") / F.lit(2 * reach)).cast("bigint").alias(f"k_{c}") for c in dims],
                          *[F.col(f"i_{c}").alias(f"j_{c}") for c in dims])

    def meeting(cells: DataFrame) -> DataFrame:
        """Pairs of cells that the grid does not keep apart."""
        probe = probes(cells.select(F.col("cell").alias("a"), *cell), dims, {c: F.col(f"i_{c}") for c in dims}, reach, "k_")
        both = probe.join(placed, [*keys, *coarse])
        for c in dims:
            both = both.where(F.abs(F.col(f"i_{c}") - F.col(f"j_{c}")) <= reach)
        return both.select("a", "b")

    points = core.select("cell", *dims)
    links = touching(cut_lineage(meeting(nodes).where(F.col("a") < F.col("b"))), points, points, dims, side, eps, direct)
    comp = connected_components(links)
    labels = cut_lineage(nodes.select("cell").join(comp.withColumnRenamed("node", "cell"), "cell", "left")
                         .select("cell", F.coalesce("label", "cell").alias("label")))
    by_point = core.select("pid", "cell").join(labels, "cell").select("pid", "label")
    met = touching(cut_lineage(meeting(border)), border.select("cell", *dims), points, dims, side, eps, direct)
    at_border = (met.join(labels.select(F.col("cell").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("label"))
                 .select(F.col("a").alias("pid"), "label"))
    point_label = by_point.unionByName(at_border)
    rows = scaled.join(pts.select(*s, "pid"), s).select(id_col, "pid")
    return (rows.join(point_label, "pid", "left")
            .select(id_col, F.coalesce(F.col("label"), F.lit(-1)).cast("bigint").alias("cluster")))


def collapse_near_duplicates(df: DataFrame, cols: Sequence[str] = FEATURES, eps: float = EPS,
                             min_samples: int = MIN_SAMPLES, id_col: str = "row_id") -> DataFrame:
    """M3: clustered rows take their cluster's mean features; then keep-first
    on the features, then on (area, dormitorios, banos, descripcion)."""
    cols = list(cols)
    lab = cluster_labels(df, cols, eps, min_samples, id_col).where(F.col("cluster") >= 0)
    j = df.join(lab, id_col, "left")
    means = (j.where(F.col("cluster").isNotNull()).groupBy("cluster")
             .agg(*[F.avg(c).alias(f"_m_{c}") for c in cols]))
    upd = j.join(means, "cluster", "left").withColumns(
        {c: F.when(F.col("cluster").isNotNull(), F.col(f"_m_{c}")).otherwise(F.col(c)) for c in cols})
    upd = upd.drop("cluster", *[f"_m_{c}" for c in cols]).select(*df.columns)
    second = [c for c in SECOND_KEYS if c in df.columns]
    out = keep_first(upd, cols, id_col)
    return keep_first(out, second, id_col) if second else out
