"""Queries for the spatial operators (M1, M2, E4, F21) and near-duplicates (M3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators import cluster as C
from ..operators import enrich as E
from ..operators import spatial as SP
from ..operators import stats as S
from ..session import cut_lineage
from . import oracle as O
from .catalog import register, typed_stage
from .queries_wrangle import _GAZ_SQL
from .rules import CRITICAL


@register("spatial_outliers", O.with_tables(f""", {O.noise_sql(SP.chord(SP.ONE_DEGREE_KM / 6371.0), False)}
SELECT latitud, longitud FROM X"""))
def q_spatial_outliers(spark, sf_dir):
    """M1 (correct metric, eps = one degree of arc): the noise coordinates."""
    return SP.density_noise_points(typed_stage(spark, sf_dir))


EPS_KM = (0.001, 0.004, 0.02)


@register("spatial_outliers_near", O.with_tables("".join(
    f", {O.noise_sql(SP.chord(e / 6371.0), False, name=f'X{k}')}" for k, e in enumerate(EPS_KM)) + "\n"
    + " UNION ALL ".join(f"SELECT {e}::DOUBLE AS eps_km, * FROM X{k}" for k, e in enumerate(EPS_KM))))
def q_spatial_outliers_near(spark, sf_dir):
    """M1 at small eps, where many points are sparse, border or noise."""
    t = typed_stage(spark, sf_dir)
    parts = [SP.density_noise_points(t, eps_km=e).select(F.lit(e).alias("eps_km"), "latitud", "longitud") for e in EPS_KM]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_KEPT_SQL = """
SELECT row_id FROM T LEFT JOIN (SELECT *, true AS noise FROM X) USING (latitud, longitud) WHERE noise IS NULL"""


@register("spatial_outliers_legacy", O.with_tables(f", {O.noise_sql(SP.chord(1.0), True)}" + _KEPT_SQL))
def q_spatial_outliers_legacy(spark, sf_dir):
    """M1 with the source's metric (degrees read as radians, eps = 1): rows kept."""
    return SP.drop_density_outliers(typed_stage(spark, sf_dir), legacy=True).select("row_id")


LEGACY_EPS = 2e-5


@register("spatial_outliers_legacy_near", O.with_tables(f", {O.noise_sql(SP.chord(LEGACY_EPS), True)}" + _KEPT_SQL))
def q_spatial_outliers_legacy_near(spark, sf_dir):
    """M1 with the source's metric at an eps that has noise: rows kept."""
    return SP.drop_density_outliers(typed_stage(spark, sf_dir), legacy=True, eps=LEGACY_EPS).select("row_id")


_KNN_SQL = O.with_tables(f""", {O.noise_sql(SP.chord(SP.ONE_DEGREE_KM / 6371.0), False)},
H AS (SELECT T.* FROM T LEFT JOIN (SELECT *, true AS noise FROM X) USING (latitud, longitud) WHERE noise IS NULL),
W AS (SELECT latitud AS lat, longitud AS lon, distrito AS label, count(*) AS w, cos(radians(latitud)) * cos(radians(longitud)) AS x,
        cos(radians(latitud)) * sin(radians(longitud)) AS y, sin(radians(latitud)) AS z
      FROM H WHERE latitud IS NOT NULL AND longitud IS NOT NULL AND distrito IS NOT NULL GROUP BY latitud, longitud, distrito),
S AS (SELECT q.lat, q.lon, min({{'d': sqrt(pow(q.x - r.x, 2) + pow(q.y - r.y, 2) + pow(q.z - r.z, 2)), 'label': r.label, 'lat': r.lat, 'lon': r.lon,
        'w': r.w}}, 10) AS near FROM (SELECT DISTINCT lat, lon, x, y, z FROM W) q JOIN W r ON true GROUP BY q.lat, q.lon),
U AS (SELECT lat, lon, unnest(near) AS u, unnest(range(len(near))) AS k FROM S),
V AS (SELECT lat, lon, u.label AS label, least(u.w, 10 - (sum(u.w) OVER (PARTITION BY lat, lon ORDER BY k) - u.w)) AS take FROM U),
B AS (SELECT lat, lon, label, row_number() OVER (PARTITION BY lat, lon ORDER BY sum(take) DESC, label) AS rk FROM V WHERE take > 0 GROUP BY lat, lon, label)
SELECT row_id, latitud, longitud, coalesce(label, distrito) AS distrito FROM H LEFT JOIN (SELECT * FROM B WHERE rk = 1) ON latitud = lat AND longitud = lon""")


@register("knn_label", _KNN_SQL)
def q_knn_label(spark, sf_dir):
    """M1 then M2: rows after outlier removal with the neighbours' district."""
    t = typed_stage(spark, sf_dir)
    kept = SP.drop_density_outliers(t)
    return SP.relabel_by_neighbours(kept).select("row_id", "latitud", "longitud", "distrito")


_SCALED = ", ".join(f"coalesce(({c} - min({c}) OVER ()) / nullif((max({c}) OVER () - min({c}) OVER ())::DOUBLE, 0), 0.0) AS s_{c}" for c in C.FEATURES)
_SQUARES = " + ".join(f"pow(a.s_{c} - b.s_{c}, 2)" for c in C.FEATURES)


@register("near_duplicate_labels", O.with_tables(f""", N AS (SELECT row_id, {_SCALED} FROM T WHERE {" AND ".join(f"{c} IS NOT NULL" for c in C.FEATURES)}),
P AS (SELECT min(row_id) AS pid, count(*) AS w, {", ".join(f"s_{c}" for c in C.FEATURES)} FROM N GROUP BY ALL),
E AS (SELECT a.pid AS a, b.pid AS b, b.w FROM P a JOIN P b ON b.s_latitud BETWEEN a.s_latitud - {C.EPS} AND a.s_latitud + {C.EPS}
       AND {_SQUARES} <= {C.EPS * C.EPS!r}),
K AS (SELECT a AS pid FROM E GROUP BY a HAVING sum(w) >= {C.MIN_SAMPLES}),
G AS (SELECT a, b FROM E WHERE a IN (SELECT pid FROM K) AND b IN (SELECT pid FROM K)),
R AS (SELECT pid AS a, pid AS b FROM K UNION SELECT R.a, G.b FROM R JOIN G ON R.b = G.a),
CL AS (SELECT a AS pid, min(b) AS label FROM R GROUP BY a),
B AS (SELECT a AS pid, min(label) AS label FROM E JOIN CL ON E.b = CL.pid WHERE a NOT IN (SELECT pid FROM K) GROUP BY a),
Z AS (SELECT * FROM CL UNION ALL SELECT * FROM B)
SELECT N.row_id, coalesce(label, -1) AS cluster FROM N JOIN P USING ({", ".join(f"s_{c}" for c in C.FEATURES)}) LEFT JOIN Z ON P.pid = Z.pid""").replace("WITH L AS", "WITH RECURSIVE L AS", 1))
def q_near_duplicate_labels(spark, sf_dir):
    """M3's clusters of all listings: smallest row id of the cluster, -1 for noise."""
    return C.cluster_labels(typed_stage(spark, sf_dir))


@register("near_duplicates")
def q_near_duplicates(spark, sf_dir):
    """M3 at its place in the job: on all listings after M1, M2 and M4."""
    t = SP.drop_density_outliers(typed_stage(spark, sf_dir).dropna(subset=CRITICAL))
    t = cut_lineage(SP.relabel_by_neighbours(cut_lineage(t)))
    return C.collapse_near_duplicates(cut_lineage(S.low_price_fix(t)))


_REVERSE_SQL = O.with_tables(f""", {_GAZ_SQL},
P AS (SELECT DISTINCT latitud, longitud FROM T WHERE latitud IS NOT NULL AND longitud IS NOT NULL),
D AS (SELECT P.latitud, P.longitud, G.distrito AS ref,
        pow(cos(radians(P.latitud)) * cos(radians(P.longitud)) - cos(radians(G.latitud)) * cos(radians(G.longitud)), 2)
      + pow(cos(radians(P.latitud)) * sin(radians(P.longitud)) - cos(radians(G.latitud)) * sin(radians(G.longitud)), 2)
      + pow(sin(radians(P.latitud)) - sin(radians(G.latitud)), 2) AS d2
      FROM P CROSS JOIN G),
B AS (SELECT latitud, longitud, ref FROM (
        SELECT *, row_number() OVER (PARTITION BY latitud, longitud ORDER BY d2, ref) AS rk FROM D) WHERE rk = 1)
SELECT T.row_id, G.direccion, G.precision, G.type
FROM T JOIN B ON T.latitud = B.latitud AND T.longitud = B.longitud JOIN G ON G.distrito = B.ref""")


@register("reverse_lookup", _REVERSE_SQL)
def q_reverse_lookup(spark, sf_dir):
    """E4 default provider: nearest gazetteer entry of each listing with
    coordinates (grid nearest-neighbour; a few references meet all), J1 back on id."""
    t = typed_stage(spark, sf_dir)
    gaz = E.district_gazetteer(t)
    near = SP.nearest_reference(t, gaz, "distrito")
    hits = t.select("row_id", "latitud", "longitud").join(near.withColumnRenamed("distrito", "ref"),
                                                          ["latitud", "longitud"])
    g = gaz.select(F.col("distrito").alias("ref"), "direccion", "precision", "type")
    return hits.join(g, "ref").select("row_id", "direccion", "precision", "type")


@register("centroid_distance_km", O.with_tables(f""", {_GAZ_SQL}
SELECT T.row_id, T.distrito,
  round(2 * 6371.0 * asin(sqrt(pow(sin(radians(G.latitud - T.latitud) / 2), 2)
        + cos(radians(T.latitud)) * cos(radians(G.latitud)) * pow(sin(radians(G.longitud - T.longitud) / 2), 2))), 6)
    AS dist_km
FROM T JOIN G USING (distrito) WHERE T.latitud IS NOT NULL AND T.longitud IS NOT NULL"""))
def q_centroid_distance_km(spark, sf_dir):
    """haversine km from each listing to its district's centre (equi-join
    on district with the gazetteer, one row per district)."""
    t = typed_stage(spark, sf_dir).where(F.col("latitud").isNotNull() & F.col("longitud").isNotNull())
    g = E.district_gazetteer(t).select("distrito", F.col("latitud").alias("glat"), F.col("longitud").alias("glon"))
    j = t.join(g, "distrito")
    d = N.haversine_km(F.col("latitud"), F.col("longitud"), F.col("glat"), F.col("glon"))
    return j.select("row_id", "distrito", F.round(d, 6).alias("dist_km"))
