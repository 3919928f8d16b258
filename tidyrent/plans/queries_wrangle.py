"""Queries for stage 2 (wrangling): de-duplication, flags, classification,
fill-from-text, coordinate fill."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedupe as D
from ..operators import enrich as E
from ..operators import wrangle as W
from . import oracle as O
from .rules import CRITICAL, W1_KEYS
from .catalog import raw, register, typed_stage

W2_KEYS = ["latitud", "longitud", "dormitorios", "banos", "area", "precio"]
W3_KEYS = ["area", "dormitorios", "banos", "descripcion"]


def _keep_first_sql(src: str, keys: list[str]) -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY row_id) AS _rn FROM {src}) WHERE _rn = 1")


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


FLAGS_SQL = " UNION ALL ".join(
    f"SELECT row_id, descripcion, {_lit(var)} AS variable FROM T WHERE {pred}" for var, pred in W.FLAG_RULES)
VERDICTS_SQL = f"""
SELECT row_id, variable,
  CASE WHEN regexp_matches(lower(descripcion), {_lit(E.whole_words(E.APARTMENT_WORDS))}) THEN {_lit(E.APARTMENT)}
       WHEN regexp_matches(lower(descripcion), {_lit(E.whole_words(E.OTHER_PROPERTY_WORDS))}) THEN {_lit(E.NOT_APARTMENT)} END
    AS propiedad,
  CASE WHEN regexp_matches(lower(descripcion), {_lit(E.whole_words(E.SALE_WORD))})
        AND regexp_matches(lower(descripcion), {_lit(E.whole_words(E.RENT_WORD))}) THEN {_lit(E.RENT_AND_SALE)}
       WHEN regexp_matches(lower(descripcion), {_lit(E.whole_words(E.SALE_WORD))}) THEN {_lit(E.SALE)}
       WHEN regexp_matches(lower(descripcion), {_lit(E.whole_words(E.RENT_WORD))}) THEN {_lit(E.RENT)} END AS propuesta
FROM FL"""


def _number_sql(pattern: str, col: str = "descripcion") -> str:
    n = pattern.count("(") - pattern.count("(?") - pattern.count(r"\(")
    parts = [f"regexp_extract(lower({col}), {_lit(pattern)}, {i})" for i in range(1, n + 1)]
    text = parts[0] if n == 1 else "concat(" + ", ".join(parts) + ")"
    return f"TRY_CAST(replace(NULLIF({text}, ''), ',', '.') AS DOUBLE)"


def _extract_sql(src: str) -> str:
    age = _number_sql(E.AGE_PATTERN)
    return f"""SELECT row_id, {_number_sql(E.AREA_PATTERN)} AS area, {_number_sql(E.ROOMS_PATTERN)} AS dormitorios,
      {_number_sql(E.BATHS_PATTERN)} AS banos,
      CASE WHEN {age} > 1000 THEN 2025 - {age} ELSE {age} END AS antiguedad
    FROM {src}"""


_ANY_NULL = "(banos IS NULL OR dormitorios IS NULL OR antiguedad IS NULL OR area IS NULL)"
CANDIDATES_SQL = f"""
NC AS (SELECT count(*) AS n FROM T WHERE NOT {_ANY_NULL}),
SZ AS (SELECT CASE WHEN n < 100 THEN n ELSE CAST(floor(100 + (n - 100) / 2) AS BIGINT) END AS size FROM NC),
SP AS (SELECT row_id, descripcion FROM (
         SELECT row_id, descripcion, row_number() OVER (ORDER BY (row_id * 7919) % 1000003, row_id) AS _rn
         FROM T WHERE antiguedad IS NOT NULL) WHERE _rn <= (SELECT size FROM SZ)),
C AS (SELECT row_id, any_value(descripcion) AS descripcion FROM (
        SELECT row_id, descripcion FROM T WHERE {_ANY_NULL} UNION ALL SELECT row_id, descripcion FROM SP)
      GROUP BY row_id),
X AS ({_extract_sql("C WHERE coalesce(descripcion <> '', false)")})"""


def _tolerance_sql(c: str, tol: float) -> str:
    both = f"T.{c} IS NOT NULL AND X.{c} IS NOT NULL"
    if 0 < tol < 1:
        cond = f"abs(T.{c} - X.{c}) / T.{c} <= {tol}"
    else:
        cond = f"abs(T.{c} - X.{c}) <= {float(tol)}"
    return (f"SELECT {_lit(c)} AS variable, count(*) FILTER (WHERE {both}) AS n_compared, "
            f"CAST(count(*) FILTER (WHERE {both} AND {cond}) AS DOUBLE) / "
            f"NULLIF(count(*) FILTER (WHERE {both}), 0) AS match_rate FROM T JOIN X USING (row_id)")


@register("dedupe_keep_first", O.with_tables(_keep_first_sql("T", W1_KEYS)))
def q_dedupe_keep_first(spark, sf_dir):
    """Keep-first on eight columns (nulls equal)."""
    return D.keep_first(typed_stage(spark, sf_dir), W1_KEYS)


@register("dedupe_two_pass", O.with_tables(
    ", W2 AS (" + _keep_first_sql("T", W2_KEYS) + ")\n" + _keep_first_sql("W2", W3_KEYS)))
def q_dedupe_two_pass(spark, sf_dir):
    """W2 then W3 (order matters)."""
    return D.keep_first(D.keep_first(typed_stage(spark, sf_dir), W2_KEYS), W3_KEYS)


@register("duplicate_descriptions", O.with_tables("""
SELECT row_id, descripcion, n_copies FROM (
  SELECT row_id, descripcion, count(*) OVER (PARTITION BY descripcion) AS n_copies FROM L) WHERE n_copies > 1""",
                                                  upto="L"))
def q_duplicate_descriptions(spark, sf_dir):
    """Every member of a duplicate-description group, sorted descending."""
    df = raw(spark, sf_dir).select("row_id", "descripcion")
    return D.duplicate_groups(df, ["descripcion"]).orderBy(F.col("descripcion").desc(), "row_id")


@register("critical_null_drop", O.with_tables(
    "SELECT * FROM T WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in CRITICAL)))
def q_critical_null_drop(spark, sf_dir):
    """Rows with every critical column present."""
    return typed_stage(spark, sf_dir).dropna(subset=CRITICAL)


@register("anomaly_flags", O.with_tables("SELECT row_id, variable FROM (" + FLAGS_SQL + ")"))
def q_anomaly_flags(spark, sf_dir):
    """P5 + U1: one (row_id, variable) per broken rule, bag semantics."""
    return W.anomaly_flags(typed_stage(spark, sf_dir)).select("row_id", "variable")


_RESOLVE_SQL = O.with_tables(f""", FL AS ({FLAGS_SQL}), V AS ({VERDICTS_SQL}),
DV AS (SELECT row_id,
         max(CASE WHEN coalesce(propiedad = 'departamento', false) AND coalesce(propuesta = 'alquiler', false)
                  THEN 0 ELSE 1 END) AS d,
         list(DISTINCT variable) FILTER (WHERE coalesce(propiedad = 'departamento', false)
                                         AND coalesce(propuesta = 'alquiler', false)) AS vars
       FROM V GROUP BY row_id)
SELECT row_id, descripcion, fecha_publicacion,
  CASE WHEN coalesce(list_contains(vars, 'antiguedad'), false) THEN NULL ELSE antiguedad END AS antiguedad,
  CASE WHEN coalesce(list_contains(vars, 'precio'), false) THEN NULL ELSE precio END AS precio,
  latitud, longitud,
  CASE WHEN coalesce(list_contains(vars, 'dormitorios'), false) THEN NULL ELSE dormitorios END AS dormitorios,
  CASE WHEN coalesce(list_contains(vars, 'banos'), false) THEN NULL ELSE banos END AS banos,
  CASE WHEN coalesce(list_contains(vars, 'area'), false) THEN NULL ELSE area END AS area,
  distrito
FROM T LEFT JOIN DV USING (row_id) WHERE coalesce(d, 0) = 0""")


@register("inconsistent_resolution", _RESOLVE_SQL)
def q_inconsistent_resolution(spark, sf_dir):
    """E1 + M9 (J4 drop, J9 set-null)."""
    t = typed_stage(spark, sf_dir)
    verdicts = W.classify_flags(W.anomaly_flags(t))
    return W.resolve_inconsistent(t, verdicts)


@register("sale_rent_ratio", O.with_tables(f""", FL AS ({FLAGS_SQL}), V AS ({VERDICTS_SQL}),
P AS (SELECT CASE WHEN coalesce(V.propuesta = 'alquiler', false) THEN 'rent' ELSE 'sale' END AS grp, T.precio
      FROM V JOIN T USING (row_id) WHERE V.propiedad = 'departamento'),
M AS (SELECT median(precio) FILTER (WHERE grp = 'sale') AS median_sale,
             median(precio) FILTER (WHERE grp = 'rent') AS median_rent FROM P)
SELECT median_sale, median_rent, median_sale / NULLIF(median_rent, 0) AS ratio,
       coalesce(round(median_sale / NULLIF(median_rent, 0), 0) >= 20, false) AS passed FROM M"""))
def q_sale_rent_ratio(spark, sf_dir):
    """A4 + Q3: flag-weighted medians of sale vs rent prices."""
    t = typed_stage(spark, sf_dir)
    verdicts = W.classify_flags(W.anomaly_flags(t))
    return W.sale_rent_ratio(t, verdicts)


@register("extract_from_text", O.with_tables(_extract_sql("L"), upto="L"))
def q_extract_from_text(spark, sf_dir):
    """E2 (rule provider) + F15 + F14 on every description."""
    return E.rule_extractor(raw(spark, sf_dir).select("row_id", "descripcion")).drop("descripcion")


@register("tolerance_match", O.with_tables(", " + CANDIDATES_SQL + "\n" + " UNION ALL ".join(
    _tolerance_sql(c, t) for c, t in W.FILL_TOLERANCES.items()).join(["SELECT *, coalesce(match_rate >= 0.7, false)"
                                                                      " AS passed FROM (", ")"])))
def q_tolerance_match(spark, sf_dir):
    """M10 selection (nulls + deterministic sample) → E2 → A15 + Q4."""
    t = typed_stage(spark, sf_dir)
    cand = W.fill_candidates(t)
    ext = E.rule_extractor(cand.where(F.coalesce(F.col("descripcion") != "", F.lit(False))))
    return W.match_rates(t, ext)


_FILL_SQL = O.with_tables(", " + CANDIDATES_SQL + """
SELECT T.row_id, T.descripcion, T.fecha_publicacion, coalesce(T.antiguedad, X.antiguedad) AS antiguedad, T.precio,
       T.latitud, T.longitud, coalesce(T.dormitorios, X.dormitorios) AS dormitorios,
       coalesce(T.banos, X.banos) AS banos, coalesce(T.area, X.area) AS area, T.distrito
FROM T LEFT JOIN X USING (row_id)""")


@register("fill_from_text", _FILL_SQL)
def q_fill_from_text(spark, sf_dir):
    """F16 + J6 — nulls filled from the extracted attributes."""
    t = typed_stage(spark, sf_dir)
    cand = W.fill_candidates(t)
    ext = E.rule_extractor(cand.where(F.coalesce(F.col("descripcion") != "", F.lit(False))))
    return W.fill_from_text(t, ext.select("row_id", *W.FILL_TOLERANCES))


_FILLED_SQL = ("FT AS (SELECT T.row_id, coalesce(T.antiguedad, X.antiguedad) AS antiguedad, "
               "coalesce(T.dormitorios, X.dormitorios) AS dormitorios, coalesce(T.banos, X.banos) AS banos, "
               "coalesce(T.area, X.area) AS area FROM T LEFT JOIN X USING (row_id))")


@register("nulls_filled", O.with_tables(", " + CANDIDATES_SQL + ", " + _FILLED_SQL + "\n" + " UNION ALL ".join(
    f"SELECT {_lit(c)} AS variable, (SELECT count(*) FROM T WHERE {c} IS NULL) AS n_before, "
    f"(SELECT count(*) FROM FT WHERE {c} IS NULL) AS n_after" for c in W.FILL_TOLERANCES)))
def q_nulls_filled(spark, sf_dir):
    """A16 + Q8: nulls per attribute before and after the fill."""
    from ..operators.stats import null_counts
    t = typed_stage(spark, sf_dir)
    cand = W.fill_candidates(t)
    ext = E.rule_extractor(cand.where(F.coalesce(F.col("descripcion") != "", F.lit(False))))
    filled = W.fill_from_text(t, ext.select("row_id", *W.FILL_TOLERANCES))
    cols = list(W.FILL_TOLERANCES)
    before = null_counts(t, cols).withColumnRenamed("n_null", "n_before")
    after = null_counts(filled, cols).withColumnRenamed("n_null", "n_after")
    return before.join(after, "column").withColumnRenamed("column", "variable")


_GAZ_SQL = """G AS (SELECT distrito || ', Lima, Perú.' AS direccion, distrito,
              round(sum(CAST(round(latitud * 1e6) AS BIGINT)) / count(*)) / 1e6 AS latitud,
              round(sum(CAST(round(longitud * 1e6) AS BIGINT)) / count(*)) / 1e6 AS longitud,
              'APPROXIMATE' AS precision, 'locality' AS type
       FROM T WHERE latitud IS NOT NULL AND longitud IS NOT NULL AND distrito IS NOT NULL GROUP BY distrito)"""


@register("address_lookup", O.with_tables(f""", {_GAZ_SQL},
R AS (SELECT row_id, distrito,
        coalesce(NULLIF(NULLIF(CASE WHEN NULLIF(trim(regexp_extract(descripcion, {_lit(E.ADDRESS_PATTERN)}, 1)), '')
                                         IS NOT NULL
                               THEN concat_ws(', ', trim(regexp_extract(descripcion, {_lit(E.ADDRESS_PATTERN)}, 1)),
                                              distrito, 'Lima, Perú.') END, ''), 'null'),
                 distrito || ', Lima, Perú.') AS direccion
      FROM T WHERE latitud IS NULL AND longitud IS NULL AND coalesce(descripcion <> '', false)),
A AS (SELECT R.row_id, R.direccion,
        coalesce(g1.latitud, g2.latitud) AS la, CASE WHEN g1.latitud IS NOT NULL THEN g1.longitud ELSE g2.longitud END AS lo,
        CASE WHEN g1.latitud IS NOT NULL THEN g1.precision ELSE g2.precision END AS p,
        CASE WHEN g1.latitud IS NOT NULL THEN g1.type ELSE g2.type END AS t
      FROM R LEFT JOIN G g1 ON R.direccion = g1.direccion LEFT JOIN G g2 ON R.distrito = g2.distrito)
SELECT T.row_id, T.descripcion, T.fecha_publicacion, T.antiguedad, T.precio,
  CASE WHEN T.latitud IS NULL AND A.la IS NOT NULL THEN A.la ELSE T.latitud END AS latitud,
  CASE WHEN T.latitud IS NULL AND A.la IS NOT NULL THEN A.lo ELSE T.longitud END AS longitud,
  T.dormitorios, T.banos, T.area, T.distrito,
  CASE WHEN T.latitud IS NULL AND A.la IS NOT NULL THEN A.direccion END AS direccion,
  CASE WHEN T.latitud IS NULL AND A.la IS NOT NULL THEN A.p END AS precision,
  CASE WHEN T.latitud IS NULL AND A.la IS NOT NULL THEN A.t END AS type
FROM T LEFT JOIN A USING (row_id)"""))
def q_address_lookup(spark, sf_dir):
    """E3 rule address + F17 → E5 gazetteer join → J8 conditional update."""
    t = typed_stage(spark, sf_dir)
    return W.fill_coordinates(t, E.district_gazetteer(t))
