"""Queries for stage 3 (cleaning): price correction, fences, rejects, rare
combinations, binning, folds, scaling, profiles, sampling, imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T
from ..operators import binning as B
from ..operators import impute as I
from ..operators import quality as Q
from ..operators import stats as S
from ..operators.sampling import contiguous_folds
from ..operators.wrangle import fill_candidates
from ..session import read_table, stage
from . import oracle as O
from .catalog import register, typed, typed_stage
from .queries_wrangle import CANDIDATES_SQL
from .rules import CRITICAL, REJECT_RULES

T_COLS = ["row_id", "descripcion", "fecha_publicacion", "antiguedad", "precio", "latitud", "longitud",
          "dormitorios", "banos", "area", "distrito"]
SIX = ["latitud", "longitud", "dormitorios", "banos", "area", "precio"]



def _round_dec(expr: str, digits: int) -> str:
    """DuckDB rounding with Spark's HALF_UP-on-decimal semantics."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


@register("low_price_fix", O.with_tables(f""", M AS (SELECT distrito, median(precio / area) AS med FROM T GROUP BY distrito),
X AS (SELECT T.*, CASE WHEN coalesce(2.1 * (T.precio / T.area) < M.med, false) THEN T.precio * 3.7::DOUBLE
                       ELSE T.precio END AS p2 FROM T LEFT JOIN M USING (distrito))
SELECT row_id, descripcion, fecha_publicacion, antiguedad, p2 AS precio, latitud, longitud, dormitorios, banos,
       area, distrito FROM X WHERE NOT coalesce(p2 / area < 10, false)"""))
def q_low_price_fix(spark, sf_dir):
    """M4 + P7: per-district dollar correction then the price/m² floor."""
    return S.low_price_fix(typed_stage(spark, sf_dir))


_RATIO_SQL = f""", D AS (SELECT distrito, precio / area AS pm2 FROM T),
M AS (SELECT distrito, median(pm2) AS median_precioxm2 FROM D GROUP BY distrito HAVING count(pm2) > 0),
LO AS (SELECT D.distrito, median(D.pm2) AS median_low FROM D JOIN M USING (distrito)
       WHERE 2.1 * D.pm2 < M.median_precioxm2 GROUP BY D.distrito),
R AS (SELECT M.distrito, M.median_precioxm2, LO.median_low,
        CASE WHEN LO.median_low IS NULL OR LO.median_low = 0 THEN 0.0
             ELSE {_round_dec('M.median_precioxm2 / LO.median_low', 2)} END AS ratio
      FROM M LEFT JOIN LO USING (distrito))"""


@register("district_price_ratio", O.with_tables(_RATIO_SQL + "\nSELECT * FROM R"))
def q_district_price_ratio(spark, sf_dir):
    """A2: per district, median price/m², median of the low rows, ratio (2 d.p.)."""
    return S.price_ratios(typed_stage(spark, sf_dir))


@register("price_ratio_check", O.with_tables(_RATIO_SQL + f"""
SELECT {_round_dec('avg(ratio)', 10)} AS mean_ratio, median(ratio) AS median_ratio,
       {_round_dec('(avg(ratio) + median(ratio)) / 2', 10)} AS global_ratio, count(ratio) AS n_districts,
       coalesce((avg(ratio) + median(ratio)) / 2 >= 2, false) AS passed FROM R"""))
def q_price_ratio_check(spark, sf_dir):
    """A3 + Q5: (mean + median) / 2 of the district ratios, check ≥ 2."""
    g = S.global_ratio(S.price_ratios(typed_stage(spark, sf_dir)))
    return g.select(F.round("mean_ratio", 10).alias("mean_ratio"), "median_ratio",
                    F.round("global_ratio", 10).alias("global_ratio"), "n_districts",
                    F.coalesce(F.col("global_ratio") >= 2, F.lit(False)).alias("passed"))


@register("iqr_fence", O.with_tables(""", D AS (SELECT *, precio / area AS precioxm2 FROM T),
Q AS (SELECT distrito, quantile_cont(precioxm2, 0.25) AS q1, quantile_cont(precioxm2, 0.75) AS q3
      FROM D GROUP BY distrito)
SELECT D.* FROM D LEFT JOIN Q USING (distrito) WHERE NOT coalesce(D.precioxm2 > Q.q3 + 2.5 * (Q.q3 - Q.q1), false)"""))
def q_iqr_fence(spark, sf_dir):
    """A7 + M8: drop rows above their district's Q3 + 2.5·IQR."""
    return S.iqr_fence(S.with_price_m2(typed_stage(spark, sf_dir)))


def reject_extremes(df):
    """Drop rows matching any reject rule (a null predicate keeps the row)."""
    out = df
    for rule in REJECT_RULES:
        out = out.where(~F.coalesce(F.expr(rule), F.lit(False)))
    return out


@register("extreme_rejects", O.with_tables(", D AS (SELECT *, precio / area AS precioxm2 FROM T)\nSELECT * FROM D WHERE "
                                           + " AND ".join(f"NOT coalesce({r}, false)" for r in REJECT_RULES)))
def q_extreme_rejects(spark, sf_dir):
    return reject_extremes(S.with_price_m2(typed_stage(spark, sf_dir)))


@register("rare_combos", O.with_tables(""", K AS (SELECT row_id, dormitorios, banos,
    coalesce(CAST(dormitorios AS VARCHAR), 'nan') || ',' || coalesce(CAST(banos AS VARCHAR), 'nan') AS dorm_ban FROM T),
R AS (SELECT dorm_ban FROM K GROUP BY dorm_ban HAVING count(*) <= 3)
SELECT * FROM K WHERE dorm_ban NOT IN (SELECT dorm_ban FROM R)"""))
def q_rare_combos(spark, sf_dir):
    """F20 + A6 + M7: drop rows whose (dormitorios, banos) pair occurs ≤ 3 times."""
    t = typed_stage(spark, sf_dir).select("row_id", "dormitorios", "banos")
    kept = S.drop_rare_combinations(t)
    return kept.withColumn("dorm_ban", T.combo_key(F.col("dormitorios"), F.col("banos")))


_EPS = repr(B.EPS)
_BIN_SQL = f""", H AS (SELECT antiguedad AS x, count(*) AS n, sum(precio) AS s, sum(precio * precio) AS ss FROM T
       WHERE antiguedad IS NOT NULL AND precio IS NOT NULL GROUP BY antiguedad),
R0 AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx, sum(n) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS nl,
         sum(s) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS sl, sum(n) OVER () AS nt, sum(s) OVER () AS st,
         sum(ss) OVER () AS sst FROM H),
C0 AS (SELECT CASE WHEN x / 2 + nx / 2 = nx THEN x ELSE x / 2 + nx / 2 END AS t FROM R0
       WHERE nx IS NOT NULL AND sst / nt - pow(st / nt, 2) > {_EPS}
       ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, x LIMIT 1),
H1 AS (SELECT *, (x <= (SELECT t FROM C0)) AS node FROM H WHERE EXISTS (SELECT 1 FROM C0)),
R1 AS (SELECT node, x, lead(x) OVER (PARTITION BY node ORDER BY x) AS nx,
         sum(n) OVER (PARTITION BY node ORDER BY x ROWS UNBOUNDED PRECEDING) AS nl,
         sum(s) OVER (PARTITION BY node ORDER BY x ROWS UNBOUNDED PRECEDING) AS sl,
         sum(n) OVER (PARTITION BY node) AS nt, sum(s) OVER (PARTITION BY node) AS st,
         sum(ss) OVER (PARTITION BY node) AS sst FROM H1),
C1 AS (SELECT t FROM (SELECT CASE WHEN x / 2 + nx / 2 = nx THEN x ELSE x / 2 + nx / 2 END AS t,
         row_number() OVER (PARTITION BY node ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, x) AS rk
       FROM R1 WHERE nx IS NOT NULL AND sst / nt - pow(st / nt, 2) > {_EPS}) WHERE rk = 1),
TH AS (SELECT t FROM C0 UNION ALL SELECT t FROM C1),
MX AS (SELECT max(antiguedad) AS mx FROM T)
SELECT row_id, antiguedad,
  CASE WHEN antiguedad > -1 AND antiguedad <= (SELECT mx FROM MX) + 1
       THEN 'Grupo ' || CAST(1 + (SELECT count(*) FROM TH WHERE t > 0 AND t < antiguedad) AS VARCHAR)
       ELSE 'desconocido' END AS antiguedad_categoria
FROM T"""


@register("supervised_bins", O.with_tables(_BIN_SQL))
def q_supervised_bins(spark, sf_dir):
    """M6 + F25: depth-2 split search on age → price, right-closed bins."""
    t = typed_stage(spark, sf_dir)
    return B.supervised_bins(t).select("row_id", "antiguedad", "antiguedad_categoria")


@register("kfold_sizes", O.with_tables("""
SELECT fold, count(*) AS n FROM (SELECT ntile(10) OVER (ORDER BY row_id) AS fold FROM T WHERE area IS NOT NULL)
GROUP BY fold"""))
def q_kfold_sizes(spark, sf_dir):
    """Ten contiguous folds of the rows with a known area."""
    known = typed_stage(spark, sf_dir).where(F.col("area").isNotNull()).select("row_id")
    return contiguous_folds(known, 10).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("mean_baseline_mape", O.with_tables(f""", K AS (SELECT row_id, area, ntile(10) OVER (ORDER BY row_id) AS fold
       FROM T WHERE area IS NOT NULL),
SF AS (SELECT fold, count(*) AS n, sum(area) AS s FROM K GROUP BY fold),
TOT AS (SELECT sum(n) AS tn, sum(s) AS ts FROM SF),
M AS (SELECT K.fold, avg(abs(K.area - (TOT.ts - SF.s) / (TOT.tn - SF.n)) / greatest(abs(K.area), {_EPS})) AS mape
      FROM K JOIN SF USING (fold) CROSS JOIN TOT GROUP BY K.fold)
SELECT {_round_dec('avg(mape)', 10)} AS mape_trimmed, (SELECT count(*) FROM M) AS n_folds
FROM (SELECT mape, row_number() OVER (ORDER BY mape) AS rn, count(*) OVER () AS c FROM M) WHERE rn > 1 AND rn < c"""))
def q_mean_baseline_mape(spark, sf_dir):
    """A13 + A14: K-fold MAPE of the training-mean baseline, trimmed mean."""
    return I.mean_baseline_mape(typed_stage(spark, sf_dir))


_ORDERS_SQL = """SELECT l_orderkey AS row_id, sum(l_extendedprice * (1 - l_discount)) AS revenue, count(*) AS n_lines,
  sum(l_quantity) AS quantity, avg(nullif(l_discount, 0)) AS discount, avg(l_tax) AS tax FROM {lineitem} GROUP BY l_orderkey"""


@register("forest_check", f"""WITH T AS ({_ORDERS_SQL.format(lineitem="lineitem")}),
K AS (SELECT row_id, revenue AS y, ntile(10) OVER (ORDER BY row_id) AS fold FROM T WHERE revenue IS NOT NULL),
SF AS (SELECT fold, count(*) AS n, sum(y) AS s FROM K GROUP BY fold),
TOT AS (SELECT sum(n) AS tn, sum(s) AS ts FROM SF),
M AS (SELECT K.fold, avg(abs(K.y - (TOT.ts - SF.s) / (TOT.tn - SF.n)) / greatest(abs(K.y), {_EPS})) AS mape
      FROM K JOIN SF USING (fold) CROSS JOIN TOT GROUP BY K.fold)
SELECT (SELECT count(*) FROM M) AS n_folds, (SELECT count(*) FROM K) AS n_rows, {_round_dec('avg(mape)', 8)} AS mean_mape,
       true AS forest_below_mean
FROM (SELECT mape, row_number() OVER (ORDER BY mape) AS rn, count(*) OVER () AS c FROM M) WHERE rn > 1 AND rn < c""")
def q_forest_check(spark, sf_dir):
    """M5 + A13 + A14 with all its settings, on orders' revenue by their lines: ten
    folds, forest against training mean, trimmed means; the forest's is the
    smaller. (Listings' areas are no function of their features, so there neither
    has to be.)"""
    orders = spark.sql(_ORDERS_SQL.format(lineitem="{lineitem}"), lineitem=read_table(spark, sf_dir, "lineitem"))
    out = I.forest_check(orders, target="revenue", features=["n_lines", "quantity", "discount", "tax"])
    return out.select("n_folds", "n_rows", F.round("mean_mape", 8).alias("mean_mape"), "forest_below_mean")


_SCALE_SQL = ", ".join(
    f"coalesce((D.{c} - B.mn_{c}) / NULLIF(B.mx_{c} - B.mn_{c}, 0), 0.0) AS {c}_s" for c in SIX)


@register("minmax_scale", O.with_tables(
    ", D AS (SELECT * FROM T WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in SIX) + "),\nB AS (SELECT "
    + ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in SIX) + " FROM D)\nSELECT D.row_id, "
    + _SCALE_SQL + " FROM D CROSS JOIN B"))
def q_minmax_scale(spark, sf_dir):
    """Min-max scaling of the six near-duplicate features (constant → 0)."""
    d = typed_stage(spark, sf_dir).dropna(subset=SIX).select("row_id", *SIX)
    return S.minmax_scale(d, SIX).select("row_id", *[f"{c}_s" for c in SIX])


@register("null_profile", O.with_tables(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM T" for c in T_COLS)))
def q_null_profile(spark, sf_dir):
    """A8 + Q8: nulls per column, one pass."""
    return S.null_counts(typed_stage(spark, sf_dir), T_COLS)


@register("sample_fixed", O.with_tables(", " + CANDIDATES_SQL + "\nSELECT row_id FROM SP"))
def q_sample_fixed(spark, sf_dir):
    """Exact-size deterministic check sample (hash order, no global window)."""
    return fill_candidates(typed_stage(spark, sf_dir)).where("sample").select("row_id")


@register("impute_area")
def q_impute_area(spark, sf_dir):
    """M5: forest imputation of the missing areas (not value-comparable: rows only)."""
    t = typed_stage(spark, sf_dir)
    return I.impute_with_forest(t).select("row_id", "area")


@register("price_m2_formula", O.with_tables(
    "SELECT row_id, precio / NULLIF(area, 0) AS precioxm2, "
    "CASE WHEN moneda IS NULL THEN NULL ELSE moneda END AS moneda FROM F JOIN T USING (row_id)"))
def q_price_m2_formula(spark, sf_dir):
    """F4 + F18: currency tag and price per m² side by side."""
    from .catalog import formatted
    f = formatted(spark, sf_dir).select("row_id", "moneda")
    t = typed(spark, sf_dir).select("row_id", N.price_per_m2(F.col("precio"), F.col("area")).alias("precioxm2"))
    return t.join(f, "row_id")


def _quality_sql() -> str:
    from . import queries_wrangle as QW
    from .pipeline import PARSED

    def row(check: str, value: str, threshold: str = "NULL", passed: str = "true") -> str:
        return f"SELECT '{check}' AS check, {value} AS value, {threshold}::DOUBLE AS threshold, {passed} AS passed"

    rows = [row(f"parse_nulls_{c}", f"(SELECT count(*) FROM F WHERE {c} IS NULL)::DOUBLE") for c in PARSED]
    sale = "(SELECT round(median_sale / NULLIF(median_rent, 0), 0) FROM SR)"
    rows.append(row("sale_rent_ratio", sale, "20", f"coalesce({sale} >= 20, false)"))
    for c in QW.W.FILL_TOLERANCES:
        rate = f"(SELECT match_rate FROM MR WHERE variable = '{c}')"
        rows.append(row(f"match_rate_{c}", _round_dec(rate, 8), "0.7", f"coalesce({rate} >= 0.7, false)"))
        rows.append(row(f"nulls_filled_{c}", f"((SELECT count(*) FROM T WHERE {c} IS NULL) - (SELECT count(*) FROM FT WHERE {c} IS NULL))::DOUBLE"))
    share = "(SELECT count(*) FILTER (WHERE " + " OR ".join(f"{c} IS NULL" for c in CRITICAL) + ")::DOUBLE / count(*) FROM T)"
    rows.append(row("critical_null_share", _round_dec(share, 8), "0.1", f"{share} <= 0.1"))
    ratio = "(SELECT (avg(ratio) + median(ratio)) / 2 FROM R)"
    rows.append(row("price_ratio", _round_dec(ratio, 8), "2", f"coalesce({ratio} >= 2, false)"))
    matches = " UNION ALL ".join(QW._tolerance_sql(c, t) for c, t in QW.W.FILL_TOLERANCES.items())
    return O.with_tables(f""", FL AS ({QW.FLAGS_SQL}), V AS ({QW.VERDICTS_SQL}),
PR AS (SELECT CASE WHEN coalesce(V.propuesta = 'alquiler', false) THEN 'rent' ELSE 'sale' END AS grp, T.precio
      FROM V JOIN T USING (row_id) WHERE V.propiedad = 'departamento'),
SR AS (SELECT median(precio) FILTER (WHERE grp = 'sale') AS median_sale,
             median(precio) FILTER (WHERE grp = 'rent') AS median_rent FROM PR),
{CANDIDATES_SQL}, {QW._FILLED_SQL}, MR AS ({matches}){_RATIO_SQL}
""" + " UNION ALL ".join(rows))


@register("quality_table", _quality_sql())
def q_quality_table(spark, sf_dir):
    """Q1–Q6, Q8: the checks of the job's stages, each on all typed listings. Null
    counts, dropped and filled rows are seen by the passes that make the data."""
    from . import format as fmt
    from . import pipeline as P
    from .catalog import raw
    report, cfg = Q.QualityReport(), P.Config()
    t = stage(fmt.normalise_prices(P.formatted_stage(raw(spark, sf_dir), report)))
    P.sale_rent_check(t, P.Config(), report)
    P.fill_attributes(t, cfg, report)
    P.drop_critical_nulls(t, report)
    P.price_ratio_check(t, report)
    return report.to_df(spark).withColumn("value", F.round("value", 8))


@register("clean_pipeline")
def q_clean_pipeline(spark, sf_dir):
    """The whole job (stage 1 → 2 → 3) on the raw listings: the cleaned table."""
    from .catalog import raw
    from .pipeline import run
    return run(raw(spark, sf_dir))["cleaned"]
