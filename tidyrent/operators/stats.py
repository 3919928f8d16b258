"""Aggregates and per-group statistics (A1–A17) and the price operators built on
them (M4, M7, M8). Group-level results (one row per district) are joined back on
the group key; they are materialised and broadcast only after a row-count check
(``broadcast_if_small``), else the join stays a shuffle join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..session import broadcast_if_small
from .quantiles import exact_quantiles, grouped_median


def with_price_m2(df: DataFrame, name: str = "precioxm2") -> DataFrame:
    return df.withColumn(name, N.price_per_m2(F.col("precio"), F.col("area")))


def district_median_price_m2(df: DataFrame, key: str = "distrito") -> DataFrame:
    """A1: rows and exact median price per m² per district (every district kept,
    median null when no row has a ratio)."""
    d = with_price_m2(df)
    counts = d.groupBy(key).agg(F.count(F.lit(1)).alias("n_listings"))
    med = grouped_median(d, [key], "precioxm2", "median_precioxm2")
    med = broadcast_if_small(med.withColumnRenamed(key, "_key"))
    return counts.join(med, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column in one pass, long format ``(column, n_null)``."""
    cols = list(cols) if cols is not None else df.columns
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column, n_null)")


def tolerance_rule(real: Column, guess: Column, tol: float) -> Column:
    """A15 rule: proportional for 0<t<1, absolute for t>=1 or t==0."""
    diff = F.abs(real - guess)
    if 0 < tol < 1:
        return F.try_divide(diff, real) <= F.lit(tol)
    if tol >= 1 or tol == 0:
        return diff <= F.lit(float(tol))
    raise ValueError("tolerance must be >= 0")


def match_rate(real: Column, guess: Column, tol: float) -> tuple[Column, Column]:
    """A15 aggregate: (pairs compared, share within tolerance) — null share when
    no pair has both sides."""
    both = real.isNotNull() & guess.isNotNull()
    n = F.count_if(both)
    ok = F.count_if(both & F.coalesce(tolerance_rule(real, guess, tol), F.lit(False)))
    return n, F.try_divide(ok.cast("double"), n.cast("double"))


def minmax_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_s") -> DataFrame:
    """Min-max scaling; a constant column scales to 0. The bounds are one
    global aggregate (2 numbers per column) brought to the driver and applied
    as literals."""
    b = df.agg(*[F.min(c).alias(f"mn_{c}") for c in cols], *[F.max(c).alias(f"mx_{c}") for c in cols]).first()

    def scaled(c: str) -> Column:
        mn, mx = b[f"mn_{c}"], b[f"mx_{c}"]
        if mn is None or mx is None or mx == mn:
            return F.when(F.col(c).isNotNull(), F.lit(0.0))
        return (F.col(c) - F.lit(float(mn))) / F.lit(float(mx) - float(mn))

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in cols})


def district_medians(df: DataFrame, key: str = "distrito", name: str = "median_precioxm2") -> DataFrame:
    """Exact median price per m² per district (districts with at least one ratio)."""
    return grouped_median(with_price_m2(df, "_pm2"), [key], "_pm2", name)


def low_price_fix(df: DataFrame, key: str = "distrito", factor: float = 2.1, rate: float = N.USD_RATE,
                  floor_m2: float = 10.0, medians: DataFrame | None = None) -> DataFrame:
    """M4 + P7: per district, rows with ``factor * price/m² < median`` are taken as
    quoted in dollars and converted; then rows under ``floor_m2`` per m² go.
    ``medians`` (key, median_precioxm2) may be passed when already computed."""
    d = with_price_m2(df, "_pm2")
    med = (medians if medians is not None else district_medians(df, key)).select(
        key, F.col("median_precioxm2").alias("_med"))
    j = d.join(broadcast_if_small(med), on=key, how="left")
    low = F.coalesce(F.lit(factor) * F.col("_pm2") < F.col("_med"), F.lit(False))
    fixed = j.withColumn("precio", F.when(low, F.col("precio") * F.lit(float(rate))).otherwise(F.col("precio")))
    keep = ~F.coalesce(N.price_per_m2(F.col("precio"), F.col("area")) < F.lit(floor_m2), F.lit(False))
    return fixed.where(keep).drop("_pm2", "_med")


def price_ratios(df: DataFrame, key: str = "distrito", factor: float = 2.1,
                 medians: DataFrame | None = None) -> DataFrame:
    """A2: per district, median price/m², median of the low rows, and their ratio
    rounded to 2 (0 when the district has no low row)."""
    d = with_price_m2(df, "_pm2")
    med = medians if medians is not None else district_medians(df, key)
    j = d.join(broadcast_if_small(med), on=key, how="inner")
    low = j.where(F.lit(factor) * F.col("_pm2") < F.col("median_precioxm2"))
    med_low = grouped_median(low, [key], "_pm2", "median_low")
    out = med.join(med_low, on=key, how="left")
    ratio = F.when(F.col("median_low").isNull() | (F.col("median_low") == 0), F.lit(0.0)).otherwise(
        F.round(F.col("median_precioxm2") / F.col("median_low"), 2))
    return out.withColumn("ratio", ratio)


def global_ratio(ratios: DataFrame, col: str = "ratio") -> DataFrame:
    """A3 + Q5: (mean + median) / 2 of the per-district ratios (one row)."""
    mean = ratios.agg(F.avg(col).alias("mean_ratio"), F.count(col).alias("n_districts")).first()
    med = exact_quantiles(ratios, [], col, [0.5], ["median_ratio"]).first()
    median = med["median_ratio"] if med is not None else None
    spark = ratios.sparkSession
    g = None if mean["mean_ratio"] is None or median is None else (mean["mean_ratio"] + median) / 2
    return spark.createDataFrame([(mean["mean_ratio"], median, int(mean["n_districts"]), g)],
                                 "mean_ratio double, median_ratio double, n_districts bigint, global_ratio double")


def iqr_fence(df: DataFrame, key: str = "distrito", value: str = "precioxm2", k: float = 2.5) -> DataFrame:
    """A7 + M8: drop rows above ``Q3 + k·(Q3-Q1)`` of their district."""
    q = exact_quantiles(df, [key], value, [0.25, 0.75], ["_q1", "_q3"])
    j = df.join(broadcast_if_small(q), on=key, how="left")
    fence = F.col("_q3") + F.lit(k) * (F.col("_q3") - F.col("_q1"))
    return j.where(~F.coalesce(F.col(value) > fence, F.lit(False))).drop("_q1", "_q3")


def rare_combinations(df: DataFrame, cols: Sequence[str] = ("dormitorios", "banos"), max_count: int = 3) -> DataFrame:
    """Combinations seen at most ``max_count`` times (a grouped count,
    partial-aggregated map-side)."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") <= max_count))


def drop_rare_combinations(df: DataFrame, cols: Sequence[str] = ("dormitorios", "banos"),
                           max_count: int = 3, enabled: bool = True) -> DataFrame:
    """M7: drop rows of rare combinations (anti-join; null-safe on the keys)."""
    if not enabled:
        return df
    rare = rare_combinations(df, cols, max_count).select(*[F.col(c).alias(f"_r_{c}") for c in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = e if cond is None else cond & e
    return df.join(rare, on=cond, how="left_anti")
