"""Numeric column expressions (prices, ages, distances, bins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: defaults that must equal the listing source's constants ---
USD_RATE = 3.7           # soles per dollar
REFERENCE_YEAR = 2025    # "year of construction" → age
YEAR_THRESHOLD = 1000    # an age above this is a year
EARTH_RADIUS_KM = 6371.0
DISTRICT_FIXES = {"chorillos": "chorrillos"}   # lower-cased misspelling → fix
CITY_SUFFIX = ", Lima, Perú."
UNKNOWN_BIN = "desconocido"
BIN_LABEL = "Grupo {}"
# --- end of fixed values ---


def normalise_price(amount: Column, currency: Column, dollars: Column, rate: float = USD_RATE) -> Column:
    """amounts tagged ``US$`` are converted; a missing amount falls back to
    the dollar column, converted."""
    r = F.lit(float(rate))
    amount = amount.cast("double")
    converted = F.when(currency == F.lit("US$"), r * amount).otherwise(amount)
    return F.coalesce(converted, r * dollars.cast("double"))


def fix_spelling(c: Column, fixes: dict[str, str] | None = None) -> Column:
    """case-insensitive exact-value corrections."""
    fixes = DISTRICT_FIXES if fixes is None else fixes
    expr = None
    for bad, good in fixes.items():
        cond = F.lower(c) == F.lit(bad)
        expr = F.when(cond, F.lit(good)) if expr is None else expr.when(cond, F.lit(good))
    return c if expr is None else expr.otherwise(c)


def year_to_age(c: Column, reference_year: int = REFERENCE_YEAR) -> Column:
    """a value above 1000 is a year of construction → age."""
    return F.when(c > F.lit(YEAR_THRESHOLD), F.lit(reference_year) - c).otherwise(c)


def to_number(c: Column) -> Column:
    """coercing numeric parse (bad text → null, NaN → null)."""
    d = c.cast("string").try_cast("double")
    return F.when(~F.isnan(d), d)


def price_per_m2(price: Column, area: Column) -> Column:
    """price / area; a zero or null area gives null (never ±inf)."""
    return F.try_divide(price.cast("double"), area.cast("double"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_RADIUS_KM) -> Column:
    """great-circle distance in km from degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat = p2 - p1
    dlon = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(radius) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def right_closed_bins(c: Column, edges: Sequence[float], label: str = BIN_LABEL,
                      unknown: str = UNKNOWN_BIN) -> Column:
    """label ``Grupo i`` for ``edges[i-1] < x <= edges[i]``; outside or
    null → ``desconocido``. (Not Bucketizer: that one is left-closed.)"""
    expr = None
    for i in range(len(edges) - 1):
        cond = (c > F.lit(float(edges[i]))) & (c <= F.lit(float(edges[i + 1])))
        lab = F.lit(label.format(i + 1))
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return F.lit(unknown) if expr is None else expr.otherwise(F.lit(unknown))


def noise_flag(cluster: Column) -> Column:
    """1 where a row's cluster label is noise (-1), else 0; no label is no noise."""
    return F.when(cluster == -1, 1).otherwise(0)


def city_address(address: Column, district: Column, suffix: str = CITY_SUFFIX) -> Column:
    """fallback address text when the extracted one is null, 'null' or ''."""
    clean = F.nullif(F.nullif(address, F.lit("")), F.lit("null"))
    return F.coalesce(clean, F.concat(district, F.lit(suffix)))
