"""Queries for stage 1 (formatting) and the normalisation that opens stage 2."""

from __future__ import annotations

from . import oracle as O
from .catalog import formatted, register, typed, typed_stage


@register("format_listings", O.with_tables("SELECT * FROM F", upto="F"))
def q_format_listings(spark, sf_dir):
    """F1–F11 on every raw listing."""
    return formatted(spark, sf_dir)


@register("normalise_prices", O.with_tables("SELECT * FROM T"))
def q_normalise_prices(spark, sf_dir):
    """F12–F14, P2, P3."""
    return typed(spark, sf_dir)


@register("district_median_price_m2", O.with_tables("""
SELECT distrito, count(*) AS n_listings, median(precio / area) AS median_precioxm2
FROM T GROUP BY distrito"""))
def q_district_median_price_m2(spark, sf_dir):
    """Minimum slice: F4–F6, F8, F10, F12 → F18 → A1 (exact median per district)."""
    from ..operators.stats import district_median_price_m2
    return district_median_price_m2(typed_stage(spark, sf_dir))
