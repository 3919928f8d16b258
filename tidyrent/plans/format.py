"""Stage 1 (raw text → typed listing) and the price/district normalisation that
opens stage 2. Pure projections: one narrow stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T
from ..functions.text import col_

RAW_TEXT_COLUMNS = [
    "descripcion", "fecha_publicacion", "antiguedad", "precio_soles", "precio_dolares", "latitud",
    "longitud", "dormitorios", "banos", "banios/2", "area_total", "area_cubierta", "estacionamiento",
    "distrito",
]
INT_COLUMNS = [
    "dormitorios", "banos", "banios/2", "antiguedad", "area_total", "area_cubierta", "estacionamiento",
    "precio_soles", "precio_dolares", "fecha_publicacion",
]
FORMATTED_ORDER = [
    "row_id", "descripcion", "fecha_publicacion", "antiguedad", "precio_soles", "precio_dolares", "latitud",
    "longitud", "dormitorios", "banos", "banios/2", "area_total", "area_cubierta", "estacionamiento",
    "distrito", "moneda",
]
NORMALISED_ORDER = [
    "row_id", "descripcion", "fecha_publicacion", "antiguedad", "precio", "latitud", "longitud",
    "dormitorios", "banos", "area", "distrito",
]
DOUBLE_AFTER_NORMALISE = ["antiguedad", "precio", "latitud", "longitud", "dormitorios", "banos", "area"]


def _present(df: DataFrame, names: list[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def pre_format(raw: DataFrame) -> DataFrame:
    """F1–F8: text normalisation, still all strings plus ``moneda``."""
    cols = {}
    if "fecha_publicacion" in raw.columns:
        c = T.map_phrases(F.col("fecha_publicacion"), T.DATE_PHRASES)
        cols["fecha_publicacion"] = T.replace_if_contains(c, T.MINUTES_WORD, T.MINUTES_VALUE)
    antig = T.replace_exact(F.col("antiguedad"), T.NEW_BUILD_TEXT, T.NEW_BUILD_VALUE)
    cols["moneda"] = T.currency_tag(F.col("precio_soles"))
    cols["precio_soles"] = T.strip_separators(F.col("precio_soles"))
    cols["precio_dolares"] = T.empty_to_null(T.strip_separators(F.col("precio_dolares")))
    cols["latitud"] = T.decimal_comma(F.col("latitud"))
    cols["longitud"] = T.decimal_comma(F.col("longitud"))
    cols["antiguedad"] = T.keep_if_matches(antig, T.KEEP_IF["antiguedad"])
    for name in ("dormitorios", "banos", "area_total"):
        cols[name] = T.keep_if_matches(F.col(name), T.KEEP_IF[name])
    return raw.withColumns(cols)


def format_typed(pre: DataFrame) -> DataFrame:
    """Typed columns. Regex misses become null."""
    lat, lon = T.parse_coordinate_pair(F.col("latitud"), F.col("longitud"))
    cols = {"latitud": lat, "longitud": lon}
    for name in _present(pre, INT_COLUMNS):
        cols[name] = T.parse_int(col_(name), T.INT_PATTERNS[name])
    return pre.withColumns(cols)


def format_listings(raw: DataFrame) -> DataFrame:
    """Stage 1 in one lazy projection."""
    out = format_typed(pre_format(raw))
    ordered = _present(out, FORMATTED_ORDER)
    extra = [c for c in out.columns if c not in set(ordered)]
    return out.select(*[col_(c) for c in ordered + extra])


def normalise_prices(formatted: DataFrame, rate: float = N.USD_RATE,
                     reference_year: int = N.REFERENCE_YEAR) -> DataFrame:
    """Price in soles, district spelling, age; drop helper
    columns, rename, and take the CSV-hop types (nullable numbers are DOUBLE)."""
    df = formatted.withColumns({
        "precio_soles": N.normalise_price(F.col("precio_soles"), F.col("moneda"), F.col("precio_dolares"), rate),
        "distrito": N.fix_spelling(F.col("distrito")),
        "antiguedad": N.year_to_age(F.col("antiguedad"), reference_year),
    })
    df = df.drop("precio_dolares", "banios/2", "estacionamiento", "area_cubierta", "moneda")
    df = df.withColumnsRenamed({"precio_soles": "precio", "area_total": "area"})
    df = df.withColumns({c: F.col(c).cast("double") for c in DOUBLE_AFTER_NORMALISE})
    ordered = _present(df, NORMALISED_ORDER)
    extra = [c for c in df.columns if c not in set(ordered)]
    return df.select(*[col_(c) for c in ordered + extra])
