"""DuckDB SQL equivalents of the stage plans, for the oracle check.

Built from the same fixed values (patterns, phrases, constants) as the Spark
code so both sides read one definition. Each builder returns a SQL fragment that
can sit in a ``WITH`` list.
"""

from __future__ import annotations

from ..fixtures import listings_raw_sql
from ..functions import numeric as N
from ..functions import text as T


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _parse_int(col: str, pattern: str) -> str:
    n = max(1, pattern.count("(") - pattern.count(r"\("))
    parts = [f"regexp_extract(lower({col}), {_lit(pattern)}, {i})" for i in range(1, n + 1)]
    text = parts[0] if n == 1 else "concat(" + ", ".join(parts) + ")"
    return f"TRY_CAST(NULLIF({text}, '') AS BIGINT)"


def listings_sql() -> str:
    return listings_raw_sql("duckdb")


def formatted_sql(src: str = "L") -> str:
    """Stage 1 over raw listings ``src`` (DuckDB)."""
    date_case = "CASE " + " ".join(
        f"WHEN fecha_publicacion = {_lit(a)} THEN {_lit(b)}" for a, b in T.DATE_PHRASES.items()
    ) + " ELSE fecha_publicacion END"
    pre = f"""
    SELECT row_id, descripcion,
      CASE WHEN contains(f1, {_lit(T.MINUTES_WORD)}) THEN {_lit(T.MINUTES_VALUE)} ELSE f1 END AS fecha_publicacion,
      CASE WHEN regexp_matches(lower(a1), {_lit(T.KEEP_IF['antiguedad'])}) THEN a1 END AS antiguedad,
      substr(NULLIF(precio_soles, ''), 1, 3) AS moneda,
      replace(replace(precio_soles, ',', ''), '.', '') AS precio_soles,
      NULLIF(replace(replace(precio_dolares, ',', ''), '.', ''), '') AS precio_dolares,
      replace(latitud, ',', '.') AS latitud,
      replace(longitud, ',', '.') AS longitud,
      CASE WHEN regexp_matches(lower(dormitorios), {_lit(T.KEEP_IF['dormitorios'])}) THEN dormitorios END AS dormitorios,
      CASE WHEN regexp_matches(lower(banos), {_lit(T.KEEP_IF['banos'])}) THEN banos END AS banos,
      "banios/2",
      CASE WHEN regexp_matches(lower(area_total), {_lit(T.KEEP_IF['area_total'])}) THEN area_total END AS area_total,
      area_cubierta, estacionamiento, distrito
    FROM (SELECT *, {date_case} AS f1,
                 CASE WHEN antiguedad = {_lit(T.NEW_BUILD_TEXT)} THEN {_lit(T.NEW_BUILD_VALUE)} ELSE antiguedad END AS a1
          FROM {src})"""
    ints = {c: _parse_int(f'"{c}"', T.INT_PATTERNS[c]) for c in T.INT_PATTERNS}

    def coord(c: str) -> str:
        both = " AND ".join(f"NOT isnan(TRY_CAST({x} AS DOUBLE))" for x in ("latitud", "longitud"))
        return f"CASE WHEN {both} THEN TRY_CAST({c} AS DOUBLE) END"

    return f"""
    SELECT row_id, descripcion, {ints['fecha_publicacion']} AS fecha_publicacion,
      {ints['antiguedad']} AS antiguedad, {ints['precio_soles']} AS precio_soles,
      {ints['precio_dolares']} AS precio_dolares, {coord('latitud')} AS latitud, {coord('longitud')} AS longitud,
      {ints['dormitorios']} AS dormitorios, {ints['banos']} AS banos, {ints['banios/2']} AS "banios/2",
      {ints['area_total']} AS area_total, {ints['area_cubierta']} AS area_cubierta,
      {ints['estacionamiento']} AS estacionamiento, distrito, moneda
    FROM ({pre})"""


def normalised_sql(src: str = "F") -> str:
    r = f"{N.USD_RATE}::DOUBLE"
    fixes = " ".join(f"WHEN lower(distrito) = {_lit(a)} THEN {_lit(b)}" for a, b in N.DISTRICT_FIXES.items())
    return f"""
    SELECT row_id, descripcion, fecha_publicacion,
      CAST(CASE WHEN antiguedad > {N.YEAR_THRESHOLD} THEN {N.REFERENCE_YEAR} - antiguedad ELSE antiguedad END AS DOUBLE)
        AS antiguedad,
      COALESCE(CASE WHEN moneda = 'US$' THEN {r} * precio_soles ELSE CAST(precio_soles AS DOUBLE) END,
               {r} * precio_dolares) AS precio,
      latitud, longitud, CAST(dormitorios AS DOUBLE) AS dormitorios, CAST(banos AS DOUBLE) AS banos,
      CAST(area_total AS DOUBLE) AS area,
      CASE {fixes} ELSE distrito END AS distrito
    FROM {src}"""


def with_tables(body: str, upto: str = "T") -> str:
    """``WITH L, F, T`` prefix + body."""
    parts = [f"L AS ({listings_sql()})"]
    if upto in ("F", "T"):
        parts.append(f"F AS ({formatted_sql('L')})")
    if upto == "T":
        parts.append(f"T AS ({normalised_sql('F')})")
    return "WITH " + ",\n".join(parts) + "\n" + body


def noise_sql(chord: float, legacy: bool, min_samples: int = 5, name: str = "X") -> str:
    """CTEs ``X_p`` (distinct coordinates of ``T`` on the unit sphere) to ``X``
    (noise coordinates): pairs by brute force; points farther apart in z than the
    chord are farther apart at all."""
    la, lo = ("latitud", "longitud") if legacy else ("radians(latitud)", "radians(longitud)")
    near = f"""q.z BETWEEN p.z - {chord!r} AND p.z + {chord!r}
        AND pow(p.x - q.x, 2) + pow(p.y - q.y, 2) + pow(p.z - q.z, 2) <= {chord * chord!r}"""
    return f"""{name}_p AS (SELECT latitud, longitud, count(*) AS w, cos({la}) * cos({lo}) AS x, cos({la}) * sin({lo}) AS y, sin({la}) AS z
       FROM T WHERE latitud IS NOT NULL AND longitud IS NOT NULL GROUP BY latitud, longitud),
{name}_c AS (SELECT p.latitud, p.longitud, any_value(p.x) AS x, any_value(p.y) AS y, any_value(p.z) AS z, sum(q.w) >= {min_samples} AS core
       FROM {name}_p p JOIN {name}_p q ON {near} GROUP BY p.latitud, p.longitud),
{name} AS (SELECT latitud, longitud FROM {name}_c p WHERE NOT core
       AND NOT EXISTS (SELECT 1 FROM (SELECT * FROM {name}_c WHERE core) q WHERE {near}))"""
