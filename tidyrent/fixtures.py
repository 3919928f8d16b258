"""Listing fixture derived from the provided TPC-H-style tables.

The test data has no rental listings, so ``listings_raw`` synthesises them from
``orders`` joined to ``customer`` (one listing per order, ``row_id`` =
``o_orderkey``). The same SQL text runs on Spark and on DuckDB and yields the
same rows, which is what lets every oracle query start from identical input.
Its size grows with the scale factor (1.5k / 15k / 150k rows at sf 0.001 /
0.01 / 0.1), so every query built on it scales with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .session import read_table

# ``{orders}`` / ``{customer}`` are table placeholders and ``{q}`` quotes the one
# identifier with a slash in it (backtick in Spark, double quote in DuckDB).
_LISTINGS_SQL = """
WITH k AS (
  SELECT o.o_orderkey AS id,
         CASE WHEN o.o_orderkey % 50 < 6 THEN o.o_orderkey - o.o_orderkey % 50
              WHEN o.o_orderkey % 50 BETWEEN 20 AND 23 THEN o.o_orderkey - o.o_orderkey % 50 + 20
              ELSE o.o_orderkey END AS b
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey),
g AS (
  SELECT id, b, (b * 7) % 25 AS d, (b * 31) % 997 AS u, (b * 57) % 991 AS v FROM k)
SELECT
  id AS row_id,
  concat('Departamento en ', CASE WHEN b % 45 = 0 THEN 'venta' WHEN b % 77 = 6 THEN 'alquiler y venta' ELSE 'alquiler' END,
         ' de ', CAST(20 + b % 130 AS STRING), ' m2, ', CAST(1 + u % 4 AS STRING), ' dormitorios, Av. Lima ',
         CAST(b % 900 AS STRING), ', ref ', CAST(b AS STRING)) AS descripcion,
  CASE id % 7 WHEN 0 THEN 'Publicado hoy' WHEN 1 THEN 'Publicado desde ayer'
       WHEN 2 THEN 'Publicado hace más de 1 año' WHEN 3 THEN 'Publicado hace 25 minutos'
       WHEN 4 THEN 'Publicado hace 3 horas' WHEN 5 THEN NULL
       ELSE concat('Publicado hace ', CAST(u % 60 AS STRING), ' días') END AS fecha_publicacion,
  CASE b % 6 WHEN 0 THEN 'A estrenar' WHEN 1 THEN NULL WHEN 2 THEN '1 año'
       WHEN 3 THEN concat('Año de construcción', chr(10), CAST(1960 + u % 60 AS STRING))
       ELSE concat(CAST(2 + u % 55 AS STRING), ' años') END AS antiguedad,
  CASE WHEN b % 45 = 0 THEN concat('S/ ', CAST(200 + u AS STRING), ',000')
       WHEN b % 101 = 9 THEN 'S/ 150' WHEN b % 103 = 9 THEN 'S/ 500'
       WHEN b % 11 = 0 THEN NULL
       WHEN b % 4 = 0 THEN concat('US$', CAST(300 + u % 900 AS STRING))
       ELSE concat('S/ ', CAST(1 + u % 9 AS STRING), ',', CAST(100 + b % 899 + id % 2 AS STRING)) END AS precio_soles,
  CASE WHEN b % 3 = 0 THEN concat('USD ', CAST(400 + b % 500 AS STRING))
       WHEN b % 3 = 1 THEN '' ELSE NULL END AS precio_dolares,
  CASE WHEN b % 53 = 8 THEN NULL
       WHEN id % 1501 = 17 THEN '-35,5'
       ELSE concat('-12,', CAST(100000 + d * 4000 + u AS STRING)) END AS latitud,
  CASE WHEN b % 53 = 8 OR b % 59 = 8 THEN NULL
       WHEN id % 1501 = 17 THEN concat('-', CAST(10 + CAST(floor((id % 75050 - 17) / 1501) AS BIGINT) * 3 AS STRING))
       ELSE concat('-77,', CAST(100000 + d * 3000 + v AS STRING)) END AS longitud,
  CASE WHEN b % 19 = 7 THEN '2 baños' WHEN b % 4999 = 11 THEN '6 dorm. ' WHEN b % 61 = 9 THEN '8 dorm. '
       ELSE concat(CAST(1 + u % 4 AS STRING), ' dorm. ') END AS dormitorios,
  CASE WHEN b % 23 = 7 THEN NULL WHEN b % 211 = 9 THEN '9 baños' WHEN b % 4999 = 11 THEN '7 baños'
       ELSE concat(CAST(1 + v % 3 AS STRING), ' baños') END AS banos,
  CASE WHEN b % 5 = 1 THEN '1 medio baño' WHEN b % 5 = 2 THEN '2 medios baños' ELSE NULL END AS {q}banios/2{q},
  CASE WHEN b % 31 = 7 THEN '85 tot.' WHEN b % 97 = 9 THEN '720 m² tot.' WHEN b % 37 = 9 THEN '300 m² tot.'
       WHEN b % 41 = 9 THEN '180 m² tot.'
       ELSE concat(CAST(20 + b % 130 AS STRING), ' m² tot.') END AS area_total,
  CASE WHEN b % 3 = 0 THEN concat(CAST(15 + b % 120 AS STRING), ' m² cub.') ELSE NULL END AS area_cubierta,
  CASE WHEN b % 2 = 0 THEN '1 estac.' ELSE NULL END AS estacionamiento,
  CASE WHEN d = 7 THEN 'Chorillos'
       ELSE concat('distrito_', CAST(CASE WHEN id % 29 = 13 THEN (d + 1) % 25 ELSE d END AS STRING)) END AS distrito
FROM g
"""


def listings_raw_sql(dialect: str = "duckdb") -> str:
    if dialect == "duckdb":
        return _LISTINGS_SQL.format(orders="orders", customer="customer", q='"')
    return _LISTINGS_SQL.format(orders="{orders}", customer="{customer}", q="`")


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings (all string columns + ``row_id``) for one scale factor."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey")
    return spark.sql(listings_raw_sql("spark"), orders=orders, customer=customer)
