"""Queries for sources/sinks (S1–S12), key intersection (P1), reply repair
(F23/F24), decimal repair (F22) and batched providers (E6–E8)."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F

from ..fixtures import listings_raw
from ..functions import text as T
from ..operators import enrich as E
from ..operators.sampling import batch_numbers
from ..session import read_table, stage_partitions
from ..sources import files as S
from . import format as fmt
from . import oracle as O
from .catalog import raw, register, typed
from .queries_wrangle import _lit

# JSON records built from ``events``: ``k`` from props, ``event_type`` and
# ``user`` always present (``user`` null for some), ``value`` absent for some.
_EVENT_RECORDS = """
SELECT event_id,
  concat('{{', substr(props, 2, length(props) - 2),
         ', "event_type": ', CASE WHEN event_type IS NULL THEN 'null' ELSE concat('"', event_type, '"') END,
         CASE WHEN event_id % 7 <> 0 THEN concat(', "value": ', coalesce(CAST(value AS STRING), 'null')) ELSE '' END,
         ', "user": ', CASE WHEN user_id % 5 = 0 OR user_id IS NULL THEN 'null' ELSE CAST(user_id AS STRING) END,
         '}}') AS rec
FROM {events}"""


@register("key_intersection", "WITH R AS (" + _EVENT_RECORDS.format(events="events") + """)
SELECT event_id, json_extract_string(rec, '$.event_type') AS event_type, json_extract_string(rec, '$.k') AS k,
       json_extract_string(rec, '$.user') AS "user" FROM R""")
def q_key_intersection(spark, sf_dir):
    """Keep the keys present in every record (null-valued keys count)."""
    ev = read_table(spark, sf_dir, "events")
    recs = spark.sql(_EVENT_RECORDS, events=ev)
    return S.records_to_columns(recs, keep=("event_id",))


_DOTTED = """
SELECT c_custkey,
  concat(CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END, CAST(c_custkey AS STRING), '.',
         lpad(CAST(c_nationkey AS STRING), 3, '0'), '.',
         lpad(CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 1000 AS STRING), 3, '0')) AS raw_amount
FROM {customer}"""
REPAIR_POSITION = 3


@register("decimal_repair", "WITH D AS (" + _DOTTED.format(customer="customer") + f""")
SELECT c_custkey, raw_amount,
  TRY_CAST(concat(substr(replace(raw_amount, '.', ''), 1, {REPAIR_POSITION}), '.',
                  substr(replace(raw_amount, '.', ''), {REPAIR_POSITION + 1})) AS DOUBLE) AS amount FROM D""")
def q_decimal_repair(spark, sf_dir):
    """Drop the dots of a mangled number and re-insert the decimal
    point after a fixed number of characters."""
    d = spark.sql(_DOTTED, customer=read_table(spark, sf_dir, "customer"))
    return d.select("c_custkey", "raw_amount",
                    T.decimal_point_repair(F.col("raw_amount"), REPAIR_POSITION).alias("amount"))


_REPLY_BATCH = 20
_RECORD_SCHEMA = "struct<id:bigint,talla:int,marca:string,nota:string>"


@register("reply_repair", f"""
WITH P AS (SELECT p_partkey, p_size, p_brand, CAST(floor(p_partkey / {_REPLY_BATCH}) AS BIGINT) AS batch FROM part)
SELECT batch, p_partkey AS id, p_size AS talla, p_brand AS marca, CAST(NULL AS VARCHAR) AS nota FROM P
WHERE batch % 13 <> 5 AND (batch % 11 <> 3 OR p_partkey = (SELECT min(p_partkey) FROM P p2 WHERE p2.batch = P.batch))""")
def q_reply_repair(spark, sf_dir):
    """F24 + F23: records → reply text (fenced JSON with single quotes and
    ``None``, a bare object, or junk) → repaired, parsed, exploded."""
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", "p_brand", F.floor(F.col("p_partkey") / _REPLY_BATCH).cast("bigint").alias("batch"))
    rec = F.concat(F.lit("{'id': "), F.col("p_partkey").cast("string"), F.lit(", 'talla': "),
                   F.col("p_size").cast("string"), F.lit(", 'marca': '"), F.col("p_brand"),
                   F.lit("', 'nota': None}"))
    grouped = part.groupBy("batch").agg(
        F.concat_ws(", ", F.collect_list(rec)).alias("body"),
        F.min_by(rec, F.col("p_partkey")).alias("first"))
    reply = (F.when(F.col("batch") % 13 == 5, F.lit("Lo siento, no puedo procesar esta solicitud."))
             .when(F.col("batch") % 11 == 3, F.concat(F.lit("Resultado: "), F.col("first"), F.lit(" fin.")))
             .otherwise(F.concat(F.lit("Claro, aquí tienes:\n```json\n["), F.col("body"), F.lit("]\n```"))))
    parsed = grouped.select("batch", T.repair_reply(reply, _RECORD_SCHEMA).alias("recs"))
    return parsed.select("batch", F.explode("recs").alias("r")).select(
        "batch", "r.id", "r.talla", "r.marca", "r.nota")


def _classify_batch(pdf: pd.DataFrame) -> pd.DataFrame:
    """A pandas provider for E7 (what a remote classifier would return):
    keyword rules on one chunk of records."""
    low = pdf["descripcion"].fillna("").str.lower()
    apt = low.str.contains(E.whole_words(E.APARTMENT_WORDS), regex=True)
    other = low.str.contains(E.whole_words(E.OTHER_PROPERTY_WORDS), regex=True)
    sale = low.str.contains(E.whole_words(E.SALE_WORD), regex=True)
    rent = low.str.contains(E.whole_words(E.RENT_WORD), regex=True)
    prop = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
    prop[other] = E.NOT_APARTMENT
    prop[apt] = E.APARTMENT
    offer = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
    offer[rent] = E.RENT
    offer[sale] = E.SALE
    offer[sale & rent] = E.RENT_AND_SALE
    prop[pdf["descripcion"].isna()] = None
    offer[pdf["descripcion"].isna()] = None
    return pd.DataFrame({"row_id": pdf["row_id"], "propiedad": prop, "propuesta": offer})


_BATCHED = O.with_tables(f"""
SELECT row_id,
  CASE WHEN regexp_matches(lower(descripcion), {_lit(E.whole_words(E.APARTMENT_WORDS))}) THEN {_lit(E.APARTMENT)}
       WHEN regexp_matches(lower(descripcion), {_lit(E.whole_words(E.OTHER_PROPERTY_WORDS))}) THEN {_lit(E.NOT_APARTMENT)} END
    AS propiedad,
  CASE WHEN regexp_matches(lower(descripcion), {_lit(E.whole_words(E.SALE_WORD))})
        AND regexp_matches(lower(descripcion), {_lit(E.whole_words(E.RENT_WORD))}) THEN {_lit(E.RENT_AND_SALE)}
       WHEN regexp_matches(lower(descripcion), {_lit(E.whole_words(E.SALE_WORD))}) THEN {_lit(E.SALE)}
       WHEN regexp_matches(lower(descripcion), {_lit(E.whole_words(E.RENT_WORD))}) THEN {_lit(E.RENT)} END AS propuesta
FROM L""", upto="L")


def _requests(spark, sf_dir):
    """Listings' texts dealt evenly to all tasks: a provider's time goes by the number
    of records, while adaptive shuffles go by their bytes, which are few."""
    return listings_raw(spark, sf_dir).select("row_id", "descripcion").repartition(stage_partitions(spark))


@register("map_batches", _BATCHED)
def q_map_batches(spark, sf_dir):
    """A pandas provider applied to chunks of 20 records per
    partition (Arrow batches), with retries; failed chunks give no rows."""
    src = _requests(spark, sf_dir)
    return E.map_batches(src, _classify_batch, "row_id bigint, propiedad string, propuesta string", batch_size=20)


def _refuses_odd_chunks(pdf: pd.DataFrame) -> pd.DataFrame:
    """Stands for a service that is down for some chunks."""
    if int(pdf["row_id"].sum()) % 2:
        raise RuntimeError("service is down")
    return _classify_batch(pdf)


@register("resumed_batches", _BATCHED)
def q_resumed_batches(spark, sf_dir):
    """A provider that fails for some chunks leaves their requests in the
    dead-letter table; a second attempt asks for those only, and both give all."""
    src = _requests(spark, sf_dir)
    letters, schema = S.scratch_dir(spark, "letters"), "row_id bigint, propiedad string, propuesta string"
    first = E.ask(src, _refuses_odd_chunks, schema, retries=0, dead_letters=letters)
    second = E.resume(spark, letters, _classify_batch, schema)
    return first.answers.unionByName(second.answers)


@register("batch_requests", f"""
WITH N AS (SELECT p_partkey, p_brand, CAST((row_number() OVER (ORDER BY p_partkey) - 1) // {_REPLY_BATCH} AS BIGINT) AS batch_id
           FROM part)
SELECT batch_id, '[' || string_agg('{{"id":' || p_partkey || ',"marca":"' || p_brand || '"}}', ',' ORDER BY p_partkey) || ']' AS body
FROM N GROUP BY batch_id""")
def q_batch_requests(spark, sf_dir):
    """W10 + F24: consecutive records in batches of 20, each batch as one JSON text."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    numbered = batch_numbers(part, _REPLY_BATCH, order="p_partkey")
    return numbered.groupBy("batch_id").agg(
        T.records_to_json(F.col("p_partkey").alias("id"), F.col("p_brand").alias("marca")).alias("body"))


@register("json_roundtrip", O.with_tables("SELECT * FROM F", upto="F"))
def q_json_roundtrip(spark, sf_dir):
    """S9 write (JSON lines, null keys kept) → S1/S3 read → P1 → stage 1."""
    out = S.scratch_dir(spark, "json")
    S.write_json(raw(spark, sf_dir), out)
    return fmt.format_listings(S.read_listing_folder(spark, out, shape="lines"))


@register("csv_roundtrip", O.with_tables("SELECT * FROM T"))
def q_csv_roundtrip(spark, sf_dir):
    """S7 write (header, quoted text with newlines) → S6 read with the schema."""
    t = typed(spark, sf_dir)
    out = S.write_csv(t, S.scratch_dir(spark, "csv"))
    return S.read_csv(spark, out, schema=t.schema.simpleString()[len("struct<"):-1].replace(":", " "))


@register("table_overwrite", O.with_tables("SELECT * FROM T"))
def q_table_overwrite(spark, sf_dir):
    """S8 + S10: CSV to the target path, then load it into a table that is
    replaced on every run."""
    t = typed(spark, sf_dir)
    csv_dir = S.write_csv(t, S.scratch_dir(spark, "csv"))
    schema = t.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    return S.load_table(spark, csv_dir, "listings_clean", S.scratch_dir(spark, "table"), schema)


@register("table_rewrite", "WITH D AS (" + _DOTTED.format(customer="customer") + f""")
SELECT TRY_CAST(concat(substr(replace(raw_amount, '.', ''), 1, {REPAIR_POSITION}), '.',
                       substr(replace(raw_amount, '.', ''), {REPAIR_POSITION + 1})) AS DOUBLE) AS raw_amount FROM D""")
def q_table_rewrite(spark, sf_dir):
    """A table of mangled numbers is rewritten as a table of its repaired
    columns only; each is written beside, audited and swapped in."""
    mangled = spark.sql(_DOTTED, customer=read_table(spark, sf_dir, "customer"))
    S.replace_table(mangled, "amounts_raw", S.scratch_dir(spark, "table"))
    return S.rewrite_decimals(spark, "amounts_raw", "amounts_repaired", S.scratch_dir(spark, "table"),
                              {"raw_amount": REPAIR_POSITION})


_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
           "conversations").split()


@register("file_listing", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES))
def q_file_listing(spark, sf_dir):
    """The data files of the folder and the rows they hold, by table."""
    return S.table_rows(spark, sf_dir)
