"""Corpus pipeline: documents to packed training sequences.

language ID (rejected documents go) -> SimHash near-dedup (one document of each
group stays) -> suffix-array dedup (repeated passages go from later documents)
-> mixing sources to target weights (documents in mixed order) -> best-fit
packing (one row per packed piece).

Every stage handles null columns, empty and very long texts, repeated rows and
empty tables as its operator's module says, and keeps all columns it is given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyrent.llm import langid, mixing, packing, simhash, suffix_dedup
from tidyrent.llm.common import ship, stage, table
from tidyrent.llm.queries import MAX_BITS, MIX_BLOCK_ROWS, MIX_WEIGHTS, PACK_END_ID, SHINGLE, TOKENIZER

#: executors still hold what earlier stages left: the tokenizer remembers fewer pieces
MEMO_PIECES = 400_000
#: whole periods of the mix that are packed on their own, so that sequences follow the weights
SPAN_ROWS = 5 * sum(MIX_WEIGHTS.values()) * MIX_BLOCK_ROWS


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified. Declared language: ``lang``; host:
    ``source``."""
    ship(spark, give_back=True)
    found = langid.identify(docs, "text", F.col("lang"), F.lit(None).cast("string"), F.col("source"))
    return found.where("__lid_kept").select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: its smallest id."""
    ship(spark, give_back=True)
    return simhash.keep_first(docs, SHINGLE, MAX_BITS).select(*docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents have; ``n_chars``
    follows the text."""
    ship(spark, give_back=True)
    out = suffix_dedup.remove_repeats(docs)
    chars = F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the Pfair schedule."""
    ship(spark, give_back=True)
    return mixing.mixed(docs, MIX_WEIGHTS, block_rows=MIX_BLOCK_ROWS).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids and their places in packed sequences, which come
    in the mixed order, span by span."""
    ship(spark, give_back=True)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), PACK_END_ID, memo_pieces=MEMO_PIECES, span_rows=SPAN_ROWS)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]

#: tokenisation, XXH64 fingerprints and the text model are not SQL; tests compare
#: the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark, give_back=True)
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
