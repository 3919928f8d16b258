"""Registered queries of the training-data operators: each applies its operator,
with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, cover_tree, langid, mixing, packing, quality_rules, simhash, suffix_dedup, token_output, topk, urls, whitening
from .common import scratch, stage, table

TOKENIZER = "byte_bpe_50k.json"
OUTPUT_END_ID = 2
PACK_END_ID = 0
MIX_WEIGHTS = {"src0": 6, "src1": 3, "src2": 3, "src3": 2}
MIX_BLOCK_ROWS = 8
SHINGLE = 3
MAX_BITS = 2
TOP_K = 5
SCALE = 256.0
COSINE = 0.93
WHITE_COMPONENTS = 32
WHITE_SCALE = 64.0
WHITE_SHIFT = 1_000_000
CENTROIDS = 40
CENTROID_ROUNDS = 5
CENTROID_DIMS = 64
CENTROID_SEED = 2
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-file")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), OUTPUT_END_ID)
    return token_output.with_crc(token_output.read_tokens(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    out = mixing.interleave(docs, MIX_WEIGHTS, block_rows=MIX_BLOCK_ROWS)
    names = ("phase", "block", "release", "deadline", "slot", "place")
    return out.select("doc_id", "source", *[F.col(f"__mix_{n}").cast("bigint").alias(n) for n in names])


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, TOP_K, SCALE)


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), PACK_END_ID)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages in one shape. A document's declared language is its
    ``lang``, its host its source; a page declares its language in its markup."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.lit(None).cast("bigint").alias("page_id"), "text", F.col("lang").alias("declared"),
        F.lit(None).cast("string").alias("address"), F.col("source").alias("host"))
    host, path = urls.split_url(F.col("url"))
    leading = F.regexp_extract(path, r"^/([A-Za-z]{2})(/|$)", 1)
    country = F.when(F.char_length(F.substring_index(host, ".", -1)) == 2, F.substring_index(host, ".", -1))
    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<!--.*?-->|<[^>]*>", " ")
    pages = table(spark, sf_dir, "pages").select(
        F.lit(None).cast("bigint").alias("doc_id"), "page_id", body.alias("text"),
        F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1).alias("declared"),
        F.when(leading != "", leading).otherwise(country).alias("address"), F.when(host != "", host).alias("host"))
    return docs.unionByName(pages)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(_texts(spark, sf_dir), "text", F.col("declared"), F.col("address"), F.col("host"))
    return out.select("doc_id", "page_id", F.col("__lid_lang").alias("language"),
                      F.round("__lid_posterior", 6).alias("posterior"), "declared", F.col("__lid_kept").alias("kept"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE, MAX_BITS)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text").unionByName(own)
    done = stage(chat.format_trees(chat.turn_tree(rows)), "chat-output").select("conv_id", "formatted", "loss")
    done = done.withColumns({"turns": chat.parse(F.col("formatted")), "learned": chat.loss_texts(F.col("formatted"), F.col("loss"))})
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return done.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.char_length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("bigint").alias("formatted_chars"))


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"), COSINE)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "template")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", "start_word", "end_word", "start_char", "end_char", "match_doc_id", "match_start_word")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_stop_words",
                      F.array_join("failed", ", ").alias("failed"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), WHITE_COMPONENTS, WHITE_SCALE, WHITE_SHIFT)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed, last = centroids.cluster(table(spark, sf_dir, "embeddings"), CENTROIDS, CENTROID_ROUNDS, SCALE, CENTROID_DIMS, CENTROID_SEED)
    return centroids.with_totals(routed, last)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_output, op2_pfair_mix, op3_exact_topk, op4_pack, op5_language_id, op6_simhash,
                            op7_chat, op8_cover_tree, op9_url_filter, op10_suffix_dedup, op11_quality_rules,
                            op12_whitening, op13_centroids, pipeline)
}
