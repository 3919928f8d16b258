"""Token-ID / binary output: rANS-coded token files, written and read by Spark.

``write_tokens`` range-partitions the documents by id, so that partition *k*'s
ids all come before partition *k+1*'s, tokenises each partition in order and
codes it on the spot. The file format is a Parquet table with one row per
*segment* (some millions of ids): its shared frequency table and its blocks.
Blocks hold whole documents, in ascending id order, with the documents' sizes;
see ``rans`` for what a block holds. Parquet gives the format atomic commits, any
file system, and splits at segment boundaries. Nothing is written beside it.

``read_tokens`` decodes blocks in parallel (a block needs only its segment's
table) and returns every document's place and ids.

Defined results:

* null or empty text: the document is its end id alone;
* null document ids sort first and are kept; rows that share an id are all kept,
  in the order of their texts' hashes; exact repeats follow each other;
* very long texts: a document is never cut; its block grows with it;
* an empty table gives a table of no segments, read back as no rows;
* other columns of ``docs``, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import rans
from .common import small_side
from .tokens import TEXTS_AT_ONCE, crc32_u32, encoder

BLOCK = ("struct<doc_ids:array<bigint>,sizes:array<bigint>,n:bigint,lanes:int,span:int,words:binary,"
         "at:array<bigint>,states:array<binary>,crc:array<bigint>>")
SEGMENT = f"shard int, segment int, n_tokens bigint, symbols binary, freqs binary, blocks array<{BLOCK}>"
READ = "shard int, segment int, block int, place int, doc_id string, before bigint, ids binary"

SEGMENT_TOKENS = 1 << 22
BLOCK_TOKENS = 1 << 20
LANES = 1024
SPAN = 256


def _segment(docs: list[tuple], block_tokens: int, lanes: int, span: int) -> dict:
    """One segment of ``(doc_id, ids)``: table, then blocks of whole documents."""
    flat = np.concatenate([ids for _, ids in docs])
    symbols, freqs = rans.frequency_table(flat)
    table = rans.Table(symbols, freqs)
    blocks, first, begin, total = [], 0, 0, 0
    for k, (_, ids) in enumerate(docs):
        total += len(ids)
        if total - begin >= block_tokens or k == len(docs) - 1:
            part = flat[begin:total]
            block = rans.encode_block(part, table, rans.lanes_for(len(part), lanes), span)
            block["doc_ids"] = [d for d, _ in docs[first : k + 1]]
            block["sizes"] = [len(i) for _, i in docs[first : k + 1]]
            blocks.append(block)
            first, begin = k + 1, total
    return {"n_tokens": total, "symbols": symbols.astype("<u4").tobytes(), "freqs": freqs.astype("<u4").tobytes(), "blocks": blocks}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS, block_tokens: int = BLOCK_TOKENS,
                 lanes: int = LANES, span: int = SPAN) -> None:
    """Writes the token file of ``docs`` to ``path`` (any file system Spark
    knows). ``tokenizer``: place of a `tokenizers` JSON file, on every machine."""

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        enc, end = encoder(tokenizer), np.array([end_id], dtype=np.uint32)
        docs_now: list[tuple] = []
        size = segment = 0

        def flush() -> pd.DataFrame:
            row = _segment(docs_now, block_tokens, lanes, span) | {"shard": shard, "segment": segment}
            return pd.DataFrame([row])[["shard", "segment", "n_tokens", "symbols", "freqs", "blocks"]]

        for pdf in batches:
            for a in range(0, len(pdf), TEXTS_AT_ONCE):
                part = pdf.iloc[a : a + TEXTS_AT_ONCE]
                ids_of = [None if d is None else int(d) for d in part["doc_id"]]
                for d, ids in zip(ids_of, enc.encode(part["text"].tolist()), strict=True):
                    docs_now.append((d, np.concatenate([ids, end])))
                    size += len(ids) + 1
                    if size >= segment_tokens:
                        yield flush()
                        docs_now, size, segment = [], 0, segment + 1
        if docs_now:
            yield flush()

    rows = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
            .repartitionByRange("doc_id", F.xxhash64("text"))
            .sortWithinPartitions("doc_id", F.xxhash64("text")))
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas would hold numbers beside nulls as doubles
    rows.mapInPandas(code, SEGMENT).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (little-endian unsigned 32-bit) of every document of a token file."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, table = None, None
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if at != (row.shard, row.segment):
                    at = (row.shard, row.segment)
                    table = rans.Table(np.frombuffer(row.symbols, dtype="<u4"), np.frombuffer(row.freqs, dtype="<u4"))
                ids = rans.decode_block(row._asdict(), table).astype("<u4")
                sizes = np.asarray(row.sizes, dtype=np.int64)
                ends = np.cumsum(sizes)
                yield pd.DataFrame({
                    "shard": row.shard, "segment": row.segment, "block": row.block, "place": range(len(sizes)),
                    "doc_id": list(row.doc_ids), "before": ends - sizes,
                    "ids": [ids[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)],
                })

    blocks = (spark.read.schema(SEGMENT).parquet(path)
              .select("shard", "segment", "symbols", "freqs", F.posexplode("blocks").alias("block", "b"))
              .select("shard", "segment", "symbols", "freqs", "block", "b.*")
              .withColumn("doc_ids", F.transform("doc_ids", lambda x: x.cast("string"))))
    docs = blocks.mapInPandas(decode, READ)
    # a block's start: ids of the blocks before it; one row per block, not per document
    sizes = (spark.read.schema(SEGMENT).parquet(path)
             .select("shard", "segment", F.posexplode(F.col("blocks.n")).alias("block", "n")))
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    shard_base = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_base"))
    within = Window.partitionBy("shard").orderBy("segment", "block")
    bases = sizes.select("shard", "segment", "block", (F.sum("n").over(within) - F.col("n")).alias("base")).join(
        shard_base, "shard")
    bases = small_side(bases, "token-bases")
    return docs.join(bases, ["shard", "segment", "block"]).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("shard_base") + F.col("base") + F.col("before")).alias("start"),
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids")


def with_crc(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``ids_crc32``: the unsigned CRC-32 of ``ids``."""
    return tokens.withColumn("ids_crc32", F.crc32("ids"))


__all__ = ["crc32_u32", "read_tokens", "with_crc", "write_tokens"]
