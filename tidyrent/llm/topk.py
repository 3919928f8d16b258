"""Exact top-k search on a bit-sliced index.

Rows are quantised to integers and stored in blocks of ``block_rows`` rows: for
each dimension the values less the block's minimum, as bit slices — one bitmap
over the block's rows per bit. A query's integer inner product is a sum of
shifted slices: component ``q`` adds the slice of weight ``b`` at weight ``a + b``
for every set bit ``a`` of ``|q|`` (complemented slices for negative ``q``; both
shifts are constants of the query). Slices of one weight are added three at a
time by carry-save bitmap arithmetic, for all rows at once, which leaves the
scores of all rows as bit slices. The best rows are then taken from the most
significant slice downward; rows that still tie at the boundary are resolved by
the smaller id. No score is computed for any row but those that are returned.

Every row is indexed and every block is searched, so recall is 1. Work per query
and block is fixed by the bits, whatever the values. Queries travel to blocks
in bounded batches, ``DEAL`` of them to a task and block, so that no block is a hot
key; a task sees one batch and one block at a time.

Defined results: a vector that is null or holds null or non-finite components
takes no part, neither as query nor as candidate; an empty vector takes part
with inner product 0; vectors of different lengths are compared on the
components both have; null ids take no part; repeated rows are each candidates
(a query never meets rows of its own id); repeated query rows are answered once;
ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

BLOCK_ROWS = 32_768
BATCH = 64
#: batches that one task holds against one block, about
DEAL = 64

INDEX = "block int, n int, vec_ids binary, dims string, slices binary"
BATCHES = "batch bigint, vec_ids binary, sizes binary, vectors binary"
HITS = "query_id bigint, query_hash bigint, vec_id bigint, score bigint"


def quantise(vector, scale: float) -> np.ndarray | None:
    """floor(scale * x) of each component in double precision, or None."""
    if vector is None:
        return None
    v = np.asarray([np.nan if x is None else x for x in vector] if getattr(vector, "dtype", None) == object else vector, dtype=np.float64)
    return np.floor(scale * v).astype(np.int64) if np.isfinite(v).all() else None


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of 0/1 as rows of 64-bit bitmaps."""
    packed = np.packbits(bits.astype(np.uint8), axis=-1, bitorder="little")
    pad = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, pad)])).view("<u8")


def build_block(ids: np.ndarray, vectors: list[np.ndarray]) -> dict:
    """Bit slices of one block; rows in ascending id order."""
    order = np.argsort(ids, kind="stable")
    width = max(map(len, vectors))
    values = np.zeros((width, len(ids)), dtype=np.int64)
    for k, r in enumerate(order):
        values[: len(vectors[r]), k] = vectors[r]
    dims, slices = [], [np.zeros((0, -(-len(ids) // 64)), dtype="<u8")]
    for v in values:
        low, bits = int(v.min()), int(v.max() - v.min()).bit_length()
        dims.append((low, bits))
        if bits:
            slices.append(_words(((v - low) >> np.arange(bits)[:, None]) & 1))
    return {"n": len(ids), "vec_ids": ids[order].astype("<i8").tobytes(), "dims": json.dumps(dims),
            "slices": np.concatenate(slices).tobytes()}


class Block:
    """A block read back, ready to be searched."""

    def __init__(self, row):
        self.n = int(row.n)
        self.ids = np.frombuffer(row.vec_ids, dtype="<i8")
        self.dims = json.loads(row.dims)
        words = -(-self.n // 64)
        self.slices = np.frombuffer(row.slices, dtype="<u8").reshape(-1, words)
        self.first = np.cumsum([0] + [b for _, b in self.dims])
        self.all = _words(np.ones((1, self.n)))[0]

    def scores(self, q: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The rows' scores as bit slices, least significant first, and the
        constant to add to them."""
        constant, plain, flipped = 0, {}, {}
        for d, ((low, bits), x) in enumerate(zip(self.dims, q.tolist(), strict=False)):
            constant += x * low
            if not bits or not x:
                continue
            if x < 0:
                constant += x * ((1 << bits) - 1)
            to, a, x = (flipped if x < 0 else plain), 0, abs(x)
            while x:
                if x & 1:
                    for b in range(bits):
                        to.setdefault(a + b, []).append(int(self.first[d]) + b)
                x >>= 1
                a += 1
        out: list[np.ndarray] = []
        carried: dict[int, list[np.ndarray]] = {}
        w, top = 0, max([*plain, *flipped], default=-1)
        while w <= top:
            rows = self.slices[plain.get(w, [])]
            stack = [rows, ~self.slices[flipped[w]]] if w in flipped else [rows]
            now = np.concatenate(stack + carried.pop(w, []))
            above = carried.setdefault(w + 1, [])
            while len(now) > 2:  # full adders: three bitmaps to a sum and a carry
                m = len(now) // 3
                a, b, c = now[:m], now[m : 2 * m], now[2 * m : 3 * m]
                half = a ^ b
                above.append((a & b) | (half & c))
                now = np.concatenate([half ^ c, now[3 * m :]])
            if len(now) == 2:
                above.append((now[:1] & now[1:]))
                now = now[:1] ^ now[1:]
            out.append(now[0] if len(now) else np.zeros_like(self.all))
            if any(len(x) for x in above):
                top = max(top, w + 1)
            w += 1
        return out, constant

    def search(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The block's ``k`` best ``(id, score)`` for a query."""
        slices, constant = self.scores(q)
        rest = self.all.copy()
        lo, hi = np.searchsorted(self.ids, [query_id, query_id + 1])
        for p in range(lo, hi):
            rest[p >> 6] &= ~np.uint64(1 << (p & 63))
        sure, n = np.zeros_like(rest), 0
        for s in reversed(slices):
            high = rest & s
            m = int(np.bitwise_count(high).sum())
            if n + m > k:
                rest = high
            else:
                sure, n, rest = sure | high, n + m, rest & ~s
                if n == k:
                    break
        rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
        if n < k:  # ties at the boundary: rows are in id order
            rows = np.concatenate([rows, np.flatnonzero(np.unpackbits(rest.view(np.uint8), bitorder="little"))[: k - n]])
        score = [constant + sum(int(s[p >> 6] >> np.uint64(p & 63) & np.uint64(1)) << w for w, s in enumerate(slices)) for p in rows.tolist()]
        return [(int(self.ids[p]), x) for p, x in zip(rows, score, strict=True)]


def build_index(vectors: DataFrame, scale: float, id_col: str = "vec_id", vector_col: str = "embedding",
                block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """The staged index of all rows, and its number of blocks."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("embedding")).where(
        "vec_id is not null and embedding is not null")
    n_blocks = max(1, -(-rows.count() // block_rows))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        ids, got = [], []
        for pdf in batches:
            for i, v in zip(pdf["vec_id"], pdf["embedding"], strict=True):
                q = quantise(v, scale)
                if q is not None:
                    ids.append(i)
                    got.append(q)
        if ids:
            row = build_block(np.array(ids, dtype=np.int64), got) | {"block": TaskContext.get().partitionId()}
            yield pd.DataFrame([row])[["block", "n", "vec_ids", "dims", "slices"]]

    # dealt round robin: blocks are even whatever the ids, and hold block_rows rows
    return stage(rows.repartition(n_blocks).mapInPandas(build, INDEX), "bsi"), n_blocks


def query_batches(queries: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 32
        for pdf in batches:
            for a in range(0, len(pdf), BATCH):
                got = [(i, quantise(v, scale)) for i, v in zip(pdf["vec_id"][a : a + BATCH], pdf["embedding"][a : a + BATCH], strict=True)]
                got = [(i, q) for i, q in got if q is not None]
                if got:
                    yield pd.DataFrame({
                        "batch": [made], "vec_ids": [np.array([i for i, _ in got], dtype="<i8").tobytes()],
                        "sizes": [np.array([len(q) for _, q in got], dtype="<i8").tobytes()],
                        "vectors": [np.concatenate([q for _, q in got]).astype("<i8").tobytes()],
                    })
                    made += 1

    rows = queries.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("embedding")).where(
        "vec_id is not null and embedding is not null").distinct()
    return stage(rows.mapInPandas(build, BATCHES), "bsi-queries")


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: float, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row of ``vectors`` that
    ``is_query`` selects, its ``k`` rows of highest integer inner product."""
    index, n_blocks = build_index(vectors, scale, id_col, vector_col, block_rows)
    batches = query_batches(vectors.where(is_query), scale, id_col, vector_col)
    deals = -(-max(1, batches.count()) // DEAL)  # so many tasks share a block's queries
    batches = batches.withColumn("deal", F.pmod(F.xxhash64("batch"), F.lit(deals)).cast("int"))
    batches = batches.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def search(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, block = None, None
        for pdf in pairs:
            for row in pdf.itertuples(index=False):
                if at != row.block:
                    at, block = row.block, Block(row._replace(vec_ids=row.row_ids))
                ids = np.frombuffer(row.vec_ids, dtype="<i8")
                ends = np.cumsum(np.frombuffer(row.sizes, dtype="<i8"))
                flat = np.frombuffer(row.vectors, dtype="<i8")
                hits = [(int(i), xxhash.xxh64_intdigest(q.tobytes()) >> 1, v, s) for i, q in zip(ids, np.split(flat, ends[:-1]), strict=True) for v, s in block.search(int(i), q, k)]
                yield pd.DataFrame(hits, columns=["query_id", "query_hash", "vec_id", "score"])

    blocks = index.withColumnRenamed("vec_ids", "row_ids").withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    pairs = batches.join(blocks, ["block", "deal"])
    hits = pairs.mapInPandas(search, HITS)
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
