"""Centroid clustering on Hilbert-ordered blocks with zone maps.

Vectors are quantised to integers and sorted over the whole cluster along a Hilbert
curve (range partitions of curve key, hash and id, so a vector that a third of all
rows share spreads over tasks). Runs of ``block_rows`` sorted vectors are written as
blocks, each with the least and greatest value of every dimension. The curve runs
through the ``curve_dims`` dimensions of greatest variance, ``curve_bits`` bits each.

In a round every block compares its box with all centroids: no vector of the box is
nearer to a centroid than the box is, nor farther than the box's farthest corner. A
centroid is a candidate if its least distance is at most the smallest greatest
distance of any; ties stay candidates. All vectors of the block are then compared
with the candidates in exact integer arithmetic, by one matrix product. Tasks return
counts and sums by centroid and dimension; a grouped sum joins them, so a round
brings ``k * dims`` numbers to the driver, whatever the rows.

Distances and sums are exact: components of up to ``LIMIT`` keep every product and
sum of a block within the integers that doubles hold.

Defined results: vectors that are null, have another number of components than
``dims``, hold null or non-finite components, or whose scaled components exceed
``LIMIT`` (squared distances would leave a long's range) take no part and have no
row; rows with a null id are assigned but never start a centroid; rows that share an
id start a centroid each, ordered by their components; fewer vectors than ``k`` give
fewer centroids; equal distances go to the smaller number; an empty centroid stays
where it is; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import stage

BLOCK_ROWS = 512
CURVE_DIMS = 16
CURVE_BITS = 4
#: scaled components: 64 squares of differences stay below 2**53
LIMIT = 1 << 22

KEYED = "vec_id bigint, vector binary, curve binary"
BLOCKS = "vec_ids binary, id_nulls binary, vectors binary, low binary, high binary"
SUMS = "cluster int, dim int, total bigint"
ROUTED = "vec_id bigint, cluster int, distance bigint"


def _packed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows)
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1] * rows.itemsize), len(rows), [None, pa.py_buffer(rows.tobytes())])
    return fixed.cast(pa.binary())


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of rows of cell numbers of ``bits`` bits, as
    rows of big-endian bytes: their byte order is the curve's.

    From the highest bit down, a dimension whose bit is set turns the lower bits of
    the first dimension over, and else swaps them with the first's; the Gray code of
    the bits, dimension by dimension, is the position."""
    x = np.ascontiguousarray(cells.T.astype(np.int64))
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(n):
            up = (x[d] >> b) & 1 == 1
            swap = np.where(up, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(up, low, swap)
            x[d] ^= swap
    for d in range(1, n):
        x[d] ^= x[d - 1]
    turn = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    planes = [((x[d] >> b) & 1).astype(np.uint8) for b in range(bits - 1, -1, -1) for d in range(n)]
    return np.packbits(np.stack(planes, axis=1), axis=1)


def quantised(vectors: DataFrame, scale: float, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part; whole numbers as doubles."""
    v = F.col("vector")
    fine = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float(LIMIT)))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.where(fine).select("vec_id", F.transform(v, lambda x: F.floor(x * scale)).alias("vector"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of ``seed:id``, in hash order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id is not null").orderBy(digest, "vector").limit(k).select("vector").collect()
    return np.array([r["vector"] for r in first], dtype=np.int64)


def _shape(rows: DataFrame, dims: int, curve_dims: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dimensions of greatest variance, and per such dimension the least value and
    the width of a cell."""
    stats = (rows.select(F.posexplode("vector").alias("dim", "x")).groupBy("dim")
             .agg(F.var_pop(F.col("x").cast("double")).alias("spread"), F.min("x").alias("low"), F.max("x").alias("high")).collect())
    stats = sorted(stats, key=lambda r: (-r["spread"], r["dim"]))[:curve_dims]
    low = np.array([r["low"] for r in stats], dtype=np.float64)
    high = np.array([r["high"] for r in stats], dtype=np.float64)
    return np.array([r["dim"] for r in stats]), low, np.maximum(1.0, (high - low + 1) / (1 << bits))


def blocks(rows: DataFrame, dims: int, block_rows: int = BLOCK_ROWS, curve_dims: int = CURVE_DIMS, curve_bits: int = CURVE_BITS) -> DataFrame:
    """Staged blocks of Hilbert-ordered vectors with their boxes."""
    axes, low, width = _shape(rows, dims, curve_dims, curve_bits)
    if not len(axes):
        return rows.sparkSession.createDataFrame([], BLOCKS)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.release()
        for batch in batches:
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims).astype("<i4")
            cells = np.minimum((x[:, axes] - low) // width, (1 << curve_bits) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _packed(x), _packed(hilbert_keys(cells, curve_bits))], ["vec_id", "vector", "curve"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def block(part: pa.Table) -> dict:
            x = np.frombuffer(b"".join(part["vector"].to_pylist()), dtype="<i4").reshape(len(part), dims)
            ids = part["vec_id"].combine_chunks()
            return {"vec_ids": ids.fill_null(0).to_numpy().astype("<i8").tobytes(), "id_nulls": ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                    "vectors": x.tobytes(), "low": x.min(axis=0).tobytes(), "high": x.max(axis=0).tobytes()}

        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            whole = len(held) // block_rows * block_rows
            if whole:
                yield pa.RecordBatch.from_pylist([block(held.slice(a, block_rows)) for a in range(0, whole, block_rows)])
                held = held.slice(whole)
        if held is not None and len(held):
            yield pa.RecordBatch.from_pylist([block(held)])

    order = ["curve", "__tie", "vec_id"]
    sortable = rows.mapInArrow(keyed, KEYED).withColumn("__tie", F.xxhash64("vec_id"))
    return stage(sortable.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "vector").mapInArrow(cut, BLOCKS), "centroid-blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector of the box."""
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    corner = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    nearest, farthest = (outside * outside).sum(axis=1), (corner * corner).sum(axis=1)
    return np.flatnonzero(nearest <= farthest.min())


def _assign(row, dims: int, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Vectors of a block, their centroids and squared distances, and how many
    candidates were compared."""
    x = np.frombuffer(row.vectors, dtype="<i4").reshape(-1, dims).astype(np.int64)
    low, high = (np.frombuffer(b, dtype="<i4").astype(np.int64) for b in (row.low, row.high))
    own = candidates(low, high, centroids)
    # about the box's middle the numbers are small; all are whole and below 2**53
    middle = (low + high) // 2
    a, c = x - middle, centroids[own] - middle
    product = a.astype(np.float64) @ c.T.astype(np.float64)
    distance = (a * a).sum(axis=1)[:, None] - 2 * product.astype(np.int64) + (c * c).sum(axis=1)
    best = np.argmin(distance, axis=1)  # the first of the least: the smaller number
    return x, own[best], distance[np.arange(len(x)), best], len(own)


def _sums(staged: DataFrame, dims: int, centroids: np.ndarray) -> dict[tuple[int, int], int]:
    """Per centroid the sum of each dimension, and under dimension -1 the count."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = len(centroids)
        total, count = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                x, cluster, _, _ = _assign(row, dims, centroids)
                np.add.at(total, cluster, x)
                count += np.bincount(cluster, minlength=k)
        both = np.concatenate([count[:, None], total], axis=1)
        own = np.flatnonzero(count)
        yield pd.DataFrame({"cluster": np.repeat(own, dims + 1), "dim": np.tile(np.arange(-1, dims), len(own)), "total": both[own].ravel()})

    grouped = staged.mapInPandas(partial, SUMS).groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return {(r["cluster"], r["dim"]): int(r["total"]) for r in grouped.collect()}


def cluster(vectors: DataFrame, k: int, rounds: int, scale: float, dims: int, seed: int, id_col: str = "vec_id", vector_col: str = "embedding",
            block_rows: int = BLOCK_ROWS, curve_dims: int = CURVE_DIMS, curve_bits: int = CURVE_BITS) -> tuple[DataFrame, np.ndarray]:
    """Staged ``vec_id, cluster, distance`` of every vector that takes part, and the
    final centroids."""
    if dims * (2 * LIMIT) ** 2 > 1 << 53:
        raise ValueError("dims: squared distances must stay below 2**53")
    rows = quantised(vectors, scale, dims, id_col, vector_col)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], ROUTED), centroids
    staged = blocks(rows, dims, block_rows, curve_dims, curve_bits)
    for _ in range(rounds):
        total = _sums(staged, dims, centroids)
        centroids = np.array([[total[j, d] // total[j, -1] for d in range(dims)] if (j, -1) in total else c.tolist()
                              for j, c in enumerate(centroids)], dtype=np.int64)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pandas().itertuples(index=False):
                _, own, distance, _ = _assign(row, dims, centroids)
                null = np.frombuffer(row.id_nulls, dtype=np.uint8) == 1
                ids = pa.array(np.frombuffer(row.vec_ids, dtype="<i8"), mask=null)
                yield pa.RecordBatch.from_arrays([ids, pa.array(own.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return stage(staged.mapInArrow(route, ROUTED), "centroid-routed"), centroids


def candidate_share(staged: DataFrame, dims: int, centroids: np.ndarray) -> float:
    """Share of centroids that blocks compare their vectors with."""
    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"n": [_assign(r, dims, centroids)[3] for r in pdf.itertuples(index=False)]})

    return staged.mapInPandas(compared, "n bigint").agg(F.avg("n")).first()[0] / len(centroids)


def with_totals(routed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``routed`` with each cluster's and the whole inertia and the hash of its
    centroid; what is joined and collected has one row per centroid."""
    own = {r["cluster"]: r["s"] for r in routed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(j, own.get(j, 0), sum(own.values()), hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest()) for j, c in enumerate(centroids)]
    named = routed.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return routed.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
