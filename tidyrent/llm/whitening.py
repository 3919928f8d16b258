"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers ``x`` (scaled, floored, shifted). One pass sums them;
with ``n`` rows and sums ``S`` the numbers ``n x - S`` are exact, and every product
is formed from centred values ``x - S / n``. Centred vectors are written as blocks,
many rows to a record.

The covariance ``V`` is never formed. A pass over the blocks returns ``XᵀX Q / n``
for a basis ``Q`` of ``components + guard`` columns: each task sums its blocks, sums
of tasks are joined in groups of about the root of their number, and the driver adds
the groups, in a fixed order. A round applies a Chebyshev polynomial of ``V`` to the
basis by the three-term recurrence, one pass per degree; it is small on the unwanted
spectrum ``[0, least Ritz value of the basis]`` and grows fast above. ``QR`` restores
an orthonormal basis, and one more pass gives the Rayleigh-Ritz vectors and, from
the same product, their residuals ``V u - θ u``.

It stops once every wanted residual is certified: at most ``CERTIFIED`` of the
greatest Ritz value, or, where rounding lets it fall no further, at most
``ROUNDING`` of it. A basis that spans all dimensions is exact after one round. What
does not certify within ``MAX_ROUNDS`` raises.

Whitened values are centred vectors projected on the components over the roots of
their eigenvalues; a last pass measures their covariance.

Defined results: rows whose vector is null, empty, or holds null or non-finite
components, or scaled ones beyond ``LIMIT`` (they are no exact whole numbers), take
no part and have no rows; if vectors differ in length, those of the most frequent
length (of equally frequent ones, the greatest) are the fit list and the others take
no part; rows with null or repeated ids are rows of their own; directions without
variance (eigenvalue at most ``FLAT`` of the trace) are no components, so equal
vectors, single rows and empty tables give no rows; eigenvectors of equal
eigenvalues are any orthonormal basis of theirs; a component's entry of greatest
size (of equal ones, the first) is positive; a deviation beyond a long's range is
null; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import stage

GUARD = 24
BLOCK_ROWS = 4096
LIMIT = float(1 << 40)
CERTIFIED = 4e-15
ROUNDING = 1e-12
FLAT = 1e-13
MAX_ROUNDS = 400
#: greatest growth of a column relative to another within a round, and the first
GROWTH = 1e10
FIRST_GROWTH = 1e4
MAX_DEGREE = 12

SUMS = "n bigint, dim int, total decimal(38,0)"
BLOCKS = "vec_ids binary, id_nulls binary, vectors binary"
PART = "part bigint, value binary"
WHITE = "vec_id bigint, deviation bigint, values array<double>"


class Fit(NamedTuple):
    n: int
    sums: np.ndarray  # Python integers
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    passes: int


def whole_numbers(vectors: DataFrame, scale: float, shift: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the fit list, all of one length."""
    v = F.col("vector")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LIMIT))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(fine)
    sizes = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = sizes[0]["dims"] if sizes else 0
    return rows.where(F.size("vector") == dims).select("vec_id", F.transform(v, lambda x: F.floor(x * scale) + shift).alias("vector"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


def _sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.release()
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch).sum(axis=0).astype(object)  # a batch's sums fit 64 bits, a task's may not
                n, total = n + batch.num_rows, own if total is None else total + own
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n] * len(total), "dim": pa.array(range(len(total)), pa.int32()),
                                              "total": pa.array([int(x) for x in total], pa.decimal128(38, 0))})

    out = rows.mapInArrow(partial, SUMS).groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim").collect()
    return (int(out[0]["n"]) if out else 0), np.array([int(r["total"]) for r in out], dtype=object)


def _centre(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n`` to the last bit but one: whole part first."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([float((s - int(w) * n) / n) for s, w in zip(sums, whole, strict=True)])
    return (x - whole) - rest


def _exact(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of squares of ``n x - S`` of each row."""
    widest = max(int(np.abs(x).max(initial=0)) * n, max(abs(int(s)) for s in sums))
    if widest < 1 << 61:
        d = x * n - np.array([int(s) for s in sums], dtype=np.int64)
        if len(sums) * int(np.abs(d).max(initial=0)) ** 2 < 1 << 63:
            return (d * d).sum(axis=1).tolist()
        d = d.astype(object)
    else:
        d = x.astype(object) * n - sums
    return [s if s < 1 << 63 else None for s in map(int, (d * d).sum(axis=1))]


def _blocks(rows: DataFrame) -> DataFrame:
    """Staged blocks of whole vectors."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                ids = part.column("vec_id")
                yield pa.RecordBatch.from_pylist([{
                    "vec_ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                    "id_nulls": ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                    "vectors": _matrix(part).astype("<i8").tobytes()}])

    return stage(rows.mapInArrow(cut, BLOCKS), "whitening-blocks")


def _total(blocks: DataFrame, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray], dims: int, tasks: int) -> np.ndarray:
    """Sum of ``of(x)`` over all blocks' whole vectors ``x``, read in ``tasks`` tasks."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        seen = False
        for batch in batches:
            for b in batch.column("vectors"):
                total += of(np.frombuffer(b.as_py(), dtype="<i8").reshape(-1, dims))
                seen = True
        if seen:
            yield pa.RecordBatch.from_pydict({"value": [total.tobytes()]})

    def joined(parts: pa.Table) -> pa.Table:
        rows = sorted(zip(parts["part"].to_pylist(), parts["value"].to_pylist(), strict=True))
        total = sum((np.frombuffer(v).reshape(shape) for _, v in rows), np.zeros(shape))
        return pa.table({"part": [rows[0][0]], "value": [total.tobytes()]})

    parts = blocks.mapInArrow(partial, "value binary").select(F.spark_partition_id().cast("bigint").alias("part"), "value")
    groups = math.isqrt(tasks)
    if groups > 8:
        parts = parts.groupBy((F.col("part") % groups).alias("g")).applyInArrow(lambda t: joined(t.select(["part", "value"])), PART)
    rows = sorted((r["part"], bytes(r["value"])) for r in parts.collect())
    return sum((np.frombuffer(v).reshape(shape) for _, v in rows), np.zeros(shape))


def subspace(product: Callable[[np.ndarray], np.ndarray], dims: int, components: int, guard: int = GUARD,
             seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """``(values, vectors)`` of the greatest eigenvalues of the symmetric positive
    semi-definite operator ``product``, certified by their residuals."""
    width = min(dims, components + guard)
    wanted = min(dims, components)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, width)))[0]
    best, growth = math.inf, FIRST_GROWTH
    for _ in range(MAX_ROUNDS):
        image = product(basis)
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        top = values[0]
        if top <= 0:
            return values[:wanted], basis[:, :wanted]
        worst = np.linalg.norm(image - basis * values, axis=0)[:wanted].max() / top
        if worst <= CERTIFIED or (worst <= ROUNDING and worst > best / 4) or (width == dims and worst <= ROUNDING):
            return values[:wanted], basis[:, :wanted]
        best = min(best, worst)
        # T_m on [0, bound]: scaled by its value at the greatest Ritz value
        bound = max(values[-1], top * 1e-12)
        half = bound / 2
        far = (top - half) / half
        degree = int(max(2, min(MAX_DEGREE, math.log(growth) / math.acosh(max(far, 1.0 + 1e-9)))))
        if width == dims:
            basis = np.linalg.qr(basis)[0]
            continue
        scale = 1 / far
        before, now = basis, (image - half * basis) * (scale / half)
        step = scale
        for _ in range(degree - 1):
            nxt = 1 / (2 / scale - step)
            before, now = now, (product(now) - half * now) * (2 * nxt / half) - before * (step * nxt)
            step = nxt
        now = now / np.maximum(np.linalg.norm(now, axis=0), 1e-300)
        basis = np.linalg.qr(now)[0]
        growth = GROWTH
    raise RuntimeError(f"no certificate after {MAX_ROUNDS} rounds: residual {best} of the greatest eigenvalue")


def fit(blocks: DataFrame, n: int, sums: np.ndarray, components: int, guard: int = GUARD) -> Fit:
    dims, passes = len(sums), 0
    tasks = blocks.rdd.getNumPartitions()

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def of(x: np.ndarray) -> np.ndarray:
            c = _centre(x, n, sums)
            return c.T @ (c @ q)

        return _total(blocks, q.shape, of, dims, tasks) / n

    values, vectors = subspace(product, dims, components, guard)
    trace = float(_total(blocks, (1, 1), lambda x: np.square(_centre(x, n, sums)).sum().reshape(1, 1), dims, tasks)[0, 0]) / n
    own = values > FLAT * trace
    values, vectors = values[own], vectors[:, own]
    sign = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(values))])
    return Fit(n, sums, trace, values, vectors * sign, passes + 1)


def whiten(vectors: DataFrame, components: int, scale: float, shift: int, id_col: str = "vec_id", vector_col: str = "embedding",
           guard: int = GUARD) -> DataFrame:
    """A row per remaining vector and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``."""
    if components < 1 or guard < 1:
        raise ValueError("components, guard: whole numbers from 1")
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, scale, shift, id_col, vector_col)
    n, sums = _sums(rows)
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not n:
        return spark.createDataFrame([], schema)
    blocks = _blocks(rows)
    own = fit(blocks, n, sums, components, guard)
    k, dims = len(own.values), len(sums)
    if not k:
        return spark.createDataFrame([], schema)
    project = own.vectors / np.sqrt(own.values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = _centre(x, n, sums) @ project
        return np.concatenate([w.T @ w, w.sum(axis=0)[None]])

    m = _total(blocks, (k + 1, k), moments, dims, blocks.rdd.getNumPartitions()) / n
    error = float(np.abs(m[:k] - np.outer(m[k], m[k]) - np.eye(k)).max())

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, null, body in zip(*(batch.column(c).to_pylist() for c in ("vec_ids", "id_nulls", "vectors")), strict=True):
                x = np.frombuffer(body, dtype="<i8").reshape(-1, dims)
                white = _centre(x, n, sums) @ project
                ids = pa.array(np.frombuffer(ids, dtype="<i8"), mask=np.frombuffer(null, dtype=np.uint8) == 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(_exact(x, n, sums), pa.int64()), lists], ["vec_id", "deviation", "values"])

    shares = F.array(*[F.lit(float(v / own.trace)) for v in own.values])
    long = blocks.mapInArrow(out, WHITE).select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened"))
    return long.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
