"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: a side is broadcast only if its written table is at most this large
BROADCAST_BYTES = 4 << 20
#: hashes that tell rows which cannot match from those that may
BUCKETS = 1 << 20
#: a key that more rows than this share is dealt to ``SALTS`` places
HOT_ROWS = 256
SALTS = 64
#: bounds of one Arrow batch between Spark and a Python worker
ARROW_BYTES = 8 << 20
ARROW_ROWS = 4096


WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
                 "MALLOC_TRIM_THRESHOLD_": str(4 << 20)}


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder; the file
    system it lies in removes it when the session's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    at = _path(spark, path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stage(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it cuts lineage, keeps
    column pruning, and outlives any executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def bytes_of(staged: DataFrame) -> int:
    """Bytes of a table that ``stage`` wrote."""
    spark = staged.sparkSession
    at = _path(spark, staged._staged_at)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(at).getLength()


def free(staged: DataFrame) -> None:
    """Deletes a staged table that nothing reads any more."""
    at = _path(staged.sparkSession, staged._staged_at)
    at.getFileSystem(staged.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")


def may_be_among(df: DataFrame, key: Column, keys: DataFrame, among: Column) -> tuple[DataFrame, DataFrame]:
    """``df`` in two parts, with a hash of ``key`` that some value of ``among`` in
    ``keys`` shares, and without: those surely are not among them. What is broadcast
    is the set of hashes, of which there are ``BUCKETS``, whatever the tables hold."""
    (name,) = fresh(df, "__bucket")
    hashes = stage(keys.select(F.pmod(F.xxhash64(among), F.lit(BUCKETS)).alias(name)).distinct(), "buckets")
    with_hash = df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(BUCKETS)))
    columns = [quoted(c) for c in df.columns]
    return tuple(with_hash.join(F.broadcast(hashes), name, how).select(*columns) for how in ("left_semi", "left_anti"))


def salted(left: DataFrame, right: DataFrame, key: str, by: Column) -> DataFrame:
    """``left`` joined on ``key`` with ``right``, whose rows are met in ``SALTS`` places
    each: for keys that very many rows of ``left`` share and few of ``right``."""
    salt = fresh(left.join(right, key), "__salt")[0]
    many = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(many, [key, salt]).drop(salt)


def small_side(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` and hints a broadcast only if it came out small; beyond
    that the planner joins by shuffle."""
    staged = stage(df, name)
    return F.broadcast(staged) if bytes_of(staged) <= BROADCAST_BYTES else staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession, give_back: bool = False) -> None:
    """Lets Python workers import this package from where the driver did, and
    bounds what a worker holds at once: batches of at most ``ARROW_BYTES``.
    ``give_back``, before the first worker starts: their allocators return what a
    stage frees to the system, which costs time, instead of keeping it beside what
    the next stage needs."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    if give_back:
        spark.sparkContext.environment.update(WORKER_MEMORY)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
