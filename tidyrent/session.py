"""Spark session helpers.

Everything in the package works on whatever session the caller passes in; this
module only builds a sensible local session for tests and benchmarks, and
answers "where may I cut lineage?" from the session's own configuration.
"""

from __future__ import annotations

import atexit
import contextlib
import gc
import os
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidyrent") -> SparkSession:
    """A local session for tests / bench. On a cluster, use the cluster's session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage and is
    used as is; without it a cluster session is refused, as no machine-local
    folder would be seen by the other machines. Only a ``local`` master (tests,
    bench) gets a folder of its own, removed when the process ends.
    """
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_KEY, None)
    if not current:
        if not (sc.master or "").startswith("local") or "cluster" in sc.master:
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tidyrent-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set(CHECKPOINT_KEY, current)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint): the data sits in the
    shared folder, not in executor block managers.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_folder(spark: SparkSession) -> str:
    """A new folder below the session's shared checkpoint folder; it goes when the
    session's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stage_table(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table into a ``stage_folder`` and read back: it
    cuts lineage as a checkpoint does, is columnar, and later filters and column
    choices reach its scan."""
    path = stage_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of what finished stages left on the driver. Shuffle files, broadcasts,
    checkpoints and plans go only once its garbage is collected, which the JVM puts off
    until the heap has grown to its limit; and what planning and compiling have freed
    stays in the C library's pools until it is trimmed (a JVM that can't goes on)."""
    gc.collect()  # Python's handles hold theirs in the JVM
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    with contextlib.suppress(Py4JJavaError):
        trim_native(spark)


def trim_native(spark: SparkSession) -> str:
    """Have the driver's JVM trim its native heap; its answer."""
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    # by the interface's method: Py4J finds none on the server's own class, which isn't public
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    what = array(jvm.Object, 4)
    what[0], what[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    what[2], what[3] = array(jvm.Object, 0), array(jvm.String, 0)
    return invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), what)


# a side joined by broadcast must have at most this many rows (checked by count)
MAX_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Materialise a (supposedly small) side, count it, and hint a broadcast
    only when the count is within ``max_rows``; otherwise the planner keeps a
    shuffle join. Group-level tables (one row per district, per cell …) are
    small in practice but not bounded by construction, hence the check."""
    small = cut_lineage(df)
    return F.broadcast(small) if small.count() <= max_rows else small


def stage_partitions(spark: SparkSession) -> int:
    """Partition count for a stage table: the cluster's parallelism or the
    configured shuffle width, whichever is larger (sized by the operator for
    the data volume on a real cluster)."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(spark.sparkContext.defaultParallelism, shuffle)


def stage(df: DataFrame, key: str | None = "row_id") -> DataFrame:
    """Materialise a stage table: hash-partitioned on ``key`` and cut from its
    lineage with a reliable checkpoint. Spreads under-partitioned inputs (one
    file, one row group) evenly over the cluster."""
    return cut_lineage(spread(df, key))


def spread(df: DataFrame, key: str | None = "row_id") -> DataFrame:
    """Hash-repartition on ``key``. With AQE on, the partition count is left to
    AQE (sized from the shuffled bytes, at least the cluster's parallelism for
    data that warrants it); without AQE, ``stage_partitions``."""
    spark = df.sparkSession
    aqe = spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    has_key = bool(key) and key in df.columns
    if aqe:
        return df.repartition(key) if has_key else df.repartition(stage_partitions(spark))
    n = stage_partitions(spark)
    return df.repartition(n, key) if has_key else df.repartition(n)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
