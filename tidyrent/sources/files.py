"""Sources and sinks (S1–S12) on any Hadoop-FS path (local, HDFS, object
stores): listing, JSON-record extraction, extension dispatch, CSV/JSON writes,
table overwrite and the decimal-point repair copy.

Every reader is a Spark read: files are split across tasks, nothing is
downloaded through the driver. Only the file *listing* (metadata) is looked at
on the driver, for the optional "first n files" cut.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from ..functions.text import decimal_point_repair
from ..session import broadcast_if_small, ensure_checkpoint_dir, stage_table

_MAP = MapType(StringType(), StringType())
_ARRAY = "array<map<string,string>>"
#: JSON files, whatever the case of their suffix; readers and counts share it
JSON_FILES = "*.[jJ][sS][oO][nN]"


def _require(path: str, what: str = "path") -> str:
    if not path or not str(path).strip():
        raise ValueError(f"empty {what}: give a folder or bucket path")
    return path


def scratch_dir(spark: SparkSession, name: str = "io") -> str:
    """A fresh folder under the session's shared checkpoint folder (never a
    machine-local temp folder on a cluster)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, name, uuid.uuid4().hex)


# ------------------------------------------------------------------ S1, S2
def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """``(path, length, modificationTime)`` of every file under
    ``folder`` (recursive). Only metadata columns are read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(_require(folder, "folder")).select("path", "length", "modificationTime")


def table_rows(spark: SparkSession, folder: str) -> DataFrame:
    """S1/S2 over data files: ``(table_name, n_rows)`` for every Parquet file or
    folder ``<table_name>.parquet`` below ``folder``; a listed file without rows
    counts as 0. The scan has no data columns, so it reads footers only."""
    name = F.regexp_extract("path", r"([^/]+)\.parquet", 1)
    scan = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .schema("unread int").parquet(folder).select(F.col("_metadata.file_path").alias("path")))
    listed = list_files(spark, folder, "*.parquet").select("path", F.lit(0).alias("n"))
    both = scan.select("path", F.lit(1).alias("n")).unionByName(listed)
    return both.groupBy(name.alias("table_name")).agg(F.sum("n").cast("bigint").alias("n_rows"))


def first_files(spark: SparkSession, folder: str, max_files: int | None, suffix: str = ".json") -> list[str]:
    """S4 cut: the first ``max_files`` listed paths (listing order = path
    order), then the suffix test — a non-matching file uses up a slot, as in the
    source. ``None`` = every file."""
    listing = list_files(spark, folder).select("path").orderBy("path")
    if max_files is not None:
        if max_files < 0:
            raise ValueError("max_files must be >= 0")
        listing = listing.limit(max_files)
    return [r.path for r in listing.where(F.col("path").endswith(suffix)).collect()]


# ------------------------------------------------------------------ S3, S4
def read_json_records(spark: SparkSession, folder: str | list[str], shape: str = "document",
                      glob: str = JSON_FILES) -> DataFrame:
    """S3: one row per JSON record: ``(row_id, source_file, rec)``; ``rec`` is
    a ``map<string,string>`` (scalar values as their JSON text, a key with a
    null value kept with a null entry).

    ``shape="document"``: each file is one JSON document — an array extends
    the record list, an object is one record, anything else is skipped (and
    counted in ``_corrupt``). ``shape="lines"``: JSON-lines files (what Spark's
    JSON writer produces). ``row_id`` = xxhash64(file, position): the index in the
    file's array, or the line's number in its file. Neither moves with the order
    of files or with how they are split.
    """
    paths = folder if isinstance(folder, list) else [_require(folder, "folder")]
    if not paths:
        return spark.createDataFrame([], "row_id bigint, source_file string, rec string")
    if shape == "document":
        # text()'s own wholetext argument (default False) overrides a reader option
        raw = (spark.read.option("recursiveFileLookup", "true")
               .option("pathGlobFilter", glob).text(paths, wholetext=True)
               .select(F.col("_metadata.file_path").alias("source_file"), F.trim("value").alias("doc")))
        recs = F.when(F.col("doc").startswith("["), F.from_json("doc", _ARRAY)).when(
            F.col("doc").startswith("{"), F.array(F.from_json("doc", _MAP)))
        out = raw.select("source_file", F.posexplode(recs).alias("pos", "rec"))
    elif shape == "lines":
        lines = numbered_lines(spark, paths, glob).select(
            "source_file", F.col("line").alias("pos"), F.trim("value").alias("rec"))
        # a malformed line is no record: it must not cost the others their keys
        out = (lines.where(F.col("rec").startswith("{")).withColumn("rec", F.from_json("rec", _MAP))
               .where(F.col("rec").isNotNull()))
    else:
        raise ValueError("shape must be 'document' or 'lines'")
    return out.select(F.xxhash64("source_file", "pos").alias("row_id"), "source_file", "rec")


def file_lines(spark: SparkSession, paths: str | list[str], glob: str | None = None,
               line_sep: str | None = None) -> DataFrame:
    """Lines of text files as their splits give them: ``(source_file, block, seq,
    value)``; ``block`` is the split's first byte and ``seq`` grows by one from each
    line of a split to its next."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value")


def split_totals(lines: DataFrame, **sums: F.Column) -> DataFrame:
    """One row per split of ``file_lines``: its first ``seq``, the number of lines
    in its file before it (``lines_before``) and, for each of ``sums``, the sum over
    those lines (``<name>_before``). The window holds one row per split of a file."""
    per_split = lines.groupBy("source_file", "block").agg(
        F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("lines"),
        *[F.sum(c).alias(n) for n, c in sums.items()])
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return stage_table(per_split.select(
        "source_file", "block", "first_seq",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in ("lines", *sums)]))


def numbered_lines(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """``(source_file, line, value)``: each line with its number in its file, from
    0, empty lines counted. A first pass counts the lines of every split, prefix
    sums give each split its first number, and the second pass adds the place in
    the split: no line is shuffled, and the numbers are those of a single-task read
    for any split size. One row per split is joined back."""
    lines = file_lines(spark, paths, glob)
    starts = broadcast_if_small(split_totals(lines))
    return lines.join(starts, ["source_file", "block"]).select(
        "source_file", (F.col("lines_before") + F.col("seq") - F.col("first_seq")).alias("line"), "value")


def malformed_lines(spark: SparkSession, paths: str | list[str], glob: str = JSON_FILES) -> int:
    """Q7 for JSON lines: non-empty lines that hold no JSON object, which the reader
    skips. One pass."""
    text = F.trim("value")
    bad = ~text.startswith("{") | F.from_json(text, _MAP).isNull()
    return file_lines(spark, paths, glob).where((text != "") & bad).count()


def _as_map(c: F.Column, dtype) -> F.Column:
    return F.from_json(c, _MAP) if isinstance(dtype, StringType) else c


def skipped_documents(spark: SparkSession, folder: str | list[str], glob: str = JSON_FILES) -> int:
    """Q7: files whose document is neither a JSON array nor an object (or does
    not parse) — skipped by the reader, counted here."""
    paths = folder if isinstance(folder, list) else [_require(folder, "folder")]
    if not paths:
        return 0
    docs = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
            .text(paths, wholetext=True).select(F.trim("value").alias("doc")))
    parsed = F.when(F.col("doc").startswith("["), F.from_json("doc", _ARRAY).isNotNull()).when(
        F.col("doc").startswith("{"), F.from_json("doc", _MAP).isNotNull()).otherwise(F.lit(False))
    return docs.where(~parsed).count()


def common_keys(records: DataFrame, rec: str = "rec") -> list[str]:
    """Keys present in every record (a key with a null value counts as
    present). A grouped count of (key) over de-duplicated per-record key lists;
    only the key names (schema-level, small) reach the driver. Sorted."""
    n = records.count()
    if n == 0:
        return []
    m = _as_map(F.col(rec), records.schema[rec].dataType)
    keys = records.select(F.explode(F.map_keys(m)).alias("k"))  # map keys are unique per record
    common = keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == n)
    return sorted(r.k for r in common.collect())


def records_to_columns(records: DataFrame, keys: list[str] | None = None, rec: str = "rec",
                       keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Project the common keys as string columns (values as raw JSON text)."""
    keys = common_keys(records, rec) if keys is None else keys
    m = _as_map(F.col(rec), records.schema[rec].dataType)
    return records.select(*keep, *[m.getItem(k).alias(k) for k in keys])


def read_listing_folder(spark: SparkSession, folder: str, max_files: int | None = None,
                        shape: str = "document") -> DataFrame:
    """S1 → S4 → S3 → P1: raw listings (strings) from a folder of JSON files.
    An empty result raises (Q1): the source stops on empty input."""
    paths = first_files(spark, folder, max_files) if max_files is not None else folder
    recs = read_json_records(spark, paths, shape)
    if recs.isEmpty():
        raise ValueError(f"no JSON records under {folder!r}")
    keys = common_keys(recs)
    if "row_id" in keys:  # records carry their own id
        return records_to_columns(recs, keys, keep=()).withColumn("row_id", F.col("row_id").try_cast("bigint"))
    return records_to_columns(recs, keys)


# ------------------------------------------------------------------ S5
def read_by_extension(spark: SparkSession, path: str, **csv_opts) -> DataFrame:
    """Json → records, txt → text, csv → table, anything else → bytes.
    Errors raise (the source returned None and failed later)."""
    ext = _require(path).rsplit(".", 1)[-1].lower()
    if ext == "json":
        return read_json_records(spark, path)
    if ext == "txt":
        return spark.read.text(path, wholetext=True)
    if ext == "csv":
        return read_csv(spark, path, **csv_opts)
    return spark.read.format("binaryFile").load(path)


# ------------------------------------------------------------------ S6–S10
def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True) -> DataFrame:
    """S6/S10 read side: text with newlines and doubled quotes, short rows
    padded with null, extra fields dropped (PERMISSIVE)."""
    r = (spark.read.option("header", header).option("multiLine", "true").option("escape", '"')
         .option("mode", "PERMISSIVE"))
    if schema:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true")
    return r.csv(_require(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header + quoted text, straight to the (remote) path."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(_require(path))
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines, UTF-8 unescaped; null-valued keys are written (a key
    with a null value still counts as present for the key intersection)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(_require(path))
    return path


def load_table(spark: SparkSession, csv_path: str, table: str, location: str, schema: str | None = None
               ) -> DataFrame:
    """CSV (header skipped, permissive) → replace the table at ``location``."""
    return replace_table(read_csv(spark, csv_path, schema), table, location)


def repair_decimal_points(df: DataFrame, positions: Mapping[str, int]) -> DataFrame:
    """Keep only the repaired columns (as the source's CREATE OR
    REPLACE … SELECT does)."""
    return df.select(*[decimal_point_repair(F.col(c), p).alias(c) for c, p in positions.items()])


class AuditFailed(ValueError):
    """New rows of a table broke a rule; the table is as it was."""


def replace_table(df: DataFrame, table: str, location: str, rules: Mapping[str, F.Column] | None = None,
                  min_rows: int = 0) -> DataFrame:
    """Write beside, audit, then swap. The rows go to a new folder below
    ``location``; a pass over what was written counts rows and, per rule, those for
    which it does not hold (null counts as not); only then the catalog entry is
    pointed at the new folder. A failed write or audit leaves table and rows as they
    were, and a running reader keeps its files: a replaced version stays until the
    next replacement. One writer at a time per table.

    With unchanged columns the swap is one catalog call; other columns take a drop
    of the entry and its creation, without touching rows."""
    spark = df.sparkSession
    fresh = f"{_require(location, 'table location').rstrip('/')}/version-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    written = spark.read.parquet(fresh)
    rules = rules or {}
    broken = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    seen = written.agg(F.count(F.lit(1)).alias("__rows"), *broken).first()
    faults = {name: seen[name] for name in rules if seen[name]}
    if faults or seen["__rows"] < min_rows:
        _delete(spark, [fresh])
        raise AuditFailed(f"{table}: {seen['__rows']} rows (at least {min_rows}), rows that break rules: {faults}")
    old = _versions(spark, location, fresh)
    current = None
    if spark.catalog.tableExists(table):
        current = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    if current is not None and spark.table(table).schema == written.schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=fresh, source="parquet")
    _delete(spark, [path for path in old if current is None or not current.endswith(path.rsplit("/", 1)[-1])])
    return spark.table(table)


def _versions(spark: SparkSession, location: str, fresh: str) -> list[str]:
    """Folders of finished earlier versions below ``location``."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [f"{location.rstrip('/')}/{n}" for n in names if n.startswith("version-") and not fresh.endswith(n)]
    return [path for path in found if fs.exists(done(path, "_SUCCESS"))]


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def rewrite_decimals(spark: SparkSession, source: str, table: str, location: str,
                     positions: Mapping[str, int]) -> DataFrame:
    """The table ``table`` becomes the repaired columns of table ``source``."""
    return replace_table(repair_decimal_points(spark.table(source), positions), table, location)
