"""Incremental stage 1 over a landing folder (Structured Streaming).

New JSON files (array or object documents) are picked up as they land,
exploded into records, projected on the declared raw columns and formatted
with the same column expressions as the batch job; each micro-batch is appended
to a Parquet table. The key intersection of the batch job needs every record
at once, so the stream uses the declared raw schema instead. Progress lives in
the checkpoint location (shared storage), so a restarted query resumes.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import format as fmt
from ..session import ensure_checkpoint_dir

_ARRAY = "array<map<string,string>>"
_MAP = "map<string,string>"


def formatted_stream(spark: SparkSession, folder: str, glob: str = "*.json",
                     columns: list[str] | None = None) -> DataFrame:
    cols = columns or fmt.RAW_TEXT_COLUMNS
    docs = (spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", 1000).load(folder)
            .select(F.col("_metadata.file_path").alias("source_file"), F.trim("value").alias("doc")))
    recs = F.when(F.col("doc").startswith("["), F.from_json("doc", _ARRAY)).when(
        F.col("doc").startswith("{"), F.array(F.from_json("doc", _MAP)))
    exploded = docs.select("source_file", F.posexplode(recs).alias("pos", "rec"))
    raw = exploded.select(F.xxhash64("source_file", "pos").alias("row_id"),
                          *[F.col("rec").getItem(c).alias(c) for c in cols])
    return fmt.format_listings(raw)


def start_ingest(spark: SparkSession, folder: str, out: str, checkpoint: str | None = None,
                 available_now: bool = False) -> StreamingQuery:
    checkpoint = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "stream-ingest")
    w = (formatted_stream(spark, folder).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
