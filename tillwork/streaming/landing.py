"""Incremental landing of response pages with Structured Streaming.

The original job pulled one day per run.  Here the landing folder is a
file stream: every new page file is parsed (S1) and flattened (S2) exactly
once and appended to a Parquet table partitioned by ``report_date``; the
streaming checkpoint (which must live on shared storage) records which
files were consumed, so a restarted or re-run job neither loses nor repeats
pages.  ``availableNow`` processes what has landed and stops — the daily
batch job then reads the table with partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwork.sources.pages import CHANGE_LOG_ENTRY, flatten_change_log, pages_to_entries


def page_stream(spark: SparkSession, landed_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of (body, path) — one row per landed page file."""
    reader = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(landed_root)
    return raw.select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("path"))


def flattened_change_log_stream(spark: SparkSession, landed_root: str, stores: DataFrame | None = None,
                                max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 + S2 as a stateless streaming plan."""
    pages = page_stream(spark, landed_root, max_files_per_trigger)
    return flatten_change_log(pages_to_entries(pages, "body", "path", CHANGE_LOG_ENTRY, stores))


def land_change_log(spark: SparkSession, landed_root: str, table_path: str, checkpoint_location: str,
                    stores: DataFrame | None = None, available_now: bool = True,
                    processing_time: str | None = None) -> StreamingQuery:
    """Start the landing query; append-only Parquet sink partitioned by
    ``report_date``.  ``checkpoint_location`` must be on shared storage."""
    flat = flattened_change_log_stream(spark, landed_root, stores)
    writer = (flat.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_location).partitionBy("report_date"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(table_path)
