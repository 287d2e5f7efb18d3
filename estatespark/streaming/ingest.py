"""Incremental ingestion of yearly files with Structured Streaming.

New raw files landing in the raw folder are picked up by a file-source stream, filtered to
the configured areas, tagged with their year and appended to the year-partitioned silver
table. ``availableNow`` processes whatever has landed and stops, so the same job serves a
scheduled batch run; the checkpoint records processed files, so a rerun (or a restart
after a lost executor or driver) never ingests a file twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import Config
from ..plans.ingest import filter_areas
from ..sources.files import CSV_OPTIONS, RAW_SCHEMA, year_from_path


def raw_stream(spark: SparkSession, raw_dir: str, cfg: Config,
               max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(RAW_SCHEMA).option("header", "false")
              .options(**CSV_OPTIONS)
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.csv"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.csv(raw_dir)
    return df.select(*RAW_SCHEMA.fieldNames(),
                     year_from_path(cfg.year_in_path_pattern).alias("source_year"))


def ingest_available(spark: SparkSession, raw_dir: str, silver_dir: str, checkpoint_dir: str,
                     cfg: Config, timeout_s: int | None = None) -> str:
    """Process every file landed so far into the silver table, then stop.

    Waits to the end, however long; a caller who wants a limit gives it in seconds."""
    q = (filter_areas(raw_stream(spark, raw_dir, cfg), cfg)
         .writeStream.format("parquet")
         .option("path", silver_dir)
         .option("checkpointLocation", checkpoint_dir)
         .option("compression", "snappy")
         .partitionBy("source_year")
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("streaming ingestion did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return silver_dir
