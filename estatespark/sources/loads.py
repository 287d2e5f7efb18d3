"""Incremental warehouse load with a history of loaded files.

``load_new`` compares the files under a prefix with the ledger and loads those it does not know:
new ones, and ones whose size or time has changed. Rows are appended under the load's number, then
the ledger gets one row a file. The ledger is what commits a load: rows of a load that died before
it are not seen, and their files load again. A changed file replaces its earlier rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import bounded_broadcast
from .files import CSV_OPTIONS, RAW_SCHEMA, to_warehouse, year_from_path

LEDGER = "path string, bytes long, modified timestamp, rows long, load int, loaded_at timestamp"
LEDGER_BROADCAST_ROWS = 200_000  # of a path's length: some 50 MB


def listed(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes and modified of the files below root; no file's content is read.
    Empty files are not listed."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")))


def history(spark: SparkSession, base: str) -> DataFrame:
    """The ledger below ``base``: one row for each load of a file; empty before the first load."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/ledger")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{base}/ledger")


def pending(spark: SparkSession, root: str, base: str) -> DataFrame:
    """Files below root that no load has taken as they are now."""
    known = history(spark, base).select("path", "bytes", "modified")
    return listed(spark, root).join(known, ["path", "bytes", "modified"], "left_anti")


def load_new(spark: SparkSession, root: str, base: str, year_pattern: str, loaded_at: Column | None = None,
             schema: T.StructType = RAW_SCHEMA) -> int:
    """Loads the pending yearly CSV files below root into ``base`` and returns how many there were.

    The driver holds the listing of the new files, as any scan of them does.
    """
    files = pending(spark, root, base).collect()
    if not files:
        return 0
    load = (history(spark, base).agg(F.max("load")).first()[0] or 0) + 1
    rows = (spark.read.schema(schema).option("header", "false").options(**CSV_OPTIONS).csv([f.path for f in files])
            .select("*", year_from_path(year_pattern).alias("source_year"), F.col("_metadata.file_path").alias("file")))
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    to_warehouse(rows, stamp).write.mode("overwrite").parquet(f"{base}/rows/load={load}")
    counts = spark.read.parquet(f"{base}/rows/load={load}").groupBy(F.col("file").alias("path")).agg(F.count("*").alias("rows"))
    new = spark.createDataFrame(files, "path string, bytes long, modified timestamp")
    (new.join(counts, "path", "left")
     .select("path", "bytes", "modified", F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(load).alias("load"),
             F.current_timestamp().alias("loaded_at"))
     .coalesce(1).write.mode("append").parquet(f"{base}/ledger"))
    return len(files)


def latest_loads(spark: SparkSession, base: str) -> DataFrame:
    """path and load: the last load of each file."""
    last = Window.partitionBy("path").orderBy(F.col("load").desc())
    return (history(spark, base).withColumn("n", F.row_number().over(last)).filter("n = 1")
            .select(F.col("path").alias("file"), "load"))


def loaded(spark: SparkSession, base: str) -> DataFrame:
    """The warehouse rows as of the last load of each file, with ``file`` and ``load``."""
    of = bounded_broadcast(latest_loads(spark, base), LEDGER_BROADCAST_ROWS)
    return spark.read.parquet(f"{base}/rows").join(of, ["file", "load"], "left_semi")
