"""File sources and sinks: yearly headerless CSV, seed CSV, bronze/silver Parquet, warehouse
load, lake inventory and CSV export.

Every reader declares its schema (no inference pass over the data) and every writer is a
single distributed write; nothing is concatenated on the driver, which holds file listings only.

CSV follows RFC 4180: a quote inside a quoted field is doubled, and a backslash is an ordinary
character. Fields with line breaks need ``multi_line=True``, which reads each file in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the yearly raw files, in file order (the files carry no header).
RAW_COLUMNS = (
    "transaction_id", "price", "date", "postcode", "property_type", "new_build", "tenure",
    "paon", "saon", "street", "locality", "town", "district", "county", "ppd_type",
    "record_status",
)

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c == "price" else T.StringType(), True) for c in RAW_COLUMNS]
)
RAW_YEAR_SCHEMA = T.StructType(RAW_SCHEMA.fields + [T.StructField("source_year", T.IntegerType(), True)])
RAW_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

SEED_SCHEMA = T.StructType([
    T.StructField("postcode_district", T.StringType(), True),
    T.StructField("borough", T.StringType(), True),
])

# Whitespace is data here (padded postcodes are trimmed later, by the staging model), so the
# CSV writer must not strip it.
CSV_OPTIONS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "quote": '"', "escape": '"'}
CORRUPT = "_corrupt_record"


def year_from_path(pattern: str) -> Column:
    """Year tagged from the source file: ``pp-2021.csv``, or the ``pp=2021`` folder around it.

    Only the file's name and the folder it lies in count, the name first.
    """
    return year_of("_metadata.file_path", pattern)


def year_of(path: str, pattern: str) -> Column:
    """The year in a column of file paths."""
    parts = F.split(F.col(path), "/")
    name, folder = F.element_at(parts, -1), F.try_element_at(parts, F.lit(-2))
    found = lambda x: F.nullif(F.regexp_extract(x, "^" + pattern, 1), F.lit(""))
    return F.coalesce(found(name), found(folder)).cast("int")


def read_yearly_csv(spark: SparkSession, paths: str | list[str], year_pattern: str,
                    schema: T.StructType = RAW_SCHEMA, multi_line: bool = False,
                    corrupt: bool = False) -> DataFrame:
    """Headerless yearly files with imposed names; each row tagged with its file's year.

    One multi-path scan: files are split into partitions by
    ``spark.sql.files.maxPartitionBytes``, so memory stays bounded whatever the file size.
    Empty fields read as NULL. A malformed price becomes NULL (and is dropped by staging);
    with ``corrupt`` the whole line of such a row, and of one with too few or too many fields,
    stands in ``_corrupt_record``.
    """
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)]) if corrupt else schema
    reader = (spark.read.schema(full)
              .option("header", "false")
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("multiLine", str(multi_line).lower())
              .option("columnPruning", str(not corrupt).lower())  # a line is judged by all its fields
              .options(**CSV_OPTIONS))
    df = reader.csv(paths)
    return df.select(*[F.col(c) for c in full.fieldNames()],
                     year_from_path(year_pattern).alias("source_year"))


def malformed_rows(spark: SparkSession, paths: str | list[str], year_pattern: str) -> DataFrame:
    """Lines per year, those with a price, and those that do not fit the schema (bad price,
    wrong number of fields)."""
    rows = read_yearly_csv(spark, paths, year_pattern, corrupt=True)
    return rows.groupBy("source_year").agg(
        F.count(F.lit(1)).alias("rows"), F.count("price").alias("priced"), F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed"))


def write_yearly_csv(df: DataFrame, root: str, year_col: str = "source_year") -> str:
    """Land raw rows as headerless CSV, one folder per year (``root/pp=YYYY/``)."""
    (df.withColumn("pp", F.col(year_col)).drop(year_col)
       .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("pp")
       .options(**CSV_OPTIONS).option("header", "false")
       .csv(root))
    return root


def read_seed(spark: SparkSession, path: str, schema: T.StructType = SEED_SCHEMA) -> DataFrame:
    """Headed seed CSV with declared column types."""
    return (spark.read.schema(schema).option("header", "true")
            .options(**CSV_OPTIONS).csv(path))


def write_seed(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("header", "true").options(**CSV_OPTIONS).csv(path)
    return path


def land_bronze(spark: SparkSession, csv_paths: str | list[str], out: str,
                year_pattern: str) -> str:
    """Bronze: the untouched raw rows, every field as text, no filter, partitioned by year."""
    raw = read_yearly_csv(spark, csv_paths, year_pattern, schema=RAW_TEXT_SCHEMA)
    raw.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("source_year").parquet(out)
    return out


def write_silver(df: DataFrame, out: str) -> str:
    """Silver: typed, filtered rows as Snappy Parquet partitioned by source year."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy")
       .partitionBy("source_year").parquet(out))
    return out


def read_partitioned(spark: SparkSession, path: str, columns: list[str],
                     schema: T.StructType | None = None) -> DataFrame:
    """Read a year-partitioned table back with its original column order."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).select(*columns)


def to_warehouse(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Warehouse load: ``date`` becomes ``sale_date`` and a load timestamp is added."""
    stamp = loaded_at if loaded_at is not None else F.current_timestamp()
    return df.withColumnRenamed("date", "sale_date").withColumn("loaded_at", stamp)


def lake_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files under a prefix with their size, plus the total in MB, as a table query.

    ``binaryFile`` lists the files in parallel; selecting only path and length prunes the
    content column, so no file body is read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select(F.col("path"), F.col("length").alias("size_bytes")))
    return files.select(
        "path", "size_bytes",
        F.round(F.col("size_bytes") / F.lit(1024.0 * 1024.0), 3).alias("size_mb"),
    )


def lake_totals(spark: SparkSession, root: str, year_pattern: str) -> DataFrame:
    """Bytes and MB per year, and of all files (year NULL, ``is_total``), in one listing."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select(year_from_path(year_pattern).alias("source_year"), F.col("length").alias("size_bytes")))
    return (files.rollup("source_year").agg(F.sum("size_bytes").alias("size_bytes"),
                                            (F.grouping("source_year") == 1).alias("is_total"))
            .select("source_year", "is_total", "size_bytes",
                    F.round(F.col("size_bytes") / F.lit(1024.0 * 1024.0), 3).alias("size_mb")))


def export_csv(df: DataFrame, out: str) -> str:
    """Headed CSV with upper-case column names, as a dashboard extract.

    Written with as many files as the (already small) result has partitions; extracts of
    aggregated views are tiny, so no single-task funnel is forced.
    """
    df.toDF(*[c.upper() for c in df.columns]).write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .option("header", "true").options(**CSV_OPTIONS).csv(out)
    return out


def read_export(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read an extract back with the upper-cased schema of the frame it came from."""
    schema = T.StructType([T.StructField(f.name.upper(), f.dataType, True)
                           for f in like.schema.fields])
    return spark.read.schema(schema).option("header", "true").options(**CSV_OPTIONS).csv(path)
