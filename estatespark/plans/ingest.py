"""Ingestion steps over raw yearly rows: area filter, union of batches, profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import postcode_area
from ..operators.aggregates import top_k, value_counts
from ..operators.quality import union_all


def filter_areas(df: DataFrame, cfg: Config) -> DataFrame:
    """Keep rows whose postcode starts with one of the configured areas.

    Case-sensitive and untrimmed on purpose: a padded lower-case postcode is not a match
    here. Pipelined with the scan (no materialised intermediate), so memory stays bounded.
    """
    with_area = df.dropna(subset=["postcode"]).withColumn("__area", postcode_area("postcode"))
    return with_area.where(F.col("__area").isin(list(cfg.areas))).drop("__area")


def union_years(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union of yearly (or chunk) frames by column name."""
    return union_all(list(frames))


def rows_per_year(df: DataFrame) -> DataFrame:
    return df.groupBy("source_year").agg(F.count(F.lit(1)).alias("rows"))


def frequency_tables(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts of several columns in one long table (column_name, value, n), in one scan,
    by column and descending count."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("column_name", F.col("n").desc(), "value"))


def top_areas(df: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent postcode areas (top-k is the feature; ties broken by area)."""
    counts = value_counts(df.select(postcode_area("postcode").alias("postcode_area")),
                          "postcode_area")
    return top_k(counts, k, [F.col("n").desc(), F.col("postcode_area").asc_nulls_last()])


def profile_summary(df: DataFrame) -> DataFrame:
    """Rows, first/last date text and price range of the ingested rows (one aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.min("date").alias("min_date"), F.max("date").alias("max_date"),
                  F.min("price").alias("min_price"), F.max("price").alias("max_price"))
