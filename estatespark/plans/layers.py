"""End-to-end wiring over the test tables: warehouse raw -> models -> materialised star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import FIXTURE, Config
from ..sources import fixture as FX
from . import models as M
from .star import Star, build_star, materialize_star


# Layer frames are memoised per application, source and parameters. A DataFrame is an
# immutable plan over immutable written tables, so reusing the object only saves re-listing
# files and re-analysing the chain; it caches no data.


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.remember(spark, sf_dir, "raw_df", lambda: FX.warehouse_raw(spark, sf_dir))


def seed_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """The borough seed loaded once per application (a seed table) with its row count,
    which later lookups use as the broadcast size check."""
    def load():
        path = FX.materialized_path(spark, sf_dir, "seed_boroughs")
        FX.borough_seed(spark, sf_dir).write.mode("overwrite").parquet(path)
        return path, spark.read.parquet(path).count()
    def frame():
        path, rows = FX.remember(spark, sf_dir, "seed", load)
        return spark.read.parquet(path), rows
    return FX.remember(spark, sf_dir, "seed_df", frame)


def seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_table(spark, sf_dir)[0]


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.remember(spark, sf_dir, "stg_df", lambda: M.stg_transactions(raw(spark, sf_dir)))


def boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.remember(spark, sf_dir, "boroughs_df",
                       lambda: M.stg_boroughs(seed_table(spark, sf_dir)[0]))


def enriched(spark: SparkSession, sf_dir: str, cfg: Config = FIXTURE) -> DataFrame:
    def build():
        rows = seed_table(spark, sf_dir)[1]
        return M.enriched(stg(spark, sf_dir), boroughs(spark, sf_dir), cfg, rows)
    return FX.remember(spark, sf_dir, ("enriched_df", cfg), build)


def priced(spark: SparkSession, sf_dir: str, cfg: Config = FIXTURE) -> DataFrame:
    return FX.remember(spark, sf_dir, ("priced_df", cfg),
                       lambda: M.priced(enriched(spark, sf_dir, cfg), cfg))


def flagged(spark: SparkSession, sf_dir: str, cfg: Config = FIXTURE) -> DataFrame:
    return FX.remember(spark, sf_dir, ("flagged_df", cfg),
                       lambda: M.flagged(priced(spark, sf_dir, cfg), cfg, stg(spark, sf_dir)))


def lazy_star(spark: SparkSession, sf_dir: str, cfg: Config = FIXTURE) -> Star:
    return build_star(spark, flagged(spark, sf_dir, cfg), cfg)


def star(spark: SparkSession, sf_dir: str, cfg: Config = FIXTURE) -> Star:
    """The star written once per application and source (drop-and-rebuild marts)."""
    def build() -> Star:
        root = FX.materialized_path(spark, sf_dir, f"star_{abs(hash(cfg)):x}")
        # every mart reads the raw table's columns that it needs; the chain between is narrow
        return materialize_star(spark, lazy_star(spark, sf_dir, cfg), root)
    return FX.remember(spark, sf_dir, ("star", cfg), build)
