"""Staging and intermediate models: raw sales -> typed, decoded, enriched, banded, flagged.

Each model is a function DataFrame -> DataFrame built from one ``select`` (input columns are
read before any alias shadows them, so the staging filter tests the raw date text). All of
it is narrow: the only non-map step is the lookup join, a broadcast of the bounded seed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..functions import (bucketize, code_map, flag, flag_in, postcode_area, postcode_district,
                         tri_state, try_date, upper_trim)
from ..functions.dates import month_start, quarter_start
from ..operators.joins import lookup_join

STG_COLUMNS = [
    "transaction_id", "price", "sale_date", "postcode", "property_type_code", "property_type",
    "new_build_flag", "is_new_build", "tenure_code", "tenure", "town", "district", "county",
    "ppd_type_code", "ppd_type", "source_year", "loaded_at", "sale_year", "sale_month",
    "sale_quarter", "sale_month_start", "sale_quarter_start", "postcode_area",
    "postcode_district",
]

ENRICHED_COLUMNS = [
    "transaction_id", "price", "sale_date", "sale_year", "sale_month", "sale_quarter",
    "sale_month_start", "sale_quarter_start", "postcode", "postcode_area", "postcode_district",
    "borough", "town", "source_district", "county", "property_type", "property_type_code",
    "is_new_build", "new_build_flag", "tenure", "tenure_code", "ppd_type", "ppd_type_code",
    "source_year", "loaded_at",
]

FLAG_COLUMNS = [
    "is_central_london", "is_prime_postcode_area", "is_million_plus", "is_super_prime",
    "is_most_recent_year", "is_flat", "is_leasehold",
]


def is_staged() -> F.Column:
    """Which raw rows staging keeps."""
    return F.coalesce((F.col("price") > 0) & F.col("postcode").isNotNull() & F.col("sale_date").isNotNull(),
                      F.lit(False))


def stg_transactions(raw: DataFrame) -> DataFrame:
    """Drop zero prices and missing postcodes / date text, decode codes, derive date parts
    and postcode parts. The raw date text is tested for NULL, so unparseable dates survive
    as a NULL ``sale_date`` (caught by the not-null check, dropped by the date join)."""
    return staged_columns(raw.where((F.col("price") > 0) & F.col("postcode").isNotNull()
                                    & F.col("sale_date").isNotNull()))


def staged_columns(kept: DataFrame, *extra: F.Column) -> DataFrame:
    """The staging columns of raw rows, and any extra ones."""
    sale_date = try_date("sale_date")
    postcode = upper_trim("postcode")
    typed = kept.select(
        "transaction_id",
        "price",
        sale_date.alias("sale_date"),
        postcode.alias("postcode"),
        F.col("property_type").alias("property_type_code"),
        code_map("property_type", C.PROPERTY_TYPES, C.UNKNOWN_LABEL).alias("property_type"),
        F.col("new_build").alias("new_build_flag"),
        tri_state("new_build", C.NEW_BUILD).alias("is_new_build"),
        F.col("tenure").alias("tenure_code"),
        code_map("tenure", C.TENURES, C.UNKNOWN_LABEL).alias("tenure"),
        upper_trim("town").alias("town"),
        upper_trim("district").alias("district"),
        upper_trim("county").alias("county"),
        F.col("ppd_type").alias("ppd_type_code"),
        code_map("ppd_type", C.PPD_TYPES, C.UNKNOWN_LABEL).alias("ppd_type"),
        "source_year",
        "loaded_at",
        *extra,
    )
    return typed.select(
        "*",
        F.year("sale_date").alias("sale_year"),
        F.month("sale_date").alias("sale_month"),
        F.quarter("sale_date").alias("sale_quarter"),
        month_start("sale_date").alias("sale_month_start"),
        quarter_start("sale_date").alias("sale_quarter_start"),
        postcode_area("postcode").alias("postcode_area"),
        postcode_district("postcode").alias("postcode_district"),
    )


def stg_boroughs(seed: DataFrame) -> DataFrame:
    return seed.select(upper_trim("postcode_district").alias("postcode_district"),
                       F.trim("borough").alias("borough"))


def enriched(stg: DataFrame, boroughs: DataFrame, cfg: Config,
             lookup_rows: int | None = None) -> DataFrame:
    """Left lookup of the borough by postcode district; misses get 'Unmatched', no row lost.

    The lookup is broadcast when it is within ``cfg.broadcast_max_rows`` (``lookup_rows``
    when known, else a bounded probe), otherwise joined by shuffle."""
    joined = lookup_join(stg, boroughs, "postcode_district", cfg.broadcast_max_rows, lookup_rows)
    return joined.select(
        *[(F.coalesce(F.col("borough"), F.lit(C.UNMATCHED_BOROUGH)).alias("borough")
           if c == "borough" else
           F.col("district").alias("source_district") if c == "source_district" else F.col(c))
          for c in ENRICHED_COLUMNS])


def priced(enr: DataFrame, cfg: Config) -> DataFrame:
    return enr.select(
        "*",
        bucketize("price", cfg.price_bands, cfg.top_price_band).alias("price_band"),
        bucketize("price", cfg.market_segments, cfg.top_market_segment).alias("market_segment"),
    )


def flagged(pr: DataFrame, cfg: Config, years_from: DataFrame | None = None) -> DataFrame:
    """Boolean flags, never NULL. The most recent year is an uncorrelated scalar subquery
    (one aggregate over the pruned ``sale_year`` column, evaluated once). ``years_from`` may
    name an upstream relation with the same rows and years (the staged sales: the lookup
    join keeps every row), which spares the subquery the lookup join."""
    latest = (years_from if years_from is not None else pr).agg(F.max("sale_year")).scalar()
    return pr.select(
        "*",
        flag_in("borough", cfg.central_boroughs).alias("is_central_london"),
        flag_in("postcode_area", cfg.prime_areas).alias("is_prime_postcode_area"),
        flag(F.col("price") >= F.lit(cfg.million_plus)).alias("is_million_plus"),
        flag(F.col("price") >= F.lit(cfg.super_prime)).alias("is_super_prime"),
        flag(F.col("sale_year") == latest).alias("is_most_recent_year"),
        flag(F.col("property_type") == F.lit("Flat")).alias("is_flat"),
        flag(F.col("tenure") == F.lit("Leasehold")).alias("is_leasehold"),
    )


def flagged_from_raw(raw: DataFrame, seed: DataFrame, cfg: Config,
                     seed_rows: int | None = None) -> DataFrame:
    return flagged(priced(enriched(stg_transactions(raw), stg_boroughs(seed), cfg, seed_rows), cfg), cfg)
