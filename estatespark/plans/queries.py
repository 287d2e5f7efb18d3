"""One query per operator family of the inventory, over the test tables at ``sf_dir``.

Each query runs the library on the whole derived sales relation (no sampling, no caps);
models and KPIs read the warehouse raw table and star written once per application.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE
from ..functions import pct_change, surrogate_key, try_date
from ..operators.aggregates import conditional_pivot, price_stats
from ..operators.median import N, stats_with_median, value_counts
from ..operators.spine import date_spine
from ..operators.windows import rank_within, tile_within, with_previous
from ..session import scratch_path
from ..sources import files as SF
from ..sources import fixture as FX
from ..streaming.ingest import ingest_available
from . import ingest as I
from . import kpi as K
from . import layers as P
from . import models as M
from . import quality_suite as QS
from . import report as R
from .star import dim_date_for

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


CFG = FIXTURE

# ---------------------------------------------------------------- single-operator queries


@register("q_string_funcs")
def q_string_funcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPPER/TRIM, LEFT, first regex match, SPLIT_PART on every staged sale."""
    s = P.stg(spark, sf_dir)
    return s.select("transaction_id", "postcode", "postcode_area", "postcode_district", "town",
                    "district", "county")


@register("q_try_date")
def q_try_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient parse of the raw date text: NULL on failure, never an error."""
    r = P.raw(spark, sf_dir)
    return r.select("transaction_id", F.col("sale_date").alias("sale_date_text"),
                    try_date("sale_date").alias("sale_date"))


@register("q_date_funcs")
def q_date_funcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = P.stg(spark, sf_dir)
    return s.select("transaction_id", "sale_date", "sale_year", "sale_month", "sale_quarter",
                    "sale_month_start", "sale_quarter_start")


@register("q_code_mapping")
def q_code_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = P.stg(spark, sf_dir)
    return s.select("transaction_id", "property_type_code", "property_type", "new_build_flag",
                    "is_new_build", "tenure_code", "tenure", "ppd_type_code", "ppd_type")


@register("q_price_bands")
def q_price_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.priced(spark, sf_dir, CFG)


@register("q_flags")
def q_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.flagged(spark, sf_dir, CFG)


@register("q_most_recent_year")
def q_most_recent_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = P.flagged(spark, sf_dir, CFG)
    return f.groupBy("sale_year", "is_most_recent_year").agg(F.count(F.lit(1)).alias("sales"))


@register("q_pct_change")
def q_pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent change with a NULL-on-zero divisor, on yearly staged volumes and values."""
    s = P.stg(spark, sf_dir)
    yearly = s.groupBy("sale_year").agg(F.count(F.lit(1)).alias("sales"),
                                        F.sum("price").alias("value"))
    lagged = with_previous(yearly, [], [F.col("sale_year").asc_nulls_last()], [("sales", "prev_sales"),
                                                        ("value", "prev_value")])
    return lagged.select(
        "sale_year", "sales", "prev_sales",
        pct_change("sales", "prev_sales", 2).alias("sales_change_pct"),
        pct_change("value", "prev_value", 1).alias("value_change_pct"),
        pct_change("sales", F.lit(0), 2).alias("change_vs_zero_pct"))


@register("q_surrogate_key")
def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD5 keys, including parts that are NULL (placeholder text)."""
    e = P.enriched(spark, sf_dir, CFG)
    return e.select("transaction_id",
                    surrogate_key("postcode_district", "borough").alias("location_key"),
                    surrogate_key("property_type_code").alias("property_key"),
                    surrogate_key("sale_date", "postcode_district").alias("date_district_key"))


@register("q_date_spine")
def q_date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last dated sale (end exclusive of the day after)."""
    s = P.stg(spark, sf_dir)
    return date_spine(spark, F.min("sale_date"), F.date_add(F.max("sale_date"), 1), source=s)


# ---------------------------------------------------------------- layers


@register("q_stg_transactions")
def q_stg_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.stg(spark, sf_dir)


@register("q_enriched")
def q_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.enriched(spark, sf_dir, CFG)


@register("q_dim_date")
def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar dimension over whole years of the dated sales."""
    return dim_date_for(P.stg(spark, sf_dir), "sale_date")


@register("q_dim_location")
def q_dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.star(spark, sf_dir, CFG).dim_location


@register("q_dim_property")
def q_dim_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.star(spark, sf_dir, CFG).dim_property


@register("q_fact_transactions")
def q_fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.star(spark, sf_dir, CFG).fact


@register("q_star_join")
def q_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact joined to all three dimensions (inner: sales outside the calendar vanish)."""
    st = P.star(spark, sf_dir, CFG)
    rows = K.star_rows(st, ["transaction_key", "sale_price"], ["borough", "london_region"],
                       ["year", "quarter"], ["property_type_name", "property_category"])
    return rows.select("transaction_key", "borough", "london_region", "year", "quarter",
                       "property_type_name", "property_category", "sale_price")


# ---------------------------------------------------------------- aggregates and windows


@register("q_group_stats")
def q_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, mean, exact median, min, max per (region, property type)."""
    st = P.star(spark, sf_dir, CFG)
    rows = K.star_rows(st, ["sale_price"], ["london_region"], ["year"], ["property_type_name"])
    keys = ["london_region", "property_type_name"]
    return stats_with_median(value_counts(rows, keys, "sale_price"), keys, "sale_price", price_stats(
        which=("transactions", "avg_price", "min_price", "max_price")), "median_price")


@register("q_having_min_count")
def q_having_min_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.postcode_stats(P.star(spark, sf_dir, CFG))


@register("q_pivot_segments")
def q_pivot_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per borough: tenure segments pivoted to columns, absent segment = 0."""
    st = P.star(spark, sf_dir, CFG)
    rows = K.star_rows(st, ["sale_price", "tenure_label"], ["borough"]).where(
        F.col("tenure_label").isin("Freehold", "Leasehold"))
    keys = ["borough", "tenure_label"]
    per = stats_with_median(value_counts(rows, keys, "sale_price"), keys, "sale_price",
                            [F.sum(N).alias("transactions")], "median_price")
    return conditional_pivot(per, ["borough"], "tenure_label",
                             [("Freehold", "freehold"), ("Leasehold", "leasehold")],
                             [("transactions", "_txns"), ("median_price", "_median")])


@register("q_rank")
def q_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    act = K.borough_activity(P.star(spark, sf_dir, CFG))
    return act.select("*", rank_within(["year"], [F.col("transactions").desc()]).alias("volume_rank"))


@register("q_ntile")
def q_ntile(spark: SparkSession, sf_dir: str) -> DataFrame:
    act = K.borough_activity(P.star(spark, sf_dir, CFG))
    order = [F.col("transactions").desc(), F.col("borough"), F.col("london_region")]
    return act.select("*", tile_within(4, ["year"], order).alias("liquidity_quartile"))


# ---------------------------------------------------------------- KPI views


@register("q_borough_price_trends")
def q_borough_price_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.borough_price_trends(P.star(spark, sf_dir, CFG))


@register("q_yoy_growth")
def q_yoy_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.yoy_growth(P.star(spark, sf_dir, CFG))


@register("q_yoy_growth_by_region")
def q_yoy_growth_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.yoy_growth(P.star(spark, sf_dir, CFG), lag_keys=("borough", "london_region"))


@register("q_transaction_velocity")
def q_transaction_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.transaction_velocity(P.star(spark, sf_dir, CFG))


@register("q_property_type_roi")
def q_property_type_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.property_type_roi(P.star(spark, sf_dir, CFG))


@register("q_undervalued_postcodes")
def q_undervalued_postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.undervalued_postcodes(P.star(spark, sf_dir, CFG))


@register("q_new_build_premium")
def q_new_build_premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.new_build_premium(P.star(spark, sf_dir, CFG))


@register("q_tenure_premium")
def q_tenure_premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.tenure_premium(P.star(spark, sf_dir, CFG))


@register("q_market_health")
def q_market_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.market_health(P.star(spark, sf_dir, CFG))


# ---------------------------------------------------------------- data quality


@register("q_dq_unique")
def q_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    rels, _ = QS.relations(spark, sf_dir, CFG)
    return QS.unique_summary(rels, QS.layer_rows(rels, CFG))


@register("q_dq_not_null")
def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rels, _ = QS.relations(spark, sf_dir, CFG)
    return QS.not_null_summary(rels, QS.layer_rows(rels, CFG))


@register("q_dq_accepted_values")
def q_dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rels, _ = QS.relations(spark, sf_dir, CFG)
    return QS.accepted_values_summary(rels, QS.layer_rows(rels, CFG))


@register("q_dq_relationships")
def q_dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    rels, st = QS.relations(spark, sf_dir, CFG)
    return QS.relationships_summary(rels, st)


@register("q_dq_orphans")
def q_dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing rows of the date relationship: fact rows whose day has no calendar row."""
    from ..operators.quality import relationship_failures
    st = P.star(spark, sf_dir, CFG)
    return relationship_failures(st.fact.select("transaction_key", "date_key", "sale_year"),
                                 "date_key", st.dim_date, "date_key",
                                 CFG.broadcast_max_rows, st.date_rows)


@register("q_dq_row_counts")
def q_dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rels, _ = QS.relations(spark, sf_dir, CFG)
    return QS.row_counts(rels, QS.layer_rows(rels, CFG))


@register("q_dq_coverage")
def q_dq_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QS.coverage(P.enriched(spark, sf_dir, CFG))


# ---------------------------------------------------------------- ingestion, sources, sinks


def landed_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw rows landed once per application as headerless yearly CSV (``pp=YYYY/``)."""
    def land() -> str:
        root = FX.materialized_path(spark, sf_dir, "landing/csv")
        raw = P.raw(spark, sf_dir).withColumnRenamed("sale_date", "date") \
            .select(*SF.RAW_COLUMNS, "source_year")
        return SF.write_yearly_csv(raw, root)
    return FX.remember(spark, sf_dir, "landed_csv", land)


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SF.read_yearly_csv(spark, f"{landed_csv(spark, sf_dir)}/pp=*", CFG.year_in_path_pattern)


@register("q_ingest_csv")
def q_ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless yearly files read with imposed names; year tagged from the file path."""
    return ingested(spark, sf_dir)


@register("q_ingest_filter")
def q_ingest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.filter_areas(ingested(spark, sf_dir), CFG)


@register("q_union_years")
def q_union_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separately read batches of yearly files (even years, odd years, no year) unioned."""
    rows = ingested(spark, sf_dir)
    odd = F.col("source_year") % F.lit(2) == F.lit(1)
    batches = [rows.where(~odd), rows.where(odd), rows.where(F.col("source_year").isNull())]
    return I.rows_per_year(I.filter_areas(I.union_years(batches), CFG))


@register("q_value_counts")
def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.frequency_tables(I.filter_areas(ingested(spark, sf_dir), CFG),
                              ["property_type", "source_year"])


@register("q_top_areas")
def q_top_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.top_areas(I.filter_areas(ingested(spark, sf_dir), CFG), 10)


@register("q_profile_summary")
def q_profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.profile_summary(I.filter_areas(ingested(spark, sf_dir), CFG))


@register("q_bronze_land")
def q_bronze_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows landed untouched (all text, unfiltered) as year-partitioned Parquet."""
    out = scratch_path(spark, "bronze")
    SF.land_bronze(spark, f"{landed_csv(spark, sf_dir)}/pp=*", out, CFG.year_in_path_pattern)
    return SF.read_partitioned(spark, out, [*SF.RAW_COLUMNS, "source_year"])


@register("q_silver_roundtrip")
def q_silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered typed rows -> Snappy Parquet by year -> warehouse shape."""
    out = scratch_path(spark, "silver")
    SF.write_silver(I.filter_areas(ingested(spark, sf_dir), CFG), out)
    silver = SF.read_partitioned(spark, out, [*SF.RAW_COLUMNS, "source_year"])
    return SF.to_warehouse(silver, FX.fixture_loaded_at())


@register("q_lake_inventory")
def q_lake_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of the landed raw files per year and in all (listing only, no file body read)."""
    return SF.lake_totals(spark, landed_csv(spark, sf_dir), CFG.year_in_path_pattern)


@register("q_malformed_rows")
def q_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines per year, and those that do not fit the schema."""
    return SF.malformed_rows(spark, f"{landed_csv(spark, sf_dir)}/pp=*", CFG.year_in_path_pattern)


@register("q_export_csv")
def q_export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market summary exported as headed CSV with upper-case names, read back typed."""
    mh = K.market_health(P.star(spark, sf_dir, CFG))
    out = scratch_path(spark, "export")
    SF.export_csv(mh, out)
    return SF.read_export(spark, out, mh)


@register("q_stg_boroughs")
def q_stg_boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed written as a headed CSV, loaded with declared types, then normalised."""
    path = scratch_path(spark, "seed")
    SF.write_seed(P.seed(spark, sf_dir), path)
    return M.stg_boroughs(SF.read_seed(spark, path))


@register("q_ingest_stream")
def q_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed files ingested by the streaming job (availableNow) into a silver table."""
    base = scratch_path(spark, "stream")
    ingest_available(spark, landed_csv(spark, sf_dir), f"{base}/silver", f"{base}/_checkpoint", CFG)
    return SF.read_partitioned(spark, f"{base}/silver", [*SF.RAW_COLUMNS, "source_year"],
                               schema=SF.RAW_YEAR_SCHEMA)


# ---------------------------------------------------------------- report results


@register("q_value_position_counts")
def q_value_position_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.value_position_counts(P.star(spark, sf_dir, CFG))


@register("q_borough_growth_ranking")
def q_borough_growth_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.borough_growth_ranking(K.yoy_table(K.yearly_borough_prices(P.star(spark, sf_dir, CFG))))


@register("q_top_liquidity")
def q_top_liquidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_liquidity(K.borough_activity(P.star(spark, sf_dir, CFG)), CFG.top_liquidity_k)


@register("q_investment_matrix")
def q_investment_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    yearly = K.yearly_borough_prices(P.star(spark, sf_dir, CFG))  # holds the transactions too
    return R.investment_matrix(K.yoy_table(yearly), yearly)


@register("q_type_consistency")
def q_type_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.type_consistency(K.roi_table(P.star(spark, sf_dir, CFG)))


@register("q_growth_spread")
def q_growth_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.growth_spread_of(P.star(spark, sf_dir, CFG))
