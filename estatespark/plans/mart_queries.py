"""Registered queries on the marts as a service: load history, versions, views by name, bucketed
tables, SQL functions, failing rows and the counts observed while writing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files as SF
from ..sources import fixture as FX
from ..sources import loads as L
from . import kpi as K
from . import layers as P
from . import marts as MT
from . import quality_suite as QS
from . import views as V
from .queries import CFG, landed_csv, register
from .star import build_star


@register("q_load_history")
def q_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed files loaded through the ledger, twice: the second load finds nothing to do."""
    base, root = scratch_path(spark, "loads"), landed_csv(spark, sf_dir)
    L.load_new(spark, root, base, CFG.year_in_path_pattern, FX.fixture_loaded_at())
    again = L.load_new(spark, root, base, CFG.year_in_path_pattern, FX.fixture_loaded_at())
    rows = L.loaded(spark, base).groupBy("source_year").agg(F.count(F.lit(1)).alias("rows"), F.sum("price").alias("price_total"))
    known = (L.history(spark, base).groupBy(SF.year_of("path", CFG.year_in_path_pattern).alias("source_year"))
             .agg(F.sum("rows").alias("ledger_rows"), F.max("load").alias("last_load")))
    return rows.join(known, rows["source_year"].eqNullSafe(known["source_year"])).select(
        rows["source_year"], "rows", "price_total", "ledger_rows", "last_load", F.lit(again).alias("loaded_again"))


@register("q_lake_files")
def q_lake_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed file with its size."""
    return SF.lake_inventory(spark, landed_csv(spark, sf_dir))


@register("q_mart_rebuild")
def q_mart_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts rebuilt beside their current version: yearly totals of the version switched to."""
    root = scratch_path(spark, "marts")
    st = P.star(spark, sf_dir, CFG)
    MT.published(spark, build_star(spark, P.flagged(spark, sf_dir, CFG).where("price >= 1000000"), CFG), root)
    MT.published(spark, st, root)
    now = MT.current(spark, root, CFG)
    last = MT.versions(spark, root).agg(F.max("version").alias("version")).scalar()
    return (now.fact.groupBy("sale_year").agg(F.count(F.lit(1)).alias("transactions"), F.sum("sale_price").alias("value"))
            .withColumn("version", last))


@register("q_dq_failing_rows")
def q_dq_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows that fail any of the declared tests."""
    rels, st = QS.relations(spark, sf_dir, CFG)
    return QS.failing_rows(rels, QS.layer_rows(rels, CFG), st)


@register("q_dq_observed")
def q_dq_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and NULLs of the marts, as counted while they were written."""
    return QS.observed_summary(P.star(spark, sf_dir, CFG))


def published_views(spark: SparkSession, sf_dir: str) -> str:
    """The database of the source's marts, published once per application."""
    def publish() -> str:
        raw = P.raw(spark, sf_dir)
        assert raw.columns
        return V.publish(spark, P.star(spark, sf_dir, CFG), FX.materialized_path(spark, sf_dir, "raw_sales"),
                         f"marts_{uuid.uuid4().hex[:12]}", scratch_path(spark, "views"))
    return FX.remember(spark, sf_dir, "views", publish)


# The published views, and the query here that reads each by name.
VIEWS = (
    ("q_view_staging", "v_stg_transactions"),
    ("q_view_price_trends", "v_borough_price_trends"),
    ("q_view_yoy_growth", "v_borough_yoy_growth"),
    ("q_view_velocity", "v_borough_transaction_velocity"),
    ("q_view_type_roi", "v_property_type_roi_by_borough"),
    ("q_view_undervalued", "v_undervalued_postcodes"),
    ("q_view_new_build", "v_new_build_premium"),
    ("q_view_tenure", "v_tenure_premium"),
    ("q_view_market", "v_market_health_summary"),
)


def _register_view(name: str, view: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(f"SELECT * FROM {published_views(spark, sf_dir)}.{view}")
    run.__name__, run.__doc__ = name, f"The published view {view}, read by name."
    register(name)(run)


for _name, _view in VIEWS:
    _register_view(_name, _view)


@register("q_bucketed_join")
def q_bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and value by borough and region, fact and locations joined by bucket."""
    db = f"buckets_{uuid.uuid4().hex[:12]}"
    hot = V.bucket_star(spark, P.star(spark, sf_dir, CFG), db, scratch_path(spark, "buckets"), 16)
    rows = V.bucketed_rows(spark, db, hot, ["sale_price"], ["borough", "london_region"], CFG)
    return rows.groupBy("borough", "london_region").agg(F.count(F.lit(1)).alias("transactions"), F.sum("sale_price").alias("value"))


@register("q_sql_surrogate_key")
def q_sql_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key macro called as a SQL function."""
    V.create_functions(spark)
    return spark.sql("""SELECT transaction_id, surrogate_key(array(postcode_district, borough)) AS location_key,
       surrogate_key(array(property_type_code)) AS property_key,
       surrogate_key(array(string(sale_date), postcode_district)) AS date_district_key FROM {enriched}""",
                     enriched=P.enriched(spark, sf_dir, CFG))


@register("q_sql_date_spine")
def q_sql_date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar macro called as a SQL table function, over the days of the dated sales."""
    V.create_functions(spark)
    return spark.sql("""SELECT s.date_day FROM (SELECT min(sale_date) AS first_day, date_add(max(sale_date), 1) AS end_day FROM {stg}) b,
       LATERAL date_spine(b.first_day, b.end_day) s""", stg=P.stg(spark, sf_dir))


@register("q_calendar_slice")
def q_calendar_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekend sales of two quarters by borough; the calendar's filter prunes the fact's years."""
    days = F.col("year_quarter").isin(f"{CFG.last_year}-Q1", f"{CFG.last_year}-Q2") & F.col("is_weekend")
    return V.calendar_slice(P.star(spark, sf_dir, CFG), days)


# The extracts that a dashboard reads.
EXTRACTS = (
    ("v_borough_price_trends", K.borough_price_trends),
    ("v_borough_yoy_growth", K.yoy_growth),
    ("v_borough_transaction_velocity", K.transaction_velocity),
    ("v_property_type_roi_by_borough", K.property_type_roi),
    ("v_undervalued_postcodes", K.undervalued_postcodes),
    ("v_new_build_premium", K.new_build_premium),
    ("v_market_health_summary", K.market_health),
    ("dim_location", lambda st: st.dim_location),
    ("dim_property", lambda st: st.dim_property),
)


@register("q_export_extracts")
def q_export_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine relations exported as headed CSV and read back: rows of each, and those with a borough or type."""
    st = P.star(spark, sf_dir, CFG)
    out, parts = scratch_path(spark, "extracts"), []
    for name, build in EXTRACTS:
        df = build(st)
        SF.export_csv(df, f"{out}/{name}")
        first = df.columns[0].upper()
        parts.append(SF.read_export(spark, f"{out}/{name}", df).agg(
            F.lit(name).alias("extract"), F.count(F.lit(1)).alias("rows"), F.count_distinct(first).cast("long").alias("first_column_values")))
    return QS.union_all(parts)
