"""Report-level results built on the KPI views.

The inputs are aggregated tables (one row per borough, region and year), so the "latest
year" and the median cut-offs are unpartitioned windows over those few rows. They are not
scalar subqueries, which would plan the whole KPI (fact scan, joins, aggregation) a second
time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import rounded_mean
from ..operators.median import N, stats_with_median
from . import kpi as K
from .star import Star



def _all() -> Window:
    """The whole (small, aggregated) input as one window."""
    return Window.partitionBy()


def latest_rows(df: DataFrame, year_col: str = "year") -> DataFrame:
    """Rows of the latest year of a small aggregated table."""
    return (df.select("*", F.max(year_col).over(_all()).alias("__latest"))
            .where(F.col(year_col) == F.col("__latest")).drop("__latest"))


def value_position_counts(star: Star) -> DataFrame:
    """How many qualifying districts fall in each value position."""
    return K.undervalued_table(star).groupBy("value_position").agg(
        F.count(F.lit(1)).alias("postcodes"))


def borough_growth(yoy: DataFrame) -> DataFrame:
    """Latest-year growth per borough: the unweighted mean over its region rows of the
    median YoY change (exact, half away from zero), and the mean median price."""
    return latest_rows(yoy).groupBy("borough", "year").agg(
        rounded_mean("yoy_median_change_pct", 2).alias("yoy_growth_pct"),
        F.round(F.avg("median_price"), 0).alias("median_price"))


def borough_growth_ranking(yoy: DataFrame) -> DataFrame:
    """Every borough ranked by latest-year growth (ties share a rank)."""
    rank = F.rank().over(Window.orderBy(F.col("yoy_growth_pct").desc_nulls_last()))
    return borough_growth(yoy).select("*", rank.alias("growth_rank"))


def borough_liquidity(velocity: DataFrame) -> DataFrame:
    """Latest-year sales per borough (region rows summed)."""
    return latest_rows(velocity).groupBy("borough").agg(
        F.sum("transactions").alias("transactions"))


def top_liquidity(velocity: DataFrame, k: int) -> DataFrame:
    """The k most liquid boroughs of the latest year (top-k is the feature)."""
    return borough_liquidity(velocity).orderBy(F.col("transactions").desc(), "borough").limit(k)


def investment_matrix(yoy: DataFrame, velocity: DataFrame) -> DataFrame:
    """Growth x liquidity quadrants, cut at the median of each axis over all boroughs."""
    g = borough_growth(yoy).select("borough", "yoy_growth_pct", "median_price")
    both = g.join(borough_liquidity(velocity), "borough")
    cuts = both.select("*", F.median("yoy_growth_pct").over(_all()).alias("__g"),
                       F.median("transactions").over(_all()).alias("__l"))
    hi_g = F.col("yoy_growth_pct") > F.col("__g")
    hi_l = F.col("transactions") > F.col("__l")
    labels = dict(C.QUADRANT_LABELS)
    quadrant = (F.when(hi_g & hi_l, F.lit(labels["high_growth_high_volume"]))
                .when(hi_g, F.lit(labels["high_growth_low_volume"]))
                .when(hi_l, F.lit(labels["low_growth_high_volume"]))
                .otherwise(F.lit(labels["low_growth_low_volume"])))
    return cuts.select("borough", "yoy_growth_pct", "median_price", "transactions",
                       quadrant.alias("quadrant"))


def type_consistency(roi: DataFrame) -> DataFrame:
    """Per property type: boroughs rated, how many grew, share positive and the range."""
    g = F.col("four_year_growth_pct")
    agg = roi.groupBy("property_type_name").agg(
        F.count(F.lit(1)).alias("boroughs"),
        F.count(g).alias("rated"),
        F.count_if(g > 0).alias("positive"),
        F.min(g).alias("min_growth_pct"),
        F.max(g).alias("max_growth_pct"))
    return agg.select("*", F.round(F.col("positive").cast("double")
                                   / F.nullif(F.col("rated"), F.lit(0)).cast("double"), 3)
                      .alias("share_positive"))


def growth_spread(yoy: DataFrame, market: DataFrame) -> DataFrame:
    """Best borough growth minus the market's median-price change, in the latest year."""
    best = borough_growth(yoy).groupBy("year").agg(
        F.max("yoy_growth_pct").alias("best_borough_growth_pct"))
    m = latest_rows(market).select("year", F.col("median_price_yoy_change_pct")
                                   .alias("market_growth_pct"))
    return m.join(best, "year").select(
        "year", "best_borough_growth_pct", "market_growth_pct",
        F.round(F.col("best_borough_growth_pct") - F.col("market_growth_pct"), 2)
        .alias("spread_pct"))


def growth_spread_of(star: Star) -> DataFrame:
    """``growth_spread`` with both KPIs from the same price cells, so the fact is read once."""
    cells = K.borough_price_cells(star)
    yearly = stats_with_median(cells, ["year"], "sale_price", [F.sum(N).alias("total_transactions")], "median_price")
    return growth_spread(K.yoy_table(K.yearly_borough_prices(star, cells)), K.market_table(yearly))
