"""KPI views over the star.

Shape of every plan: the fact (only the columns needed, calendar/year predicates stated on
its own columns so they reach the scan) joins broadcast dimensions map-side, one hash
aggregation shuffles the group keys, and any window runs on the aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import bucketize, code_map, pct_change
from ..operators.aggregates import conditional_pivot, distinct_numbers, price_stats
from ..operators.median import N, stats_with_median, value_counts, weighted_mean
from ..operators.windows import change_columns, rank_within, tile_within, with_previous
from .star import Star

BOROUGH_KEYS = ["borough", "is_central_london", "london_region"]


def star_rows(star: Star, fact_cols: Sequence[str], loc_cols: Sequence[str] = ("borough",),
              date_cols: Sequence[str] | None = None, prop_cols: Sequence[str] | None = None,
              years: tuple[int | None, int | None] | None = None) -> DataFrame:
    """Fact rows joined to the dimensions they need (matched boroughs only).

    ``date_cols`` adds the inner join to the calendar (rows outside it vanish); ``years``
    (lo, hi) restricts the calendar year, stated on ``sale_year`` as well for pruning.
    """
    f = star.calendar_fact() if date_cols is not None else star.fact
    if years is not None:
        lo, hi = years
        if lo is not None:
            f = f.where(F.col("sale_year") >= F.lit(lo))
        if hi is not None:
            f = f.where(F.col("sale_year") <= F.lit(hi))
    keys = ["location_key"]
    if date_cols is not None:
        keys.append("date_key")
    if prop_cols is not None:
        keys.append("property_key")
    rows = f.select(*keys, *fact_cols)
    rows = rows.join(star.locations().select("location_key", *loc_cols), "location_key")
    if date_cols is not None:
        d = star.dates().select("date_key", *date_cols)
        rows = rows.join(d, "date_key")
        if years is not None and "year" in date_cols:
            lo, hi = years
            if lo is not None:
                rows = rows.where(F.col("year") >= F.lit(lo))
            if hi is not None:
                rows = rows.where(F.col("year") <= F.lit(hi))
    if prop_cols is not None:
        rows = rows.join(star.properties().select("property_key", *prop_cols), "property_key")
    return rows


def borough_price_trends(star: Star) -> DataFrame:
    """Per borough (and region) and calendar quarter: volume and price statistics."""
    rows = star_rows(star, ["sale_price"], BOROUGH_KEYS,
                     ["year", "quarter", "year_quarter", "quarter_start_date"])
    keys = [*BOROUGH_KEYS, "year", "quarter", "year_quarter", "quarter_start_date"]
    stats = stats_with_median(
        value_counts(rows, keys, "sale_price"), keys, "sale_price",
        price_stats(which=("transactions", "avg_price", "min_price", "max_price", "price_stddev",
                           "price_volatility_ratio")), "median_price")
    return stats.select(*keys, "transactions", "avg_price", "median_price", "min_price",
                        "max_price", "price_stddev", "price_volatility_ratio")


def borough_price_cells(star: Star) -> DataFrame:
    """Sales per borough row, year and price: what yearly borough and market prices come from."""
    rows = star_rows(star, ["sale_price"], BOROUGH_KEYS, ["year"])
    return value_counts(rows, [*BOROUGH_KEYS, "year"], "sale_price")


def yearly_borough_prices(star: Star, cells: DataFrame | None = None) -> DataFrame:
    cells = borough_price_cells(star) if cells is None else cells
    return stats_with_median(cells, [*BOROUGH_KEYS, "year"], "sale_price",
                             price_stats(which=("transactions", "avg_price")), "median_price")


def yoy_growth(star: Star, lag_keys: Sequence[str] = ("borough",),
               tie_break: Sequence[str] = ("london_region",)) -> DataFrame:
    """``yoy_table`` in the published order."""
    return yoy_table(yearly_borough_prices(star), lag_keys, tie_break).orderBy(
        F.col("year").desc(), F.col("yoy_median_change_pct").desc_nulls_last(), "borough", "london_region")


def yoy_table(yearly: DataFrame, lag_keys: Sequence[str] = ("borough",),
              tie_break: Sequence[str] = ("london_region",)) -> DataFrame:
    """Year-on-year change per borough.

    ``lag_keys=("borough",)`` reproduces the published view, whose series mixes the region
    rows of a borough (the previous row may be another region of the same year); the
    tie-break makes that order deterministic. ``("borough", "london_region")`` is the
    corrected per-region series. Percentages use the rounded averages / medians.
    """
    order = ["year", *[t for t in tie_break if t not in lag_keys]]
    lagged = with_previous(yearly, list(lag_keys), order, [
        ("avg_price", "prev_avg_price"), ("median_price", "prev_median_price"),
        ("transactions", "prev_transactions")])
    return lagged.select(
        *BOROUGH_KEYS, "year", "transactions", "avg_price", "median_price", "prev_avg_price",
        "prev_median_price",
        *change_columns([
            ("avg_price", "prev_avg_price", "yoy_avg_change_gbp", None),
            ("median_price", "prev_median_price", "yoy_median_change_gbp", None),
            ("avg_price", "prev_avg_price", "yoy_avg_change_pct", 2),
            ("median_price", "prev_median_price", "yoy_median_change_pct", 2),
            ("transactions", "prev_transactions", "yoy_volume_change_pct", 2),
        ]))


def borough_activity(star: Star) -> DataFrame:
    rows = star_rows(star, [], BOROUGH_KEYS, ["year"])
    return rows.groupBy(*BOROUGH_KEYS, "year").agg(F.count(F.lit(1)).alias("transactions"))


def transaction_velocity(star: Star) -> DataFrame:
    """``velocity_table`` in the published order."""
    return velocity_table(borough_activity(star)).orderBy(
        F.col("year").desc(), "volume_rank", "borough", "london_region")


def velocity_table(act: DataFrame) -> DataFrame:
    """Yearly volume rank (ties share a rank) and liquidity quartile per borough row."""
    by_volume = [F.col("transactions").desc()]
    ranked = act.select(
        "*",
        F.round(F.col("transactions").cast("double") / F.lit(12.0), 0)
        .alias("avg_monthly_transactions"),
        rank_within(["year"], by_volume).alias("volume_rank"),
        tile_within(4, ["year"], by_volume + [F.col("borough"), F.col("london_region")])
        .alias("liquidity_quartile"),
    )
    return ranked.select(
        *BOROUGH_KEYS, "year", "transactions", "avg_monthly_transactions", "volume_rank",
        code_map("liquidity_quartile", C.LIQUIDITY_TIERS).alias("liquidity_tier"),
    )


def property_type_roi(star: Star) -> DataFrame:
    """``roi_table`` in the published order."""
    return roi_table(star).orderBy("borough", F.col("four_year_growth_pct").desc_nulls_last(), "property_type_name")


def roi_table(star: Star) -> DataFrame:
    """Per (borough, property type) with enough sales: overall statistics plus first- and
    last-year averages and growth, in ONE pass over the fact.

    The first/last-year measures are conditional aggregates; a pair with no sale in that
    year gets NULL count and average (as an outer join of separate aggregates would).
    Overall measures count sales of any date (no calendar join).
    """
    cfg = star.cfg
    lo = F.lit(str(cfg.calendar_start)).cast("date")
    hi = F.lit(str(cfg.calendar_end)).cast("date")
    rows = star_rows(star, ["sale_price", "sale_year", "date_key"], ["borough"],
                     prop_cols=["property_type_name", "property_category"])
    in_cal = (F.col("date_key") >= lo) & (F.col("date_key") < hi)
    keys = ["borough", "property_type_name", "property_category"]
    cells = value_counts(rows, keys, "sale_price", {
        "_first": in_cal & (F.col("sale_year") == F.lit(cfg.first_year)),
        "_last": in_cal & (F.col("sale_year") == F.lit(cfg.last_year))})
    agg = stats_with_median(cells, keys, "sale_price", [
        F.sum(N).alias("total_transactions"),
        F.round(weighted_mean("sale_price"), 0).alias("avg_price_overall"),
        weighted_mean("sale_price", "_first").alias("_avg_first"),
        weighted_mean("sale_price", "_last").alias("_avg_last"),
        F.nullif(F.sum("_first"), F.lit(0)).alias("transactions_first_year"),
        F.nullif(F.sum("_last"), F.lit(0)).alias("transactions_last_year"),
    ], "median_price_overall")
    return agg.where(F.col("total_transactions") >= F.lit(cfg.min_type_sales)).select(
        "borough", "property_type_name", "property_category", "total_transactions",
        "avg_price_overall", "median_price_overall",
        F.round("_avg_first", 0).alias("avg_price_first_year"),
        F.round("_avg_last", 0).alias("avg_price_last_year"),
        pct_change("_avg_last", "_avg_first", 2).alias("four_year_growth_pct"),
        "transactions_first_year", "transactions_last_year",
    )


def postcode_stats(star: Star) -> DataFrame:
    """Recent sales per (borough, district), kept when there are enough of them (HAVING)."""
    cfg = star.cfg
    rows = star_rows(star, ["sale_price"], ["borough", "postcode_district"], ["year"],
                     years=(cfg.recent_since_year, None))
    keys = ["borough", "postcode_district"]
    stats = stats_with_median(value_counts(rows, keys, "sale_price"), keys, "sale_price", [
        F.sum(N).alias("postcode_transactions"),
        F.round(weighted_mean("sale_price"), 0).alias("postcode_avg_price"),
    ], "postcode_median_price")
    return stats.where(F.col("postcode_transactions") >= F.lit(cfg.min_postcode_sales)).select(
        "borough", "postcode_district", "postcode_transactions", "postcode_median_price",
        "postcode_avg_price")


def undervalued_postcodes(star: Star) -> DataFrame:
    """``undervalued_table`` in the published order."""
    return undervalued_table(star).orderBy("borough", F.col("price_gap_pct").asc_nulls_last(), "postcode_district")


def undervalued_table(star: Star) -> DataFrame:
    """Each qualifying district against the median of its borough's district medians.

    The borough roll-up is a window over the (small) per-district table, so detail and
    roll-up share one exchange instead of a self-join.
    """
    ps = postcode_stats(star)
    b_med = F.round(F.median("postcode_median_price").over(Window.partitionBy("borough")), 0)
    both = ps.select("*", b_med.alias("borough_median_price"))
    p, b = F.col("postcode_median_price"), F.col("borough_median_price")
    return both.select(
        "borough", "postcode_district", "postcode_transactions", "postcode_median_price",
        "borough_median_price",
        (p - b).alias("price_gap_gbp"),
        pct_change(p, b, 1).alias("price_gap_pct"),
        bucketize(p, [(b * F.lit(r), label) for r, label in star.cfg.value_positions],
                  star.cfg.top_value_position).alias("value_position"),
    )


def _segment_premium(star: Star, seg_col: str, seg_filter, categories) -> DataFrame:
    rows = star_rows(star, ["sale_price", seg_col], ["borough"]).where(seg_filter)
    keys = ["borough", seg_col]
    per_seg = stats_with_median(value_counts(rows, keys, "sale_price"), keys, "sale_price",
                                [F.sum(N).alias("transactions")], "median_price")
    return conditional_pivot(per_seg, ["borough"], seg_col, categories,
                             [("transactions", "_txns"), ("median_price", "_median")])


def new_build_premium(star: Star) -> DataFrame:
    cfg = star.cfg
    piv = _segment_premium(star, "is_new_build", F.col("is_new_build").isNotNull(),
                           [(True, "new_build"), (False, "existing")])
    nb, ex = F.col("new_build_median"), F.col("existing_median")
    return piv.where((F.col("new_build_txns") >= F.lit(cfg.min_segment_sales))
                     & (F.col("existing_txns") >= F.lit(cfg.min_segment_sales))).select(
        "borough", "new_build_txns", "existing_txns", "new_build_median", "existing_median",
        (nb - ex).alias("premium_gbp"), pct_change(nb, ex, 1).alias("premium_pct"),
    ).orderBy(F.col("premium_pct").desc_nulls_last(), "borough")


def tenure_premium(star: Star) -> DataFrame:
    cfg = star.cfg
    piv = _segment_premium(star, "tenure_label", F.col("tenure_label").isin("Freehold", "Leasehold"),
                           [("Freehold", "freehold"), ("Leasehold", "leasehold")])
    fh, lh = F.col("freehold_median"), F.col("leasehold_median")
    return piv.where((F.col("freehold_txns") >= F.lit(cfg.min_segment_sales))
                     & (F.col("leasehold_txns") >= F.lit(cfg.min_segment_sales))).select(
        "borough", "freehold_txns", "leasehold_txns", "freehold_median", "leasehold_median",
        (fh - lh).alias("freehold_premium_gbp"), pct_change(fh, lh, 1).alias("freehold_premium_pct"),
    ).orderBy(F.col("freehold_premium_pct").desc_nulls_last(), "borough")


def yearly_market(star: Star) -> DataFrame:
    """Yearly totals, medians and distinct boroughs and districts, in two aggregations.

    Boroughs and districts are counted as bits: every place has a dense number, and a year's
    bitmaps (32,768 numbers each, as many as the dimension needs) combine map-side."""
    flags = ("is_million_plus", "is_super_prime", "is_central_london")
    places = ["borough_number", "district_number"]
    f = star.calendar_fact().select("location_key", "date_key", "sale_price", *flags)
    rows = (f.join(star.numbered_locations().select("location_key", *places), "location_key")
            .join(star.dates().select("date_key", "year"), "date_key"))
    cells = value_counts(rows, ["year", *places], "sale_price", {f"_{c}": F.col(c) for c in flags})
    n = star.location_count()
    return stats_with_median(cells, ["year"], "sale_price", [
        F.sum(N).alias("total_transactions"),
        F.round(weighted_mean("sale_price"), 0).alias("avg_price"),
        F.sum(F.col("sale_price") * F.col(N)).alias("total_volume_gbp"),
        F.sum("_is_million_plus").alias("million_plus_transactions"),
        F.sum("_is_super_prime").alias("super_prime_transactions"),
        F.sum("_is_central_london").alias("central_london_transactions"),
        distinct_numbers("borough_number", n).alias("active_boroughs"),
        distinct_numbers("district_number", n).alias("active_postcodes"),
    ], "median_price").select(
        "year", "total_transactions", "avg_price", "median_price", "total_volume_gbp",
        "million_plus_transactions", "super_prime_transactions", "central_london_transactions",
        "active_boroughs", "active_postcodes")


def market_health(star: Star) -> DataFrame:
    """``market_table`` in the order of the years."""
    return market_table(yearly_market(star)).orderBy("year")


def market_table(yearly: DataFrame) -> DataFrame:
    """One row per calendar year with headline indicators and change on the prior year.
    The unpartitioned LAG runs on the per-year rows only."""
    lagged = with_previous(yearly, [], ["year"], [
        ("total_transactions", "prev_year_transactions"), ("median_price", "prev_year_median")])
    return lagged.select(
        "*",
        pct_change("total_transactions", "prev_year_transactions", 2).alias("volume_yoy_change_pct"),
        pct_change("median_price", "prev_year_median", 2).alias("median_price_yoy_change_pct"),
    )
