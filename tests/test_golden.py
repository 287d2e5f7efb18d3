"""Stage-level goldens: published KPI rows re-typed as constants, fed to the report and
column operators, checked against the published derived figures."""

from pyspark.sql import functions as F

from estatespark.functions import pct_change
from estatespark.plans import report as R

YOY_COLS = ("borough string, is_central_london boolean, london_region string, year int, "
            "transactions bigint, median_price double, yoy_median_change_pct double")
VEL_COLS = "borough string, london_region string, year int, transactions bigint"
MKT_COLS = "year int, median_price double, median_price_yoy_change_pct double"


def test_market_change_percentages(spark):
    # yearly totals / medians of the published market summary, 2023 -> 2024
    df = spark.createDataFrame([(65964, 59559, 565000.0, 570000.0), (59559, 75217, 570000.0, 575000.0)],
                               "t bigint, pt bigint, m double, pm double")
    got = [(r.v, r.p) for r in df.select(pct_change("t", "pt", 2).alias("v"),
                                         pct_change("m", "pm", 2).alias("p")).collect()]
    assert got == [(10.75, -0.88), (-20.82, -0.87)]


def test_borough_growth_from_region_rows(spark):
    yoy = spark.createDataFrame([
        ("Islington", True, "North London", 2024, 2310, 625000.0, -0.79),
        ("Islington", True, "East Central London", 2024, 650, 836250.0, 33.80),
        ("Islington", True, "North London", 2023, 2072, 630000.0, -30.62),
    ], YOY_COLS)
    r = R.borough_growth_ranking(yoy).first()
    assert (r.year, r.yoy_growth_pct, r.median_price, r.growth_rank) == (2024, 16.51, 730625.0, 1)
    market = spark.createDataFrame([(2024, 565000.0, -0.88), (2023, 570000.0, -0.87)], MKT_COLS)
    s = R.growth_spread(yoy, market).first()
    assert (s.best_borough_growth_pct, s.market_growth_pct, s.spread_pct) == (16.51, -0.88, 17.39)


def test_top_liquidity_sums_region_rows(spark):
    vel = spark.createDataFrame([
        ("Wandsworth", "South West London", 2024, 5592),
        ("Southwark", "South East London", 2024, 3912),
        ("Lambeth", "South West London", 2024, 3591),
        ("Lambeth", "South East London", 2024, 876),
        ("Lambeth", "South West London", 2023, 9999),
    ], VEL_COLS)
    got = [(r.borough, r.transactions) for r in R.top_liquidity(vel, 3).collect()]
    assert got == [("Wandsworth", 5592), ("Lambeth", 4467), ("Southwark", 3912)]
