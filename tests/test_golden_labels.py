"""Bands, labels, regions, tiers and keys of the published extracts, re-typed as constants, so that
a wrong value in the configuration cannot agree with itself."""

import pytest
from conftest import raw_rows, seed_rows
from pyspark.sql import functions as F

from estatespark.config import LONDON
from estatespark.functions import code_map, pct_change
from estatespark.plans import kpi as K
from estatespark.plans import models as M
from estatespark.plans import star as S

BANDS = [(1, "1. Under £250K", "Affordable"), (249_999, "1. Under £250K", "Affordable"),
         (250_000, "2. £250K-£500K", "Affordable"), (499_999, "2. £250K-£500K", "Affordable"),
         (500_000, "3. £500K-£750K", "Mid-Market"), (750_000, "4. £750K-£1M", "Mid-Market"),
         (1_000_000, "5. £1M-£2M", "Mid-Market"), (1_499_999, "5. £1M-£2M", "Mid-Market"),
         (1_500_000, "5. £1M-£2M", "Premium"), (2_000_000, "6. £2M-£5M", "Premium"),
         (4_999_999, "6. £2M-£5M", "Premium"), (5_000_000, "7. £5M+", "Super-Prime")]

LOCATIONS = [("E14", "E", "Tower Hamlets", False, "East London", "a3299962004b7e250784d44a18db2094"),
             ("E15", "E", "Newham", False, "East London", "19a670a94e76ddbaec13eebadf6836bf"),
             ("NW7", "NW", "Barnet", False, "North West London", "b30dbd5c1086d09e420bfdaebaaa582b"),
             ("E17", "E", "Waltham Forest", False, "East London", "b9f961dbcc6e629e67285431e45cfedd"),
             ("E8", "E", "Hackney", False, "East London", "7c6d2eb7ba1cf9e3dc92c32cd25f189a"),
             ("E18", "E", "Redbridge", False, "East London", "b99795f07993516ab21c45ec8f177cca")]

REGIONS = {"EC": "East Central London", "N": "North London", "SE": "South East London",
           "SW": "South West London", "W": "West London", "WC": "West Central London"}

CENTRAL = {"Camden", "City of London", "Hammersmith and Fulham", "Islington", "Kensington and Chelsea",
           "Lambeth", "Southwark", "Westminster"}

PROPERTIES = {
    ("f186217753c37b9b9f958d906208506e", "O", "Other", "Non-standard property type", "Other"),
    ("800618943025315f869e4e1f09471012", "F", "Flat", "Apartment within a larger building", "Apartment"),
    ("f623e75af30e62bbd73d6df5b50bb7b5", "D", "Detached", "Standalone house", "House"),
    ("b9ece18c950afbfa6b0fdbfa4ff731d3", "T", "Terraced", "House in a row sharing both walls", "House"),
    ("5dbc98dcc983a70728bd082d1a47546e", "S", "Semi-Detached", "House sharing one wall", "House")}

POSITIONS = [("Barnet", 444_000, 565_000, -121_000, -21.4, "Undervalued (10-25% below)"),
             ("Barnet", 525_000, 565_000, -40_000, -7.1, "In Line With Borough"),
             ("Barnet", 724_000, 565_000, 159_000, 28.1, "Significant Premium (>25% above)"),
             ("Camden", 407_500, 880_000, -472_500, -53.7, "Significantly Undervalued (>25% below)"),
             ("Camden", 980_000, 880_000, 100_000, 11.4, "Premium (10-25% above)")]


def flagged(spark, rows, seed):
    return M.flagged_from_raw(raw_rows(spark, rows), seed_rows(spark, seed), LONDON)


def test_price_bands_and_flags(spark):
    got = flagged(spark, [dict(price=p) for p, *_ in BANDS], [("E14", "Tower Hamlets")]).collect()
    assert sorted((r.price, r.price_band, r.market_segment) for r in got) == BANDS
    assert {r.price for r in got if r.is_million_plus} == {p for p, *_ in BANDS if p >= 1_000_000}
    assert {r.price for r in got if r.is_super_prime} == {5_000_000}


def test_locations_regions_and_central_boroughs(spark):
    areas = list(REGIONS)
    central = sorted(CENTRAL)
    seed = [(d, b) for d, _, b, *_ in LOCATIONS] + [(f"{a}1", "Elsewhere") for a in areas]
    seed += [(f"E{30 + i}", b) for i, b in enumerate(central)]
    rows = flagged(spark, [dict(postcode=f"{d} 1AA") for d, _ in seed], seed)
    got = {(r.postcode_district, r.postcode_area, r.borough, r.is_central_london, r.london_region, r.location_key)
           for r in S.dim_location(rows, LONDON).collect()}
    assert set(LOCATIONS) <= got
    assert {g[1]: g[4] for g in got if g[2] == "Elsewhere"} == REGIONS
    assert {g[2] for g in got if g[3]} == CENTRAL


def test_property_types_and_keys(spark):
    rows = flagged(spark, [dict(property_type=c) for c in "OFDTS"], [])
    got = S.dim_property(rows).select("property_key", "property_type_code", "property_type_name",
                                      "property_description", "property_category")
    assert set(map(tuple, got.collect())) == PROPERTIES


def test_liquidity_tiers(spark):
    from estatespark import config as C
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "q int").select("q", code_map("q", C.LIQUIDITY_TIERS).alias("t"))
    assert [r.t for r in df.orderBy("q").collect()] == ["High Liquidity", "Moderate Liquidity", "Lower Liquidity", "Thin Market"]


@pytest.mark.parametrize("borough,price,median,gap,pct,label", POSITIONS)
def test_value_positions(spark, monkeypatch, borough, price, median, gap, pct, label):
    # two mirrored districts around the published borough median
    other = 2 * median - price
    stats = spark.createDataFrame([(borough, "A1", 100, float(price), 0.0), (borough, "A2", 100, float(other), 0.0)],
                                  "borough string, postcode_district string, postcode_transactions bigint, "
                                  "postcode_median_price double, postcode_avg_price double")
    monkeypatch.setattr(K, "postcode_stats", lambda star: stats)
    star = S.Star(None, None, None, None, LONDON)
    r = K.undervalued_postcodes(star).where("postcode_district = 'A1'").first()
    assert (r.borough_median_price, r.price_gap_gbp, r.price_gap_pct, r.value_position) == (median, gap, pct, label)


def test_growth_and_premium_rules(spark):
    # average of the first and last year -> growth; new-build and tenure medians -> premium
    df = spark.createDataFrame([(2_110_823.0, 1_768_709.0, 19.34), (481_752.0, 431_372.0, 11.68),
                                (1_675_609.0, 1_711_339.0, -2.09)], "b double, a double, g double")
    assert all(r.got == r.g for r in df.select("g", pct_change("b", "a", 2).alias("got")).collect())
    df = spark.createDataFrame([(1_600_000.0, 966_250.0, 65.6), (3_350_000.0, 923_930.0, 262.6)],
                               "b double, a double, g double")
    assert all(r.got == r.g for r in df.select("g", pct_change("b", "a", 1).alias("got")).collect())


def test_bands_are_parameters(spark):
    cfg = LONDON.with_(price_bands=((100, "low"),), top_price_band="high", million_plus=100)
    rows = M.flagged_from_raw(raw_rows(spark, [dict(price=99), dict(price=100)]), seed_rows(spark, [("E14", "X")]), cfg)
    assert sorted((r.price, r.price_band) for r in rows.collect()) == [(99, "low"), (100, "high")]
    fact = S.fact_transactions(rows, cfg).select("sale_price", "sale_price_million_plus", "is_million_plus")
    assert sorted(map(tuple, fact.collect())) == [(99, 0, False), (100, 100, True)]
    assert fact.agg(F.sum("sale_price_million_plus")).first()[0] == 100
