import datetime as dt

from pyspark.sql import functions as F

from estatespark import config as C
from estatespark.functions import (bucketize, code_map, flag_in, pct_change, postcode_area,
                                   postcode_district, surrogate_key, try_date, upper_trim)
from estatespark.functions import dates as D
from estatespark.functions.columns import rounded_mean


def one(spark, expr, value, ddl):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_surrogate_key_golden(spark):
    # Keys re-typed from the published dimension exports.
    df = spark.createDataFrame([("E14", "Tower Hamlets", "O")], "d string, b string, c string")
    r = df.select(surrogate_key("d", "b").alias("loc"), surrogate_key("c").alias("prop")).first()
    assert r["loc"] == "a3299962004b7e250784d44a18db2094"
    assert r["prop"] == "f186217753c37b9b9f958d906208506e"


def test_surrogate_key_null_part(spark):
    import hashlib
    df = spark.createDataFrame([(None, "a")], "x string, y string")
    got = df.select(surrogate_key("x", "y").alias("k")).first()["k"]
    assert got == hashlib.md5(f"{C.SURROGATE_KEY_NULL}-a".encode()).hexdigest()


def test_price_bands_bounds(spark):
    prices = [249999, 250000, 499999, 500000, 749999, 750000, 999999, 1000000, 1499999, 1500000,
              1999999, 2000000, 4999999, 5000000]
    df = spark.createDataFrame([(p,) for p in prices], "price bigint")
    got = {r["price"]: (r["band"], r["seg"]) for r in df.select(
        "price", bucketize("price", C.PRICE_BANDS, C.TOP_PRICE_BAND).alias("band"),
        bucketize("price", C.MARKET_SEGMENTS, C.TOP_MARKET_SEGMENT).alias("seg")).collect()}
    assert got[249999] == ("1. Under £250K", "Affordable")
    assert got[250000][0] == "2. £250K-£500K"
    assert got[500000] == ("3. £500K-£750K", "Mid-Market")
    assert got[999999][0] == "4. £750K-£1M"
    assert got[1000000][0] == "5. £1M-£2M"
    assert got[1499999][1] == "Mid-Market"
    assert got[1500000][1] == "Premium"
    assert got[2000000][0] == "6. £2M-£5M"
    assert got[4999999] == ("6. £2M-£5M", "Premium")
    assert got[5000000] == ("7. £5M+", "Super-Prime")


def test_code_map_default_and_null(spark):
    df = spark.createDataFrame([("D",), ("X",), (None,)], "c string")
    got = [r[0] for r in df.select(code_map("c", C.PROPERTY_TYPES, C.UNKNOWN_LABEL)).collect()]
    assert got == ["Detached", "Unknown", "Unknown"]
    tri = [r[0] for r in df.select(code_map("c", (("D", True),))).collect()]
    assert tri == [True, None, None]


def test_flag_never_null(spark):
    df = spark.createDataFrame([("Camden",), ("Nowhere",), (None,)], "b string")
    got = [r[0] for r in df.select(flag_in("b", C.CENTRAL_BOROUGHS)).collect()]
    assert got == [True, False, False]


def test_pct_change_null_on_zero(spark):
    df = spark.createDataFrame([(110, 100), (5, 0), (None, 3)], "a bigint, b bigint")
    got = [r[0] for r in df.select(pct_change("a", "b", 2)).collect()]
    assert got == [10.0, None, None]


def test_try_date(spark):
    df = spark.createDataFrame([("2024-02-29 00:00",), ("bad",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(try_date("s")).collect()]
    assert got == [dt.date(2024, 2, 29), None, None, None]


def test_postcode_parts(spark):
    df = spark.createDataFrame([("SW1A 1AA",), (" e14 5ab ",), ("W1",), ("1XX",)], "p string")
    rows = df.select(upper_trim("p").alias("p")).select(
        postcode_area("p").alias("a"), postcode_district("p").alias("d")).collect()
    assert [(r.a, r.d) for r in rows] == [("SW", "SW1A"), ("E", "E14"), ("W", "W1"), (None, "1XX")]


def test_calendar_functions(spark):
    days = [dt.date(2021, 1, 3), dt.date(2021, 1, 2), dt.date(2021, 1, 1), dt.date(2024, 12, 31),
            dt.date(2024, 11, 15)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(D.is_weekend("d").alias("we"), F.weekofyear("d").alias("wk"),
                     D.day_of_week0("d").alias("dow"), D.quarter_end("d").alias("qe"),
                     D.year_end("d").alias("ye"), D.day_name("d").alias("dn"),
                     D.year_quarter("d").alias("yq"), D.year_month("d").alias("ym")).collect()
    assert rows[0].we and rows[0].dow == 0 and rows[0].dn == "Sunday"
    assert rows[1].we and rows[1].dow == 6
    assert rows[2].wk == 53 and not rows[2].we
    assert rows[3].qe == dt.date(2024, 12, 31) and rows[3].ye == dt.date(2024, 12, 31)
    assert rows[4].qe == dt.date(2024, 12, 31) and rows[4].yq == "2024-Q4" and rows[4].ym == "2024-11"


def test_rounded_mean_ties(spark):
    # (-0.79 + 33.80) / 2 = 16.505 -> 16.51 (half away from zero), however it is summed
    df = spark.createDataFrame([(1, -0.79), (1, 33.80), (2, -1.0), (2, -2.01)], "g int, x double")
    got = dict((r[0], r[1]) for r in df.groupBy("g").agg(rounded_mean("x", 2)).collect())
    assert got[1] == 16.51
    assert got[2] == -1.51
