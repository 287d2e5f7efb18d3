import datetime as dt
import hashlib

from pyspark.sql import functions as F

from estatespark import config as C
from estatespark.config import LONDON
from estatespark.plans import models as M
from estatespark.plans.star import build_star
from conftest import raw_rows, seed_rows


def flagged(spark, rows, seed=(("E14", "Tower Hamlets"), ("SW1A", "Westminster"))):
    return M.flagged_from_raw(raw_rows(spark, rows), seed_rows(spark, list(seed)), LONDON)


def test_staging_filters_and_lenient_date(spark):
    rows = [dict(price=0), dict(postcode=None), dict(sale_date=None), dict(sale_date="bad"),
            dict(sale_date="2024-02-29 00:00")]
    stg = M.stg_transactions(raw_rows(spark, rows))
    got = {r.transaction_id: r.sale_date for r in stg.collect()}
    assert got == {"4": None, "5": dt.date(2024, 2, 29)}


def test_unknown_codes(spark):
    stg = M.stg_transactions(raw_rows(spark, [dict(property_type="X", tenure="U", new_build=None,
                                                   ppd_type="Z")]))
    r = stg.first()
    assert (r.property_type, r.tenure, r.is_new_build, r.ppd_type) == ("Unknown", "Unknown", None,
                                                                       "Unknown")


def test_postcode_normalised_at_staging(spark):
    stg = M.stg_transactions(raw_rows(spark, [dict(postcode=" e14 5ab ")]))
    r = stg.first()
    assert (r.postcode, r.postcode_area, r.postcode_district) == ("E14 5AB", "E", "E14")


def test_lookup_miss_keeps_row(spark):
    f = flagged(spark, [dict(postcode="N99 1AA")])
    r = f.first()
    assert r.borough == C.UNMATCHED_BOROUGH
    star = build_star(spark, f, LONDON)
    key = star.fact.first().location_key
    assert key == hashlib.md5(b"N99-Unmatched").hexdigest()


def test_seed_is_normalised(spark):
    seed = seed_rows(spark, [(" e14 ", " Tower Hamlets ")])
    r = M.stg_boroughs(seed).first()
    assert (r.postcode_district, r.borough) == ("E14", "Tower Hamlets")


def test_flags(spark):
    rows = [dict(price=1_000_000, sale_date="2023-01-01 00:00", property_type="F", tenure="L"),
            dict(price=5_000_000, sale_date="2024-05-01 00:00", postcode="SW1A 1AA",
                 property_type="D", tenure="F"),
            dict(price=200_000, sale_date="bad", postcode="EC1A 1BB")]
    f = {r.transaction_id: r for r in flagged(spark, rows).collect()}
    assert f["1"].is_million_plus and not f["1"].is_super_prime and f["1"].is_flat and f["1"].is_leasehold
    assert f["2"].is_super_prime and f["2"].is_central_london and f["2"].is_most_recent_year
    assert not f["1"].is_most_recent_year
    # undated sale: flag is FALSE, never NULL; EC is a prime area, SW (letters only) is not
    assert f["3"].is_most_recent_year is False
    assert f["3"].is_prime_postcode_area and not f["2"].is_prime_postcode_area
    for r in f.values():
        for c in M.FLAG_COLUMNS:
            assert r[c] is not None


def test_dimensions(spark):
    rows = [dict(postcode="E14 5AB", property_type="F"), dict(postcode="E14 9ZZ", property_type="D"),
            dict(postcode="SW1A 1AA", property_type="F")]
    star = build_star(spark, flagged(spark, rows), LONDON)
    loc = {r.postcode_district: r for r in star.dim_location.collect()}
    assert set(loc) == {"E14", "SW1A"}
    assert loc["E14"].london_region == "East London" and not loc["E14"].is_central_london
    assert loc["SW1A"].london_region == "South West London" and loc["SW1A"].is_central_london
    prop = {r.property_type_code: r for r in star.dim_property.collect()}
    assert prop["F"].property_category == "Apartment" and prop["D"].property_category == "House"
    assert prop["D"].property_description == "Standalone house"
    assert star.dim_date.count() == 1461
    fact = star.fact.collect()
    assert {r.transaction_count for r in fact} == {1}
    assert all(r.sale_price_million_plus == 0 for r in fact)
