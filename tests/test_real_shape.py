"""End to end on the real input shape: yearly pp-YYYY.csv files (quoted, headerless) and a
headed seed CSV, with the London defaults and the public API only."""

import os
import tempfile

from estatespark import LONDON
from estatespark.plans import kpi as K
from estatespark.plans import models as M
from estatespark.plans import star as S
from estatespark.plans.ingest import filter_areas
from estatespark.sources.files import read_seed, read_yearly_csv, to_warehouse

ROWS = {
    2021: [("{A1}", 500000, "2021-03-01 00:00", "E14 5AB", "F", "N", "L"),
           ("{A2}", 700000, "2021-06-01 00:00", "SW1A 1AA", "T", "N", "F"),
           ("{A3}", 300000, "2021-07-01 00:00", "M1 1AA", "S", "N", "F"),      # not London
           ("{A4}", 900000, "2021-08-01 00:00", "e14 5ab", "D", "Y", "F")],    # lower case
    2022: [("{B1}", 520000, "2022-03-01 00:00", "E14 9ZZ", "F", "Y", "L"),
           ("{B2}", 6000000, "2022-05-01 00:00", "SW1A 2BB", "D", "N", "F"),
           ("{B3}", 0, "2022-05-02 00:00", "E14 1AA", "F", "N", "L")],         # zero price
}


def write_inputs(root):
    os.makedirs(f"{root}/raw")
    for year, rows in ROWS.items():
        with open(f"{root}/raw/pp-{year}.csv", "w") as fh:
            for tid, price, date, pc, pt, nb, ten in rows:
                fh.write(f'"{tid}","{price}","{date}","{pc}","{pt}","{nb}","{ten}","1","",'
                         f'"HIGH ST","","LONDON","TOWER HAMLETS","GREATER LONDON","A","A"\n')
    with open(f"{root}/seed.csv", "w") as fh:
        fh.write("postcode_district,borough\nE14,Tower Hamlets\nSW1A,Westminster\n")


def test_pipeline_on_reference_shaped_files(spark):
    root = tempfile.mkdtemp(prefix="real-")
    write_inputs(root)
    raw = read_yearly_csv(spark, f"{root}/raw/pp-*.csv", LONDON.year_in_path_pattern)
    silver = filter_areas(raw, LONDON)
    assert sorted(r.transaction_id for r in silver.collect()) == ["{A1}", "{A2}", "{B1}", "{B2}", "{B3}"]
    seed = read_seed(spark, f"{root}/seed.csv")
    flagged = M.flagged_from_raw(to_warehouse(silver), seed, LONDON)
    star = S.materialize_star(spark, S.build_star(spark, flagged, LONDON), f"{root}/marts")
    assert star.fact.count() == 4 and star.location_rows == 2 and star.property_rows == 3
    mh = {r.year: r for r in K.market_health(star).collect()}
    assert (mh[2021].total_transactions, mh[2021].median_price, mh[2021].central_london_transactions) == (2, 600000.0, 1)
    assert (mh[2022].super_prime_transactions, mh[2022].prev_year_transactions) == (1, 2)
    assert mh[2022].active_boroughs == 2 and mh[2022].volume_yoy_change_pct == 0.0
    key = {r.postcode_district: r.location_key for r in star.dim_location.collect()}
    import hashlib
    assert key["E14"] == hashlib.md5(b"E14-Tower Hamlets").hexdigest()
