"""Load history, versioned marts, views by name, bucketed tables, failing rows, observed counts."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001, raw_rows, seed_rows
from estatespark import LONDON
from estatespark import catalog as E
from estatespark.config import FIXTURE
from estatespark.plans import layers as P
from estatespark.plans import marts as MT
from estatespark.plans import mart_queries as MQ
from estatespark.plans import models as M
from estatespark.plans import quality_suite as QS
from estatespark.plans import star as S
from estatespark.plans import views as V
from estatespark.sources import loads as L
from test_plans import plan


def line(i, price):
    cells = [f"t{i}", str(price), "2022-05-01 00:00", "E1 1AA", "F", "N", "L", "", "", "s", "", "t", "d", "c", "A", "A"]
    return ",".join(f'"{c}"' for c in cells) + "\n"


def test_files_load_once_and_again_when_they_change(spark, tmp_path):
    root, base = tmp_path / "raw", str(tmp_path / "wh")
    root.mkdir()
    (root / "pp-2021.csv").write_text(line(1, 10) + line(2, 20))
    (root / "pp-2022.csv").write_text(line(3, 30))
    load = lambda: L.load_new(spark, str(root), base, LONDON.year_in_path_pattern)
    rows = lambda: {(r.transaction_id, r.price, r.source_year, r.load) for r in L.loaded(spark, base).collect()}
    assert load() == 2 and load() == 0
    assert rows() == {("t1", 10, 2021, 1), ("t2", 20, 2021, 1), ("t3", 30, 2022, 1)}
    (root / "pp-2021.csv").write_text(line(1, 11))
    (root / "pp-2023.csv").write_text("")
    assert load() == 1 and load() == 0  # the empty file holds nothing to load
    assert rows() == {("t1", 11, 2021, 2), ("t3", 30, 2022, 1)}
    found = {(os.path.basename(r.path), r.load): r.rows for r in L.history(spark, base).collect()}
    assert found == {("pp-2021.csv", 1): 2, ("pp-2022.csv", 1): 1, ("pp-2021.csv", 2): 1}


def test_a_load_that_died_before_the_ledger_is_not_seen(spark, tmp_path, monkeypatch):
    root, base = tmp_path / "raw", str(tmp_path / "wh")
    root.mkdir()
    (root / "pp-2021.csv").write_text(line(1, 10))
    assert L.load_new(spark, str(root), base, LONDON.year_in_path_pattern) == 1
    (root / "pp-2022.csv").write_text(line(2, 20))
    real = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        L.load_new(spark, str(root), base, LONDON.year_in_path_pattern)
    monkeypatch.undo()
    assert real is not None and L.loaded(spark, base).count() == 1
    assert L.load_new(spark, str(root), base, LONDON.year_in_path_pattern) == 1
    assert {r.transaction_id for r in L.loaded(spark, base).collect()} == {"t1", "t2"}


def small_star(spark, price=500_000, broken=False):
    raw = raw_rows(spark, [{"price": price, "transaction_id": str(i)} for i in range(4)])
    flagged = M.flagged_from_raw(raw, seed_rows(spark, [("E14", "Tower Hamlets")]), LONDON)
    if broken:
        flagged = flagged.withColumn("price", F.raise_error(F.lit("the rebuild dies")).cast("bigint"))
    return S.build_star(spark, flagged, LONDON)


def test_a_rebuild_that_dies_leaves_the_current_version(spark, tmp_path):
    root = str(tmp_path / "marts")
    with pytest.raises(ValueError):
        MT.current(spark, root, LONDON)
    MT.published(spark, small_star(spark, 1), root)
    open_before = MT.current(spark, root, LONDON).fact
    with pytest.raises(Exception, match="the rebuild dies"):
        MT.published(spark, small_star(spark, broken=True), root)
    assert MT.current(spark, root, LONDON).fact.agg(F.sum("sale_price")).first()[0] == 4
    MT.published(spark, small_star(spark, 2), root)
    assert MT.current(spark, root, LONDON).fact.agg(F.sum("sale_price")).first()[0] == 8
    assert MT.current(spark, root, LONDON, back=1).fact.agg(F.sum("sale_price")).first()[0] == 4
    assert open_before.count() == 4  # a reader keeps its version
    MT.published(spark, small_star(spark, 3), root)
    versions = {r.version: r.folder for r in MT.versions(spark, root).collect()}
    assert set(versions) == {1, 2, 3} and not os.path.exists(f"{root}/{versions[1]}") and os.path.exists(f"{root}/{versions[2]}")
    assert MT.current(spark, root, LONDON).location_rows == 1


def test_failing_rows_of_a_small_source(spark):
    raw = raw_rows(spark, [{"transaction_id": "a"}, {"transaction_id": "a"}, {"transaction_id": "b", "price": None},
                           {"transaction_id": "c", "sale_date": "not a date"}, {"transaction_id": None}])
    seed = seed_rows(spark, [("E14", "Tower Hamlets"), ("E14", "Twice"), (None, "x")])
    stg, boroughs = M.stg_transactions(raw), M.stg_boroughs(seed)
    enriched = M.enriched(stg, boroughs, LONDON)
    priced = M.priced(enriched, LONDON)
    flagged = M.flagged(priced, LONDON, stg)
    star = S.build_star(spark, flagged, LONDON)
    rels = dict(raw=raw, stg=stg, boroughs=boroughs, enriched=enriched, priced=priced, flagged=flagged, dim_date=star.dim_date,
                dim_location=star.dim_location, dim_property=star.dim_property, fact=star.fact)
    found = [tuple(r) for r in QS.failing_rows(rels, QS.layer_rows(rels, LONDON), star).collect()]
    count = lambda *want: sum(f[:len(want)] == want for f in found)
    assert count("unique", "raw", "transaction_id", "a") == 2 and count("unique", "enriched", "transaction_id", "a") == 4
    assert count("unique", "enriched", "transaction_id", "c") == 2  # the lookup has its district twice
    assert count("not_null", "raw", "price", "b") == 1 and count("not_null", "stg", "sale_date", "c") == 1
    assert count("not_null", "raw", "transaction_id", None) == 1 and count("not_null", "fact", "transaction_key", None) == 2
    assert count("unique", "boroughs", "postcode_district", "E14") == 2 and count("not_null", "boroughs", "postcode_district") == 1
    assert count("unique", "fact", "transaction_key", "a") == 4 and count("relationships") == 0
    assert sum(len(c) for _, c in QS.NOT_NULL_TESTS) + len(QS.UNIQUE_TESTS) + len(QS.ACCEPTED_VALUES_TESTS) + len(QS.RELATIONSHIP_TESTS) == 64


def test_failing_rows_need_no_window(spark):
    p = plan(E.queries()["q_dq_failing_rows"](spark, SF001))
    assert "Window" not in p and "PythonUDF" not in p


def test_observed_counts_equal_the_checks_without_a_job(spark):
    rels, st = QS.relations(spark, SF001, FIXTURE)
    spark.sparkContext.setJobGroup("observed", "observed")
    seen = QS.observed_summary(st)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("observed")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {(r.relation, r.column_name): r.failures for r in seen.collect()}
    checks = QS.not_null_summary(rels, QS.layer_rows(rels, FIXTURE)).collect()
    assert got == {(r.relation, r.column_name): r.failures for r in checks if r.relation in dict(S.NOT_NULL_COLUMNS)}
    rows = {r.relation: r.rows for r in seen.collect()}
    assert rows["fact"] == sum(r.rows for r in QS.row_counts(rels, QS.layer_rows(rels, FIXTURE)).collect() if r.layer == "fact")


def test_views_prune_partitions_and_columns(spark):
    db = MQ.published_views(spark, SF001)
    p = plan(spark.sql(f"SELECT borough, sum(sale_price) AS v FROM {db}.v_dated_sales WHERE sale_year = 1999 GROUP BY borough"))
    block = p[p.index("fact_transactions"):]
    assert "(sale_year" in block and "= 1999)" in block and "GreaterThanOrEqual(date_key,1997-01-01)" in block
    assert "ReadSchema: struct<date_key:date,location_key:string,sale_price:bigint>" in block
    names = {r.viewName for r in spark.sql(f"SHOW VIEWS IN {db}").collect()}
    assert {v for _, v in MQ.VIEWS} <= names


@pytest.mark.parametrize("buckets", [8, 128])
def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, buckets):
    st, db = P.star(spark, SF001, FIXTURE), f"t_{uuid.uuid4().hex[:8]}"
    hot = V.bucket_star(spark, st, db, str(tmp_path / "b"), buckets)
    assert (len(hot) > 0) == (buckets == 128) and len(hot) < buckets
    rows = V.bucketed_rows(spark, db, hot, ["transaction_key"], ["borough"], FIXTURE)
    p = plan(rows)
    assert "SortMergeJoin" in p and "Exchange hashpartitioning" not in p and "Bucketed: true" in p
    want = st.fact.select("transaction_key", "location_key").join(st.dim_location.select("location_key", "borough"), "location_key")
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, want.select(rows.columns).collect()), key=str)


def test_calendar_filters_prune_years_at_run_time(spark):
    st = P.star(spark, SF001, FIXTURE)
    weekend = F.col("is_weekend") & (F.col("year_quarter") == "1999-Q1")
    assert "dynamicpruning" in plan(V.calendar_slice(st, weekend))
    small = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        assert "might_contain" in plan(V.calendar_slice(st, weekend, "NATION_3"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_sql_functions_are_native(spark):
    p = plan(E.queries()["q_sql_surrogate_key"](spark, SF001)) + plan(E.queries()["q_sql_date_spine"](spark, SF001))
    assert "md5(" in p and "explode(sequence(" in p and "Python" not in p and "NestedLoop" not in p


def test_listing_has_new_files_only(spark, tmp_path):
    (tmp_path / "pp-2021.csv").write_text(line(1, 1))
    base = str(tmp_path / "wh")
    assert L.pending(spark, str(tmp_path / "pp-2021.csv"), base).count() == 1
    time.sleep(0.01)
    assert L.history(spark, base).count() == 0
