"""Plan-shape checks: what the optimizer must do for these plans to hold at scale."""

import os
import re

import pytest

from conftest import SF001
from estatespark import catalog as E
from estatespark.config import FIXTURE
from estatespark.plans import kpi as K
from estatespark.plans import layers as P


def plan(df) -> str:
    """The formatted physical plan (what ``df.explain("formatted")`` prints)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_no_python(spark, name):
    if name in ("q_ingest_stream", "q_lake_inventory"):
        pytest.skip("file listing / streaming")
    p = plan(E.queries()[name](spark, SF001))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "PythonUDF"):
        assert bad not in p, f"{name}: {bad}"


def scans(text: str, table: str) -> int:
    """Scans of a written table in a formatted plan."""
    return sum(1 for block in text.split("\n\n") if "Scan parquet" in block and f"/{table}" in block)


def outline(text: str) -> str:
    """The plan's tree: the final one where the query has run."""
    text = text.split("== Final Plan ==")[-1].split("== Initial Plan ==")[0]
    return text.split("\n\n\n")[0]


def shuffles(text: str) -> int:
    return len(re.findall(r"[+:]- (?:ReusedExchange|Exchange) \(", outline(text)))


# shuffles that each KPI's table takes behind the scan of the fact, without its presentation sort
KPIS = [(K.borough_price_trends, 2), (lambda st: K.yoy_table(K.yearly_borough_prices(st)), 3), (K.roi_table, 2),
        (K.postcode_stats, 2), (K.undervalued_table, 3), (K.yearly_market, 3)]


@pytest.mark.parametrize("kpi,exchanges", KPIS, ids=["trends", "yoy", "roi", "postcodes", "undervalued", "market"])
def test_medians_scan_the_fact_once_behind_two_shuffles(spark, kpi, exchanges):
    """The third one is a window over aggregated rows (yoy, undervalued) or over the locations (market)."""
    p = plan(kpi(P.star(spark, SF001, FIXTURE)))
    assert scans(p, "fact_transactions") == 1 and shuffles(p) == exchanges
    assert "percentile(sale_price" in p and "Expand" not in p and "collect_set" not in p


@pytest.mark.parametrize("name", ["q_investment_matrix", "q_borough_growth_ranking", "q_type_consistency"])
def test_reports_are_unsorted(spark, name):
    assert "rangepartitioning" not in plan(E.queries()[name](spark, SF001))


def test_growth_spread_reads_the_fact_once(spark):
    df = E.queries()["q_growth_spread"](spark, SF001)
    df.collect()
    tree = outline(plan(df))
    assert tree.count("ReusedExchange") >= 1
    assert len(re.findall(r"Scan parquet", tree)) <= 3  # the fact and two dimensions


def test_kpi_joins_dimensions_map_side_and_prunes_years(spark):
    p = plan(E.queries()["q_undervalued_postcodes"](spark, SF001))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "PartitionFilters: [isnotnull(sale_year" in p and ">= 1999" in p


def test_fact_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["q_market_health"](spark, SF001))
    block = p[p.index("fact_transactions"):]
    block = block[:block.index("ReadSchema")+200]
    assert "ReadSchema: struct<date_key:date,location_key:string,sale_price:bigint,is_central" in block
    assert "PartitionFilters: [isnotnull(sale_year" in block
    assert "GreaterThanOrEqual(date_key,1997-01-01)" in block


@pytest.mark.parametrize("name,raw,fact", [("q_dq_unique", 1, 1), ("q_dq_not_null", 1, 1),
                                           ("q_dq_accepted_values", 1, 0), ("q_dq_row_counts", 1, 1)])
def test_quality_suite_reads_each_source_once(spark, name, raw, fact):
    p = plan(E.queries()[name](spark, SF001))
    assert (scans(p, "raw_sales"), scans(p, "fact_transactions")) == (raw, fact)


def test_frequency_tables_scan_once_and_sort(spark):
    df = E.queries()["q_value_counts"](spark, SF001)
    assert plan(df).count("FileScan csv") + plan(df).count("Scan csv") <= 2  # outline and details
    rows = [(r.column_name, -r.n) for r in df.collect()]
    assert rows == sorted(rows)


def test_star_is_built_without_a_copy_of_the_flagged_rows(spark):
    from estatespark.plans import layers
    from estatespark.session import shared_dir
    assert layers.star(spark, SF001).fact.count() > 0
    assert not os.path.exists(f"{shared_dir(spark)}/estatespark/flagged")
