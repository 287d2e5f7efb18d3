"""Beyond the broadcast bound the same plans run as shuffle joins, with equal results."""

from estatespark.config import FIXTURE
from estatespark.plans import kpi as K
from estatespark.plans import layers as P
from estatespark.plans import models as M
from estatespark.plans.star import Star
from conftest import SF001


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_enrichment_without_broadcast(spark):
    stg, bor = P.stg(spark, SF001), P.boroughs(spark, SF001)
    big = M.enriched(stg, bor, FIXTURE)
    tiny = M.enriched(stg, bor, FIXTURE.with_(broadcast_max_rows=0))
    assert "BroadcastHashJoin" in plan(big)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(tiny)
        assert rows(big.select("transaction_id", "borough")) == rows(tiny.select("transaction_id", "borough"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_kpis_without_broadcast(spark):
    base = P.star(spark, SF001, FIXTURE)
    no_bc = Star(**{**base.__dict__, "cfg": FIXTURE.with_(broadcast_max_rows=0)})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(K.market_health(no_bc))
        for fn in (K.market_health, K.undervalued_postcodes, K.property_type_roi):
            assert rows(fn(base)) == rows(fn(no_bc)), fn.__name__
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
