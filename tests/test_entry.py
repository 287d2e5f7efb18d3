import sys

from conftest import ROOT, SF0001


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert [r.year for r in df.collect()] == [1997, 1998, 1999, 2000]
    assert df.columns[:2] == ["year", "total_transactions"]


def test_every_query_has_an_oracle():
    from estatespark import catalog
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"q_lake_files"}  # its paths are Spark's own


def test_lake_totals_add_up(spark):
    import __spark_entry__ as E
    rows = E.queries()["q_lake_inventory"](spark, SF0001).collect()
    total = [r.size_bytes for r in rows if r.is_total]
    assert total == [sum(r.size_bytes for r in rows if not r.is_total)] and len(rows) == 8


def test_core_queries_stay_without_a_package_of_the_corpus_operators():
    """A missing package costs the corpus queries only."""
    import subprocess
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as E; " \
           "q = E.queries(); print('q_market_health' in q, 'op7_languages' in q)"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert out.stdout.split() == ["True", "False"]
