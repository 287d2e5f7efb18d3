"""Every registered query against its DuckDB oracle at sf0.01 (the correctness gate)."""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], ORACLES[name], SF001)
    assert r["status"] == "OK", r.get("detail")
