"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

from shoal.plans.catalog import REGISTRY
from shoal.plans.oracle import SQL
from harness import compare, duck

SF = os.environ.get("SHOAL_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF, REGISTRY[name], SQL.get(name), con)
    if name in SQL:
        assert res["ok"], res
    else:
        assert res["spark_rows"] >= 0


def test_every_query_has_an_oracle():
    assert sorted(set(REGISTRY) - set(SQL)) == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
