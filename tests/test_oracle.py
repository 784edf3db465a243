"""Every registered query against its DuckDB statement on the smoke tables."""

import pytest

from __spark_entry__ import entry
from lienlake.catalog import all_oracle_sql, all_queries
from tests.oracle_harness import compare, duck_connect

SF = "/root/testdata/sf0.001"
KEYS = sorted(all_queries())


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF)


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["loan_id", "customer_id", "outstanding", "drawing_power", "shortfall_amount", "ltv_pct"]
    assert len(rows) > 0


def test_every_query_has_an_oracle():
    assert set(KEYS) - set(all_oracle_sql()) == set()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    info = compare(spark, duck, key, all_queries()[key], all_oracle_sql().get(key), SF)
    assert info["status"] in ("OK", "rows-only"), info
