import sys, os
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
"""Every suite query against its DuckDB oracle (the driver's correctness gate)."""

import os

import pytest

from oracle_compare import compare, duck
from __spark_entry__ import entry, oracle_sql, queries
from sluice.plans import suite

SF_DIR = os.environ.get("SLUICE_TEST_SF", "/root/testdata/sf0.01")
QUERIES = {k: v for k, v in queries().items() if k in suite.REGISTRY}
SQL = oracle_sql()


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_type", "season", "min_mean", "max_mean", "amplitude", "min_hour", "max_hour"]


def test_every_key_has_oracle():
    assert not set(QUERIES) - set(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    rel = con.execute(SQL[name])
    ok, msg = compare(rows, df.columns, rel.fetchall(), [c[0] for c in rel.description])
    assert ok, msg
