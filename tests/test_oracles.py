"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import pytest

from matchstats.plans.compare import compare, duck_connection
from matchstats.plans.registry import all_queries
from tests.conftest import SF0001

REG = all_queries()
WITH_SQL = sorted(n for n, (_f, sql) in REG.items() if sql is not None)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF0001)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, con, name):
    fn, sql = REG[name]
    r = compare(spark, name, fn, sql, SF0001, con)
    assert r["status"] == "OK", r


def test_entry_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert "full_features" in o
