"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from emporia.plans import registry
from emporia.plans.oracle_check import compare
from tests.conftest import SF_SMALL

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = compare(df, duck, ORACLE[name])
    assert res["ok"], res


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["category", "total_revenue", "orders", "avg_order_value"]
