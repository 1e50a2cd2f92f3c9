"""Every registered query against its SQL twin."""

import pytest

from clicklake import registry
from oracle_check import compare, connect

pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(registry.REGISTRY))
def test_query_equals_sql(spark, sf, db, name):
    query, sql = registry.REGISTRY[name]
    assert sql is not None
    assert compare(spark, db, name, query, sql, sf) is None


def test_entry(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["short_code", "total_clicks"] and out.count() == 10
    assert registry.queries().keys() == registry.oracle_sql().keys() <= entry.queries().keys()
