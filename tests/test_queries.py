"""Every registered query runs; those with SQL give DuckDB's rows."""

import pytest

import __spark_entry__ as entry_module
from compare import compare, connect
from ferrolite.plans.registry import ENTRIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query(spark, con, sf, name):
    result = compare(spark, con, ENTRIES[name], sf)
    assert result.startswith(("ok", "rows=")), result


def test_contract(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).count() == 1
