"""Every query with SQL gives the rows that DuckDB gives; the others give rows and pass their invariants elsewhere."""

import pytest
from conftest import SF
from oracle import differences

from cellgrain.plans import catalogue

SQL = catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert differences(catalogue.queries()[name](spark, SF), con, SQL[name]) == []


def test_every_query_is_named_once():
    assert set(SQL) <= set(catalogue.queries())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1500
    assert set(e.oracle_sql()) <= set(e.queries())
