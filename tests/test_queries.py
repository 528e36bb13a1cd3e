"""Every registered query of the engine against its SQL, and the entry point."""

import pytest

import __spark_entry__
from conftest import compare
from webloom.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    got, want = compare(spark, small, QUERIES[name], ORACLES[name])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["word", "keys"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
