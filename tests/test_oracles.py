"""Every registered query against its DuckDB oracle."""

import pytest

import __spark_entry__ as entry
from catalog.oracle import ORACLES
from catalog.queries import QUERIES
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
