"""Every registered query equals its SQL on the same tables."""

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.01"
QUERIES, ORACLES = registry.QUERIES, entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert name in ORACLES, "every query has SQL"
    assert compare(df, con, ORACLES[name]) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
