"""Registered queries against their SQL; the others are checked by brute force in the files beside this one."""

import pytest

import __spark_entry__ as entry
from brisa.llm import queries
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_its_sql(spark, con, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), con, queries.SQL[name]) == ""


def test_every_operator_is_registered():
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
