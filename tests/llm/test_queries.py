"""Registered queries that SQL can express, against their SQL."""

import pytest

from crossmap.llm import queries
from tests.compare import compare, database
from tests.llm import data


@pytest.fixture(scope="module")
def con():
    return database(data.SMALL)


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.REGISTERED) == list(range(1, 14))


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, queries.REGISTERED[name], queries.ORACLE[name], data.SMALL) == ""
