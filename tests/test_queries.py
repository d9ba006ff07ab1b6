"""Every registered query on the smallest tables against its SQL twin."""

import os

import pytest

from cellwatch.registry import QUERIES, SQL

from tests.compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    assert difference(spark, tables, QUERIES[name], SQL[name], SF) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
