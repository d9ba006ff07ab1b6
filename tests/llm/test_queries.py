"""Every text query with SQL against its twin; the others have files of their own."""

import pytest

from cellwatch.llm.queries import QUERIES, SQL
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF), QUERIES[name], SQL[name], SF) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
