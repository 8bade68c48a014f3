"""The queries that SQL can say, against DuckDB on the smallest tables."""

import os

import pytest

from factloom.llm import queries
from tests.test_oracles import DIR, duck, rows  # noqa: F401


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, duck, name):  # noqa: F811
    got = queries.QUERIES[name](spark, DIR)
    want = duck.sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())
