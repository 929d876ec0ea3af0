"""Registered queries against their SQL, over the smallest test tables."""

import pytest
from arrears.llm import queries


@pytest.mark.parametrize("name", [n for n in queries.oracle_sql() if n != "op1_preference_formatting"])
def test_query_equals_its_sql(spark, tables_dir, duck, name):
    found = queries.queries()[name](spark, tables_dir)
    columns = ", ".join(found.columns)
    expected = duck.sql(f"SELECT {columns} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected) != []
