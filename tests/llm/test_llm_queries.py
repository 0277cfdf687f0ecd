"""Queries with SQL against it, on whole tables; entry points."""

import compare
import pytest

import __spark_entry__ as entry

WITH_SQL = [n for n in entry.oracle_sql() if n.startswith("op")]


@pytest.mark.parametrize("name", WITH_SQL)
def test_query(spark, data, name):
    con = compare.database(data)
    assert compare.check(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], data) == ""


def test_all_operators_are_there():
    names = entry.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
