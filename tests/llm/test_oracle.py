"""The queries that SQL can express, against it."""

import pytest

from tarnbeck.llm import queries

from ..helpers import rows_of, sql_rows


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, duck, sf_dir, name):
    assert rows_of(queries.QUERIES[name](spark, sf_dir)) == sql_rows(duck, queries.ORACLE_SQL[name])


def test_all_ten_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
