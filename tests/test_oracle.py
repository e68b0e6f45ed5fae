"""Every query of the engine's own operators against its SQL."""

import pytest

from tarnbeck.plans import catalog, oracle

from .helpers import rows_of, sql_rows


def test_each_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, sf_dir, name):
    assert rows_of(catalog.QUERIES[name](spark, sf_dir)) == sql_rows(duck, oracle.SQL[name])
