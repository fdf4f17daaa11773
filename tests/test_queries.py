import pytest

import __spark_entry__ as entry
from contestry.plans import catalog
from tests.oracle import agree


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, name):
    agree(spark, catalog.QUERIES[name], catalog.ORACLE[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
