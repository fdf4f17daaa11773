import pytest

from contestry.llm import queries
from tests.oracle import agree


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    agree(spark, queries.QUERIES[name], queries.ORACLE[name])
