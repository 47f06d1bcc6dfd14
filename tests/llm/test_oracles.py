"""Text queries beside their SQL on the smallest tables."""

import pytest
from check_oracles import connect, difference
from conftest import SMALL

from tierwise.llm.oracles import ORACLES
from tierwise.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None


def test_queries_without_sql_give_a_row_per_document(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, SMALL).count() == n, name
