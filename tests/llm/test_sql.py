"""The corpus queries that have SQL, rows and column types."""

import pytest
from oracle import SF_DIR, compare, database

import __spark_entry__
from lakewright.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    assert name in __spark_entry__.queries() and name in __spark_entry__.oracle_sql()
    assert compare(spark, database(SF_DIR), name, SF_DIR, queries.QUERIES, queries.ORACLES) is None
