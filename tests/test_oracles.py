"""Every registered query against its SQL, rows and column types."""

import pytest
from oracle import SF_DIR, compare, database

import __spark_entry__
from lakewright.workloads.registry import QUERIES


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, db, name):
    assert name in __spark_entry__.queries() and name in __spark_entry__.oracle_sql()
    assert compare(spark, db, name, SF_DIR) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1
