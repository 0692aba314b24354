"""The registered queries on tables with a hot key in a third of the rows and NULLs in most columns.

Nothing is broadcast here, the scans are cut into many tasks and the session is not in UTC.
"""

import glob
import os

import duckdb
import pytest
from oracle import SF_DIR, compare, database

import __spark_entry__  # noqa: F401  (registers the queries)
from lakewright.operators.keyed_joins import BROADCAST_SETTING
from lakewright.workloads.registry import QUERIES

SKEWED = {
    "events": """
        SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id,
               CASE WHEN event_id % 11 > 0 THEN event_type END AS event_type, CASE WHEN event_id % 13 > 0 THEN value END AS value,
               CASE WHEN event_id % 17 > 0 THEN props END AS props FROM source
        UNION ALL SELECT * REPLACE (event_id + 20000 AS event_id, ts - INTERVAL 100 DAY AS ts) FROM source WHERE event_id < 50
    """,
    "orders": """
        SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 77 ELSE o_custkey END AS o_custkey,
                          CASE WHEN o_orderkey % 7 > 0 THEN o_orderstatus END AS o_orderstatus,
                          CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS o_totalprice) FROM source
    """,
    "customer": """
        SELECT * REPLACE (CASE WHEN c_custkey % 9 > 0 THEN c_name END AS c_name,
                          CASE WHEN c_custkey % 4 = 0 THEN 42.5 WHEN c_custkey % 19 > 0 THEN c_acctbal END AS c_acctbal,
                          CASE WHEN c_custkey % 6 > 0 THEN c_mktsegment END AS c_mktsegment) FROM source
    """,
}


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE OR REPLACE VIEW source AS SELECT * FROM '{path}'")
        connection.execute(f"COPY ({SKEWED.get(name, 'SELECT * FROM source')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.fixture(scope="module")
def db(skewed_dir):
    return database(skewed_dir)


@pytest.fixture
def hard_session(spark):
    settings = {
        BROADCAST_SETTING: "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.session.timeZone": "America/Los_Angeles",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(hard_session, skewed_dir, db, name):
    assert compare(hard_session, db, name, skewed_dir) is None
