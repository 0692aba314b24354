"""Projections, filters and per-row functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions.dates import date_path as path_of_day
from lakewright.functions.dates import date_range as days_between
from lakewright.functions.dates import date_text, in_previous_day
from lakewright.functions.manifest import manifest_delete_query, manifest_envelope, manifest_file
from lakewright.functions.tagged import decode_tagged
from lakewright.functions.text import snake_case as to_snake_case
from lakewright.operators.columns import allow, consumer_view, deny
from lakewright.operators.columns import project_by_type as text_columns
from lakewright.plans.jobs import consumer_extract as extract_for_consumer
from lakewright.plans.jobs import dummy_copy
from lakewright.session import scratch_path
from lakewright.sources.lake import read_table
from lakewright.workloads.registry import query, table, table_path

# Consumer A may read two columns; B may not read four of them, C five.
CONSUMERS = {
    "A": allow("event_id", "ts"),
    "B": deny("event_id", "ts", "user_id", "event_type"),
    "C": deny("event_id", "ts", "user_id", "event_type", "value"),
}
EXTRACT = deny("user_id", "props")


@query("SELECT c_name, c_mktsegment FROM customer")
def project_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_columns(table(spark, sf_dir, "customer"), "string")


def _visible(spark: SparkSession, sf_dir: str, consumer: str) -> DataFrame:
    view = f"secure_view_{consumer}"
    consumer_view(table(spark, sf_dir, "events"), CONSUMERS, consumer, view)
    return spark.table(view)


@query("SELECT event_id, ts FROM events")
def secure_view_allow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visible(spark, sf_dir, "A")


@query("SELECT * EXCLUDE (event_id, ts, user_id, event_type) FROM events")
def secure_view_deny(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visible(spark, sf_dir, "B")


@query("SELECT * EXCLUDE (event_id, ts, user_id, event_type, value) FROM events")
def secure_view_deny_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visible(spark, sf_dir, "C")


@query("SELECT * EXCLUDE (user_id, props) FROM events ORDER BY event_id LIMIT 10")
def consumer_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = scratch_path(spark, "extract")
    return extract_for_consumer(table(spark, sf_dir, "events"), EXTRACT, output, order_by=["event_id"])


@query("SELECT *, '2024-01-15' AS day FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def previous_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.where(in_previous_day(F.col("ts"), dt.date(2024, 1, 16))).withColumn("day", date_text("ts"))


@query("""
    SELECT c_custkey, 'dummy_value' AS c_name, CAST(0 AS INTEGER) AS c_nationkey, c_acctbal,
           'dummy_value' AS c_mktsegment
    FROM customer
""")
def dummy_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "dummy")
    dummy_copy(spark, table_path(sf_dir, "customer"), target)
    return read_table(spark, target)


@query("""
    SELECT event_id, 'exports/' || strftime(ts, '%Y/%m/%d') || '/' || event_type || '.csv' AS target_key FROM events
""")
def date_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("event_type", F.lit(".csv"))
    return table(spark, sf_dir, "events").select("event_id", path_of_day("exports", F.col("ts"), name).alias("target_key"))


@query("""
    SELECT identifier, lower(regexp_replace(regexp_replace(identifier,
               '([^\\n])([A-Z][a-z]+)', '\\1_\\2', 'g'), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS snake
    FROM (SELECT event_type || 'HTTPResponse' || upper(event_type[1]) || event_type[2:] || 'ID'
                 || CAST(user_id AS VARCHAR) || 'Key' AS identifier FROM events)
""")
def snake_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    identifiers = table(spark, sf_dir, "events").select(
        F.concat(
            "event_type", F.lit("HTTPResponse"), F.initcap("event_type"), F.lit("ID"), "user_id", F.lit("Key")
        ).alias("identifier")
    )
    return identifiers.select("identifier", to_snake_case(F.col("identifier")).alias("snake"))


@query("""
    SELECT o_orderkey, CAST(unnest(generate_series(least(a, b), greatest(a, b), INTERVAL 1 DAY)) AS DATE) AS day
    FROM (SELECT o_orderkey, o_orderdate AS a, o_orderdate + to_days(CAST(o_custkey % 7 - 3 AS INTEGER)) AS b
          FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW'))
""")
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds come in both orders; urgent orders lack one and low ones have one that is too short."""
    bounds = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        date_text("o_orderdate").alias("from_date"),
        F.expr("""CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '5-LOW' THEN '2024-01'
                  ELSE date_format(date_add(o_orderdate, CAST(o_custkey % 7 - 3 AS INT)), 'yyyy-MM-dd') END""").alias("to_date"),
    )
    return bounds.select("o_orderkey", F.explode(days_between(F.col("from_date"), F.col("to_date"))).alias("day"))


_ENTRY_SQL = """
    SELECT event_id, CASE event_type WHEN 'click' THEN props WHEN 'view' THEN props || '@@@' || user_id || '@@@more'
           ELSE props || '@@@' || user_id END AS entry FROM events
"""


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.expr("""CASE event_type WHEN 'click' THEN props WHEN 'view' THEN concat(props, '@@@', user_id, '@@@more')
                    ELSE concat(props, '@@@', user_id) END""")
    return table(spark, sf_dir, "events").select("event_id", key.alias("entry"), "event_type", "user_id")


@query(f"""
    SELECT event_id, string_split(entry, '@@@')[1] AS file, string_split(entry, '@@@')[2] AS delete_query
    FROM ({_ENTRY_SQL})
""")
def manifest_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.col("entry")
    return _entries(spark, sf_dir).select(
        "event_id", manifest_file(entry).alias("file"), manifest_delete_query(entry).alias("delete_query")
    )


@query(f"""
    WITH listed AS (
        SELECT e.event_id, CASE e.event_type WHEN 'error' THEN [] WHEN 'view' THEN [entry, e.event_type] ELSE [entry] END AS files,
               CASE WHEN e.event_type = 'purchase' THEN '{{"late":1}}' ELSE '0' END AS errors
        FROM events e JOIN ({_ENTRY_SQL}) USING (event_id))
    SELECT event_id, 'done' AS execution, len(files) AS n_records, true AS triggered, errors, CASE errors WHEN '0' THEN 'number' ELSE 'object' END AS errors_type, CAST(NULL AS VARCHAR) AS bucket,
           CAST(NULL AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS delete_query FROM listed WHERE len(files) = 0
    UNION ALL
    SELECT event_id, 'done', len(files), true, errors, CASE errors WHEN '0' THEN 'number' ELSE 'object' END, 'landing', string_split(file, '@@@')[1], string_split(file, '@@@')[2]
    FROM listed, unnest(files) AS u(file)
""")
def manifest_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per event, with no, one or two files, flattened to its records."""
    files = F.expr("CASE event_type WHEN 'error' THEN array() WHEN 'view' THEN array(entry, event_type) ELSE array(entry) END")
    errors = F.when(F.col("event_type") == "purchase", '{"late":1}')
    packed = _entries(spark, sf_dir).select(
        "event_id", manifest_envelope(files.cast("array<string>"), "landing", errors=errors).alias("envelope")
    )
    record = F.explode_outer("envelope.Records").alias("record")
    return packed.select("event_id", "envelope", record).select(
        "event_id",
        F.col("envelope.data.execution").alias("execution"),
        F.size("envelope.Records").cast("bigint").alias("n_records"),
        F.col("envelope.StepFunctionTriggered").alias("triggered"),
        F.to_json("envelope.Errors").alias("errors"),
        F.when(F.schema_of_variant("envelope.Errors") == "BIGINT", "number").otherwise("object").alias("errors_type"),
        F.col("record.s3.bucket.name").alias("bucket"),
        F.col("record.s3.object.key").alias("key"),
        F.col("record.s3.delete_query").alias("delete_query"),
    )


@query("""
    SELECT event_id, event_type AS kind, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id, value,
           user_id > 50 AS regular, CAST(NULL AS VARCHAR) AS unknown, props AS last_cell
    FROM events
""")
def tagged_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null cell, and a cell without any known tag, each keep their place."""

    def cell(tag: str, value: str) -> str:
        types = {"stringValue": "string", "longValue": "bigint", "doubleValue": "double", "booleanValue": "boolean", "isNull": "boolean"}
        return "struct(" + ", ".join(f"CAST({value if t == tag else 'NULL'} AS {types[t]}) AS {t}" for t in types) + ")"

    cells = ", ".join(
        [
            cell("stringValue", "event_type"),
            "CASE WHEN event_type = 'error' THEN " + cell("isNull", "true") + " ELSE " + cell("longValue", "user_id") + " END",
            cell("doubleValue", "value"),
            cell("booleanValue", "user_id > 50"),
            cell("blobValue", "event_type"),
            cell("stringValue", "props"),
        ]
    )
    records = table(spark, sf_dir, "events").select("event_id", F.expr(f"array({cells})").alias("record"))
    keys = ["kind", "user_id", "value", "regular", "unknown", "last_cell"]
    return decode_tagged(records, "record", keys, {"user_id": "bigint", "value": "double", "regular": "boolean"})
