"""Bulk loads and round trips through files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.operators.changes import append_by_name, project_to
from lakewright.session import scratch_path
from lakewright.sinks.tables import write_partitioned, write_table
from lakewright.sinks.text import write_csv
from lakewright.sources.loads import (
    CheckedLoad,
    checked_csv_load,
    errors_of_load,
    load_by_name,
    load_csv,
    load_files,
    load_parquet_as_json,
    newest_errors,
)
from lakewright.workloads.registry import query, table


@query("""
    SELECT event_id, value,
           CAST(to_json([event_type, CAST(user_id AS VARCHAR)]) AS VARCHAR) AS labels,
           CAST(to_json([event_id, user_id]) AS VARCHAR) AS ids,
           CAST(to_json({'user_id': user_id, 'kind': event_type}) AS VARCHAR) AS head
    FROM events
""")
def copy_parquet_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        "value",
        F.array("event_type", F.col("user_id").cast("string")).alias("labels"),
        F.array("event_id", "user_id").alias("ids"),
        F.struct("user_id", F.col("event_type").alias("kind")).alias("head"),
        F.col("ts").cast("date").alias("date"),
    )
    root = scratch_path(spark, "nested")
    write_partitioned(nested, root, ("date",))
    return load_parquet_as_json(spark, root)


@query("""
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
    UNION ALL BY NAME
    SELECT c_nationkey AS s_nationkey, c_name AS s_name, c_custkey AS s_suppkey, NULL AS s_acctbal FROM customer
""")
def copy_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming files have their columns in another order, one too many and one too few."""
    target = table(spark, sf_dir, "supplier")
    incoming = table(spark, sf_dir, "customer").select(
        "c_mktsegment",
        F.col("c_nationkey").alias("s_nationkey"),
        F.col("c_name").alias("s_name"),
        F.col("c_custkey").alias("s_suppkey"),
    )
    path = scratch_path(spark, "by-name")
    write_table(incoming, path)
    return append_by_name(target, load_by_name(spark, path, target, "parquet"))


@query("SELECT * FROM orders")
def csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), scratch_path(spark, "csv-load")
    write_csv(orders, path)
    return load_csv(spark, path, orders.schema)


@query("""
    SELECT event_id, ts, user_id, event_type, props,
           CASE WHEN event_type <> 'error' THEN value END AS value
    FROM events
""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes and commas in the text, microseconds and NULLs survive."""
    events = table(spark, sf_dir, "events").withColumn("value", F.expr("CASE WHEN event_type <> 'error' THEN value END"))
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(events, path)
    return load_csv(spark, path, events.schema)


@query("SELECT * FROM customer")
def load_with_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, path = table(spark, sf_dir, "customer"), scratch_path(spark, "json")
    customer.write.json(path)
    loaded = load_files(spark, path, "json", {"mode": "FAILFAST"}, customer.schema)
    return project_to(loaded, customer)


def _dirty_load(spark: SparkSession, sf_dir: str, staging: str | None = None, one_file: bool = False) -> CheckedLoad:
    """Events as CSV in which error events have no numeric value."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.concat(F.when(F.col("event_type") == "error", "x").otherwise(""), F.col("value")).alias("value"),
    )
    path = scratch_path(spark, "dirty")
    # In one file lines have numbers that SQL can tell: those of the ids in their order.
    write_csv(events.orderBy("event_id").coalesce(1) if one_file else events, path)
    schema = T.StructType().add("event_id", "long").add("event_type", "string").add("value", "double")
    return checked_csv_load(
        spark, path, schema, "events", 16, dt.datetime(2024, 4, 6, 3), {"event_type": 6}, staging=staging
    )


@query("""
    SELECT CAST(16 AS BIGINT) AS query_id, TIMESTAMP '2024-04-06 03:00:00' AS start_time, 'events' AS table_name,
           'value' AS column_name, 'double' AS column_type, 'x' || CAST(value AS VARCHAR) AS raw_value,
           'invalid value' AS error_message, line_number
    FROM (SELECT *, row_number() OVER (ORDER BY event_id) + 1 AS line_number FROM events) WHERE event_type = 'error' AND value IS NOT NULL
    UNION ALL
    SELECT 16, TIMESTAMP '2024-04-06 03:00:00', 'events', 'event_type', 'string', event_type, 'value too long', line_number
    FROM (SELECT *, row_number() OVER (ORDER BY event_id) + 1 AS line_number FROM events) WHERE length(event_type) > 6
""")
def load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged, as the sort reads its input twice: to find its ranges, and to sort. The first line of the file is its header."""
    load = _dirty_load(spark, sf_dir, scratch_path(spark, "checked"), one_file=True)
    return newest_errors(errors_of_load(load.errors, 16)).drop("file_name")


@query("""
    SELECT CAST(16 AS BIGINT) AS query_id, TIMESTAMP '2024-04-06 03:00:00' AS start_time, 'events' AS table_name,
           count(*) FILTER (WHERE NOT bad) AS loaded_rows, count(*) FILTER (WHERE bad) AS error_rows,
           count(*) FILTER (WHERE bad) AS error_count,
           CASE WHEN bool_or(bad) THEN 'completed with errors' ELSE 'completed' END AS status
    FROM (SELECT coalesce(event_type = 'error' AND value IS NOT NULL OR length(event_type) > 6, false) AS bad FROM events)
""")
def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty_load(spark, sf_dir).history


@query("""
    SELECT event_id, event_type, value FROM events
    WHERE NOT coalesce(event_type = 'error' AND value IS NOT NULL OR length(event_type) > 6, false)
""")
def checked_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty_load(spark, sf_dir).rows


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 = 1 THEN NULL ELSE text END AS text, lang, source, n_chars FROM documents")
def csv_documents_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, quotes and blanks at their ends, empty ones and NULLs, in files that still split."""
    documents = table(spark, sf_dir, "documents").withColumn(
        "text", F.expr("CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 = 1 THEN NULL ELSE text END")
    )
    path = scratch_path(spark, "csv-documents")
    write_csv(documents, path)
    return load_csv(spark, path, documents.schema)


@query("""
    SELECT CAST(17 AS BIGINT) AS query_id, TIMESTAMP '2024-04-06 03:00:00' AS start_time, 'documents' AS table_name,
           count(*) AS loaded_rows, CAST(0 AS BIGINT) AS error_rows, CAST(0 AS BIGINT) AS error_count, 'completed' AS status
    FROM documents
""")
def checked_documents_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No line break in a text makes an error."""
    documents, path = table(spark, sf_dir, "documents"), scratch_path(spark, "checked-documents")
    write_csv(documents, path)
    return checked_csv_load(spark, path, documents.schema, "documents", 17, dt.datetime(2024, 4, 6, 3)).history
