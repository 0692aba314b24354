"""Column metadata, measured lengths, warehouse types and DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions.warehouse_types import fixed_type, sized_type
from lakewright.operators.sizing import enriched_columns as enrich
from lakewright.operators.sizing import max_text_length as measure
from lakewright.plans.catalog import position_frame, register_external, schema_frame, table_columns
from lakewright.plans.ddl import fixed_ddl, sized_ddl
from lakewright.plans.jobs import size_and_load as measured_load
from lakewright.plans.measures import table_measures, update_measures
from lakewright.session import scratch_path
from lakewright.workloads.registry import query, table, table_path
from lakewright.sinks.tables import insert_by_position, write_partitioned
from lakewright.workloads.staging import DATABASE, fresh_table, with_ingestion_date


def _grown(measured: str) -> str:
    return f"CAST(round_even(coalesce({measured}, 255) + coalesce({measured}, 255) * 20.0 / 100, 0) AS INTEGER)"


@query(f"""
    SELECT 'customer' AS table_name, 'c_name' AS column_name, {_grown("max(length(c_name))")} AS max_length FROM customer
    UNION ALL SELECT 'customer', 'c_mktsegment', {_grown("max(length(c_mktsegment))")} FROM customer
    UNION ALL SELECT 'customer', 'nothing', 306
    UNION ALL SELECT 'orders', 'o_orderstatus', {_grown("max(length(o_orderstatus))")} FROM orders
    UNION ALL SELECT 'orders', 'o_orderpriority', {_grown("max(length(o_orderpriority))")} FROM orders
    UNION ALL SELECT 'documents', 'text', {_grown("max(length(text))")} FROM documents
    UNION ALL SELECT 'documents', 'lang', {_grown("max(length(lang))")} FROM documents
    UNION ALL SELECT 'documents', 'source', {_grown("max(length(source))")} FROM documents
""")
def max_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables, one of them with a text column that has no value."""
    frames = {name: table(spark, sf_dir, name) for name in ("customer", "orders", "documents")}
    frames["customer"] = frames["customer"].withColumn("nothing", F.lit(None).cast("string"))
    measured = [measure(df).select(F.lit(name).alias("table_name"), "*") for name, df in frames.items()]
    return measured[0].unionByName(measured[1]).unionByName(measured[2])


@query(f"SELECT 'text' AS column_name, {_grown('max(strlen(text))')} AS max_length FROM documents")
def max_text_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(table(spark, sf_dir, "documents"), ["text"], unit="bytes")


@query(f"""
    SELECT column_name, column_type, CASE column_name WHEN 'event_type' THEN kinds WHEN 'props' THEN texts END AS max_length
    FROM (VALUES ('event_id', 'bigint'), ('ts', 'timestamp'), ('user_id', 'bigint'), ('event_type', 'string'),
                 ('value', 'double'), ('props', 'string')) AS c(column_name, column_type),
         (SELECT {_grown("max(length(event_type))")} AS kinds, {_grown("max(length(props))")} AS texts FROM events)
""")
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table's columns, looked up by its name alone, with the lengths in its data."""
    events, name = table(spark, sf_dir, "events"), fresh_table(spark, sf_dir, "catalog_columns")
    register_external(spark, events, DATABASE, name, table_path(sf_dir, "events"))
    columns = table_columns(spark, DATABASE, name)
    return columns.join(measure(spark.table(f"{DATABASE}.{name}")), "column_name", "left")


@query(f"""
    SELECT column_name, column_type, CASE column_name WHEN 'c_name' THEN names WHEN 'c_mktsegment' THEN segments END AS max_length,
           CAST(order_index AS INTEGER) AS order_index
    FROM (VALUES ('dropped', 'string', NULL), ('c_custkey', 'bigint', 0), ('c_name', 'string', 1), ('c_nationkey', 'int', 2),
                 ('c_acctbal', 'double', 3), ('c_mktsegment', 'string', 4)) AS c(column_name, column_type, order_index),
         (SELECT {_grown("max(length(c_name))")} AS names, {_grown("max(length(c_mktsegment))")} AS segments FROM customer)
""")
def enriched_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog still lists a column that the files no longer have."""
    customer = table(spark, sf_dir, "customer")
    listed = schema_frame(customer.withColumn("dropped", F.lit("")))
    return enrich(listed, measure(customer), position_frame(customer))


# A catalog listing that grows with the data: every part is a column, forty of them a table.
CATALOG_TYPES = [
    "string", "int", "timestamp", "boolean", "double", "double precision", "array<string>", "string_list", "bigint",
    "float", "decimal(10,2)", "date", "map<string,int>", "struct<a:int>", "integer",
]

_LISTING_SQL = f"""
    SELECT 't' || CAST(p_partkey // 40 AS VARCHAR) AS table_name, 'c' || CAST(p_partkey AS VARCHAR) AS column_name,
           {CATALOG_TYPES}[1 + p_partkey % {len(CATALOG_TYPES)}] AS column_type,
           CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 7 = 0 THEN 0 ELSE p_size END AS max_length,
           p_partkey % 40 AS order_index
    FROM part
"""


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = F.array(*map(F.lit, CATALOG_TYPES))
    size = F.expr("CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 7 = 0 THEN 0 ELSE p_size END")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("t"), F.expr("p_partkey div 40")).alias("table_name"),
        F.concat(F.lit("c"), "p_partkey").alias("column_name"),
        F.get(types, (F.col("p_partkey") % len(CATALOG_TYPES)).cast("int")).alias("column_type"),
        size.alias("max_length"),
        (F.col("p_partkey") % 40).alias("order_index"),
    )


_SIZED_SQL = """
    CASE WHEN starts_with(column_type, 'string')
              THEN CASE WHEN max_length > 0 THEN 'VARCHAR(' || CAST(max_length AS VARCHAR) || ')' ELSE 'VARCHAR(255)' END
         WHEN column_type = 'int' THEN 'INTEGER' WHEN column_type = 'timestamp' THEN 'TIMESTAMP'
         WHEN column_type = 'boolean' THEN 'BOOLEAN' WHEN starts_with(column_type, 'double') THEN 'DOUBLE PRECISION'
         WHEN starts_with(column_type, 'array') THEN 'SUPER' ELSE 'VARCHAR(255)' END
"""
_FIXED_SQL = """
    CASE WHEN column_type = 'int' THEN 'INTEGER' WHEN column_type = 'timestamp' THEN 'TIMESTAMP'
         WHEN column_type = 'boolean' THEN 'BOOLEAN' WHEN starts_with(column_type, 'double') THEN 'DOUBLE PRECISION'
         WHEN starts_with(column_type, 'array') THEN 'SUPER' ELSE 'VARCHAR(65535)' END
"""


@query(f"SELECT column_name, column_type, max_length, {_SIZED_SQL} AS warehouse_type FROM ({_LISTING_SQL})")
def type_map_sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = sized_type(F.col("column_type"), F.col("max_length")).alias("warehouse_type")
    return _listing(spark, sf_dir).select("column_name", "column_type", "max_length", mapped)


@query(f"SELECT column_name, column_type, {_FIXED_SQL} AS warehouse_type FROM ({_LISTING_SQL})")
def type_map_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = fixed_type(F.col("column_type")).alias("warehouse_type")
    return _listing(spark, sf_dir).select("column_name", "column_type", mapped)


@query(f"""
    SELECT 'CREATE SCHEMA IF NOT EXISTS ingest;' || chr(10) || 'CREATE TABLE IF NOT EXISTS ingest.orders (' || chr(10)
           || 'o_orderkey VARCHAR(255),' || chr(10) || 'o_custkey VARCHAR(255),' || chr(10)
           || 'o_orderstatus VARCHAR(' || {_grown("max(length(o_orderstatus))")} || '),' || chr(10)
           || 'o_totalprice DOUBLE PRECISION,' || chr(10) || 'o_orderdate TIMESTAMP,' || chr(10)
           || 'o_orderpriority VARCHAR(' || {_grown("max(length(o_orderpriority))")} || ')' || chr(10) || ');' AS ddl
    FROM orders
""")
def warehouse_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sized_ddl(table(spark, sf_dir, "orders"), "ingest", "orders")


@query(f"""
    SELECT table_name, 'CREATE SCHEMA IF NOT EXISTS internal;' || chr(10) || 'CREATE TABLE IF NOT EXISTS internal.'
           || table_name || ' (' || chr(10)
           || string_agg(column_name || ' ' || {_FIXED_SQL}, ', ' ORDER BY order_index) || chr(10) || ');' AS ddl
    FROM ({_LISTING_SQL}) GROUP BY table_name
""")
def warehouse_ddl_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed_ddl(_listing(spark, sf_dir), "internal")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
           CAST(to_json([c_name, c_mktsegment]) AS VARCHAR) AS labels
    FROM customer
""")
def size_and_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_table(spark, sf_dir, "size_and_load")
    customer = table(spark, sf_dir, "customer").withColumn("labels", F.array("c_name", "c_mktsegment"))
    measured_load(customer, DATABASE, name, scratch_path(spark, "loaded"))
    return spark.table(f"{DATABASE}.{name}")


@query(f"""
    SELECT 'event_type' AS column_name, count(*) AS n_rows, count(event_type) AS n_values, {_grown("max(length(event_type))")} AS max_length FROM events
    UNION ALL SELECT 'props', count(*), count(props), {_grown("max(length(props))")} FROM events
""")
def incremental_sizing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of a table that grows in three steps, by new partitions and by rows in old ones; each step reads what is new."""
    events = with_ingestion_date(table(spark, sf_dir, "events"))
    name, location, store = fresh_table(spark, sf_dir, "incremental_sizing"), scratch_path(spark, "grown"), scratch_path(spark, "measures")
    half = F.coalesce(F.dayofmonth("ingestion_date") < 15, F.lit(False))
    clicks = F.coalesce(F.col("event_type") == "click", F.lit(False))
    write_partitioned(events.where(clicks & half), location)
    register_external(spark, events, DATABASE, name, location, partition_by=("ingestion_date",))
    full_name = f"{DATABASE}.{name}"
    update_measures(spark, full_name, store)
    for step in (clicks & ~half, ~clicks):
        insert_by_position(events.where(step), full_name)
        spark.catalog.refreshTable(full_name)
        update_measures(spark, full_name, store)
    return table_measures(spark, full_name, store).drop("lengths")
