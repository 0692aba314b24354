"""Snapshots, deletes, upserts, appends, joins to calendars and ranges."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions.masking import mask_columns
from lakewright.operators import calendar, changes, ranges
from lakewright.operators.commands import apply_delete_commands
from lakewright.plans import jobs
from lakewright.plans.catalog import create_table_if_absent, register_external
from lakewright.session import scratch_path
from lakewright.sinks.file_rewrites import delete_keys_in_files, write_keyed
from lakewright.sinks.ledger import append_once, load_ledger
from lakewright.sinks.tables import insert_by_position, write_partitioned, write_table
from lakewright.sources.commands import read_delete_commands
from lakewright.sources.lake import read_table
from lakewright.workloads.registry import query, table
from lakewright.workloads.staging import DATABASE, dated_tree, fresh_table, with_ingestion_date


@query("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type IS DISTINCT FROM 'error'
""")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return changes.latest_snapshot(events, ["user_id"], ["ts", "event_id"], "event_type", "error")


@query("""
    SELECT * FROM customer
    WHERE NOT coalesce(CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal < 0 END, false)
""")
def delete_by_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown_for_some = F.when(F.col("c_mktsegment") == "MACHINERY", None).otherwise(F.col("c_acctbal") < 0)
    return changes.delete_where(table(spark, sf_dir, "customer"), unknown_for_some)


@query("""
    SELECT * FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'MACHINERY')
""")
def delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'")
    keys = customer.select(F.col("c_custkey").alias("o_custkey"))
    return changes.delete_keys(table(spark, sf_dir, "orders"), keys, ["o_custkey"])


@query("""
    SELECT o_orderkey, sha256(CAST(o_custkey AS VARCHAR)) AS o_custkey, 'dummy_value' AS o_orderstatus,
           CAST(NULL AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)
""")
def anonymise_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    subjects = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    masks = {"o_custkey": "sha256", "o_orderstatus": "constant", "o_totalprice": "null"}
    return changes.anonymise_subjects(table(spark, sf_dir, "orders"), subjects, ["o_custkey"], masks)


_UPSERT_SQL = """
    WITH source AS (
        SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey,
                          o_totalprice * 2 AS o_totalprice)
        FROM orders WHERE o_orderstatus IN ('F', 'P'))
    SELECT * FROM source
    UNION ALL
    SELECT * FROM orders t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
"""


def _staged_orders(orders: DataFrame) -> DataFrame:
    """Finished orders come again at twice the price, pending ones as new orders."""
    new_key = F.when(F.col("o_orderstatus") == "P", -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    staged = orders.where(F.col("o_orderstatus").isin("F", "P"))
    return staged.withColumns({"o_orderkey": new_key, "o_totalprice": F.col("o_totalprice") * 2})


@query(_UPSERT_SQL)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return changes.upsert(orders, _staged_orders(orders), ["o_orderkey"])


@query(_UPSERT_SQL)
def upsert_through_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    root, staging = scratch_path(spark, "upserted"), scratch_path(spark, "staging")
    return read_table(spark, jobs.upsert_through_staging(orders, _staged_orders(orders), ["o_orderkey"], root, staging))


@query("""
    WITH source AS (SELECT user_id, ts, event_id, event_type, value + 1000 AS value, props FROM events WHERE event_type = 'purchase'),
         newest AS (SELECT * FROM source QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT event_id, ts, user_id, event_type, value, props FROM newest
    UNION ALL
    SELECT * FROM events WHERE user_id NOT IN (SELECT user_id FROM newest)
""")
def merge_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several source rows per key: the newest one is merged."""
    events = table(spark, sf_dir, "events")
    source = events.where("event_type = 'purchase'").withColumn("value", F.col("value") + 1000)
    return changes.upsert(events, source, ["user_id"], newest_by=["ts", "event_id"])


@query("""
    SELECT * FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier
""")
def insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_table(spark, sf_dir, "insert_select")
    customer = table(spark, sf_dir, "customer")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in customer.schema)
    create_table_if_absent(spark, DATABASE, name, columns, scratch_path(spark, "inserted"))
    insert_by_position(customer, f"{DATABASE}.{name}")
    insert_by_position(table(spark, sf_dir, "supplier").withColumn("kind", F.lit("SUPPLIER")), f"{DATABASE}.{name}")
    return spark.table(f"{DATABASE}.{name}")


@query("""
    SELECT day, count(event_id) AS n_rows
    FROM (SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day
          FROM events) LEFT JOIN events ON CAST(ts AS DATE) = day
    GROUP BY day
""")
def date_spine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.rows_per_day(table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date")), "day")


@query("""
    SELECT user_id, day
    FROM (SELECT user_id, CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day
          FROM events GROUP BY user_id) s
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = s.user_id AND CAST(e.ts AS DATE) = s.day)
""")
def missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, the days between the first and the last event on which there is none."""
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return calendar.missing_days(events, "day", ["user_id"])


@query("""
    SELECT c_custkey, c_acctbal, band FROM customer
    JOIN (VALUES ('debt', -1000.0, 0.0), ('small', 0.0, 5000.0), ('large', 5000.0, NULL)) AS b(band, lo, hi)
      ON (lo IS NULL OR c_acctbal >= lo) AND (hi IS NULL OR c_acctbal < hi)
""")
def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = spark.createDataFrame(
        [("debt", -1000.0, 0.0, "[)"), ("small", 0.0, 5000.0, "[)"), ("large", 5000.0, None, "[)")],
        "band string, lower double, upper double, bounds string",
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return ranges.range_join(customer, bands, "c_acctbal").select("c_custkey", "c_acctbal", "band")


_BLOCKS_SQL = """
    SELECT o_orderkey, c_custkey FROM orders JOIN customer
      ON o_orderkey >= c_custkey * 10 AND
         CASE WHEN c_acctbal < 0 THEN o_orderkey <= c_custkey * 10 + c_nationkey ELSE o_orderkey < c_custkey * 10 + c_nationkey END
"""


def _blocks(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    first = F.col("c_custkey") * 10
    blocks = customer.select(
        "c_custkey",
        first.alias("lower"),
        (first + F.col("c_nationkey")).alias("upper"),
        F.when(F.col("c_acctbal") < 0, "[]").otherwise("[)").alias("bounds"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return ranges.range_join(orders, blocks, "o_orderkey", **options).select("o_orderkey", "c_custkey")


@query(_BLOCKS_SQL)
def range_join_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping blocks of order numbers, as many as there are customers; some closed at the end."""
    return _blocks(spark, sf_dir)


@query(_BLOCKS_SQL)
def range_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the way taken when the ranges are too large to broadcast."""
    return _blocks(spark, sf_dir, broadcast_bytes=0)


_SUBJECTS_SQL = "SELECT c_custkey FROM customer WHERE c_nationkey = 7"


@query(f"""
    SELECT * FROM events WHERE user_id NOT IN ({_SUBJECTS_SQL})
    UNION ALL
    SELECT event_id, ts, NULL, event_type, value, sha256(props) FROM events
    WHERE user_id IN ({_SUBJECTS_SQL}) AND CAST(ts AS DATE) = DATE '2024-01-15'
""")
def ddr_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete the subjects' rows; add back, anonymised, those exported for the previous day."""
    events = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer")
    subjects = customer.where("c_nationkey = 7").select(F.col("c_custkey").alias("user_id"))
    kept = changes.matching_keys(events, subjects, ["user_id"], keep=True)
    exported = mask_columns(kept, {"user_id": "null", "props": "sha256"}).withColumn("day", F.col("ts").cast("date"))
    run = jobs.daily_delete_and_append(
        events,
        scratch_path(spark, "ddr"),
        dated_tree(spark, exported, "ddr-append", "day"),
        dt.date(2024, 1, 16),
        delete=lambda rows: changes.delete_keys(rows, subjects, ["user_id"]),
        on_delete_error="fail",
        append_fmt="parquet",
    )
    return read_table(spark, run.version)


def _dated_table(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, DataFrame]:
    """Events as an external table with a partition for each day: its name, and its rows."""
    events = with_ingestion_date(table(spark, sf_dir, "events"))
    name, location = fresh_table(spark, sf_dir, label), scratch_path(spark, label)
    write_partitioned(events, location, ("ingestion_date",))
    register_external(spark, events, DATABASE, name, location, partition_by=("ingestion_date",))
    full_name = f"{DATABASE}.{name}"
    return full_name, spark.table(full_name).select(*events.columns)


_DATED_SUBJECTS = f"SELECT event_id FROM events WHERE user_id IN ({_SUBJECTS_SQL}) AND CAST(ts AS DATE) < DATE '2024-01-10'"


@query(f"""
    SELECT *, CAST(ts AS DATE) AS ingestion_date FROM events WHERE event_id NOT IN ({_DATED_SUBJECTS})
    UNION ALL
    SELECT event_id, ts, NULL, event_type, value, sha256(props), CAST(ts AS DATE) FROM events
    WHERE user_id IN ({_SUBJECTS_SQL}) AND CAST(ts AS DATE) = DATE '2024-01-15'
""")
def ddr_daily_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job on a partitioned table, read back through the catalog: only days that lose rows are rewritten."""
    name, events = _dated_table(spark, sf_dir, "ddr_partitioned")
    customer = table(spark, sf_dir, "customer")
    subjects = customer.where("c_nationkey = 7").select(F.col("c_custkey").alias("user_id"))
    listed = changes.matching_keys(events, subjects, ["user_id"], keep=True)
    exported = mask_columns(listed, {"user_id": "null", "props": "sha256"}).withColumn("day", F.col("ts").cast("date"))
    # The export is written before the job runs, as it would be by another one.
    exports = dated_tree(spark, exported, "ddr-append", "day")
    gone = listed.where("ingestion_date < DATE '2024-01-10'").select("event_id")
    jobs.daily_delete_and_append(
        events,
        scratch_path(spark, "ddr-partitions"),
        exports,
        dt.date(2024, 1, 16),
        delete=lambda rows: changes.delete_keys(rows, gone, ["event_id"]),
        on_delete_error="fail",
        append_fmt="parquet",
        table=name,
    )
    return spark.table(name)


@query("""
    SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'click' AND user_id % 50 = 1 THEN value * 2 ELSE value END AS value,
           props, CAST(ts AS DATE) AS ingestion_date FROM events
    UNION ALL
    SELECT -1 - event_id, ts, user_id, event_type, value * 2, props, CAST(ts AS DATE) FROM events
    WHERE event_type = 'error' AND user_id % 50 = 1
""")
def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert into a partitioned table, read back through the catalog."""
    name, events = _dated_table(spark, sf_dir, "upsert_partitioned")
    changed = events.where("event_type IN ('click', 'error') AND user_id % 50 = 1").withColumns(
        {
            "value": F.col("value") * 2,
            "event_id": F.when(F.col("event_type") == "error", -1 - F.col("event_id")).otherwise(F.col("event_id")),
        }
    )
    root, staging = scratch_path(spark, "upserted-partitions"), scratch_path(spark, "staging")
    jobs.upsert_through_staging(events, changed, ["event_id"], root, staging, table=name)
    return spark.table(name)


@query("""
    SELECT * FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'MACHINERY')
""")
def delete_by_key_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same delete by the way taken when the keys are too many to broadcast."""
    customer = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'")
    keys = customer.select(F.col("c_custkey").alias("o_custkey"))
    return changes.delete_keys(table(spark, sf_dir, "orders"), keys, ["o_custkey"], broadcast_bytes=0)


@query("""
    SELECT s_suppkey, c_custkey FROM supplier JOIN customer
      ON s_acctbal >= c_acctbal + 9000 AND (c_nationkey >= 3 OR s_acctbal < c_acctbal + 9010)
""")
def range_join_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many ranges as there are customers, most of them without an end."""
    first = F.col("c_acctbal") + 9000
    ranges_ = table(spark, sf_dir, "customer").select(
        "c_custkey",
        first.alias("lower"),
        F.when(F.col("c_nationkey") < 3, F.col("c_acctbal") + 9010).alias("upper"),
        F.when(first.isNotNull(), "[)").alias("bounds"),  # without a beginning here there is no range
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return ranges.range_join(supplier, ranges_, "s_acctbal", broadcast_bytes=0).select("s_suppkey", "c_custkey")


@query("SELECT * FROM customer WHERE NOT coalesce(c_acctbal < 0, false) UNION ALL SELECT * FROM customer")
def repeated_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending rows that are already there adds them again."""
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "appended-twice")
    write_table(changes.delete_where(customer, F.col("c_acctbal") < 0), path)
    return changes.append_by_position(read_table(spark, path), customer)


@query("""
    SELECT * FROM events
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = 7 AND c_custkey = user_id)
      AND NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = 9 AND c_custkey = user_id AND event_type = 'click')
      AND NOT EXISTS (SELECT 1 FROM nation WHERE n_regionkey < 3 AND value BETWEEN n_nationkey * 4 AND n_nationkey * 4 + 0.5)
      AND NOT EXISTS (SELECT 1 FROM nation WHERE n_regionkey >= 3 AND event_type = 'error' AND user_id = n_nationkey * 5)
""")
def delete_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of commands for several tables: many key deletes by one and by two columns, and some by ranges."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    statements = [
        (customer.where("c_nationkey = 7"), "DELETE FROM lake.events WHERE user_id = %d", ["c_custkey"]),
        (customer.where("c_nationkey = 8"), "DELETE FROM lake.orders WHERE user_id = %d", ["c_custkey"]),
        (customer.where("c_nationkey = 9"), "DELETE FROM events\n WHERE event_type = 'click' AND user_id = %d", ["c_custkey"]),
        (nation.where("n_regionkey < 3"), "delete from `events` e where e.value between %d and %d.5", ["n_nationkey * 4", "n_nationkey * 4"]),
        (nation.where("n_regionkey >= 3"), "DELETE FROM events WHERE NOT event_type <> 'error' AND user_id IN (%d)", ["n_nationkey * 5"]),
    ]
    lines = [rows.select(F.format_string(text, *map(F.expr, columns)).alias("value")) for rows, text, columns in statements]
    path = scratch_path(spark, "commands")
    reduce(DataFrame.unionByName, lines).write.option("lineSep", ";\n").text(path)
    return apply_delete_commands(table(spark, sf_dir, "events"), read_delete_commands(spark, path), "lake.events")


@query(f"""
    SELECT *, CAST(ts AS DATE) AS ingestion_date FROM events
    WHERE NOT EXISTS (SELECT 1 FROM ({_SUBJECTS_SQL}) WHERE c_custkey = user_id)
      AND NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = 9 AND c_custkey = user_id AND event_type = 'view')
""")
def delete_in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deletes, by one key and by two, from files with Bloom filters: only files that hold such rows are written anew."""
    events, customer = with_ingestion_date(table(spark, sf_dir, "events")), table(spark, sf_dir, "customer")
    path = scratch_path(spark, "keyed-files")
    for kind in (F.col("event_type").eqNullSafe("view"), ~F.col("event_type").eqNullSafe("view")):
        write_keyed(events.where(kind), path, ["user_id"], ["ingestion_date"], mode="append")
    subjects = customer.select(F.col("c_custkey").alias("user_id"), F.lit("view").alias("event_type"), "c_nationkey")
    delete_keys_in_files(spark, path, subjects.where("c_nationkey = 7"), ["user_id"], ["ingestion_date"])
    delete_keys_in_files(spark, path, subjects.where("c_nationkey = 9"), ["user_id", "event_type"], ["ingestion_date"])
    return spark.read.schema(events.schema).parquet(path)


def _ledgered(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A table of the first days' events, to which later ones are loaded, one load twice: its name, and the ledger."""
    name, events = _dated_table(spark, sf_dir, "ledgered")
    ledger, staging = scratch_path(spark, "ledger"), scratch_path(spark, "ledger-staging")
    later = events.withColumns({"event_id": -1 - F.col("event_id"), "ingestion_date": F.date_add("ingestion_date", 15)})
    for load_id in ("clicks", "views", "clicks"):
        append_once(later.where(F.col("event_type") == load_id[:-1]), name, load_id, ledger, staging)
    return name, ledger


@query("""
    SELECT *, CAST(ts AS DATE) AS ingestion_date FROM events
    UNION ALL
    SELECT * REPLACE (-1 - event_id AS event_id), CAST(CAST(ts AS DATE) + INTERVAL 15 DAY AS DATE) FROM events WHERE event_type IN ('click', 'view')
""")
def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of two loads, into partitions that are there and partitions that are not."""
    return spark.table(_ledgered(spark, sf_dir)[0])


@query("""
    SELECT event_type || 's' AS load_id, 'done' AS state, count(*) AS n_rows FROM events
    WHERE event_type IN ('click', 'view') GROUP BY event_type
""")
def ledger_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger has on those loads."""
    return load_ledger(spark, _ledgered(spark, sf_dir)[1]).select("load_id", "state", "n_rows")
