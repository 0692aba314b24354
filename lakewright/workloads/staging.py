"""Files and tables that several registered queries derive from the given data."""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.plans.catalog import create_database
from lakewright.session import scratch_path
from lakewright.sinks.tables import write_partitioned
from lakewright.workloads.registry import table

DATABASE = "lakewright"


def with_ingestion_date(events: DataFrame) -> DataFrame:
    return events.withColumn("ingestion_date", F.col("ts").cast("date"))


def dated_tree(spark: SparkSession, rows: DataFrame, label: str, day: str = "ingestion_date") -> str:
    """Rows as Parquet files under ``date=YYYY-MM-DD`` directories, ``day`` kept in the files."""
    root = scratch_path(spark, label)
    write_partitioned(rows.withColumn("date", F.col(day)), root, ("date",))
    return root


def dated_events(spark: SparkSession, sf_dir: str, label: str) -> str:
    return dated_tree(spark, with_ingestion_date(table(spark, sf_dir, "events")), label)


def fresh_table(spark: SparkSession, sf_dir: str, label: str) -> str:
    """A table name of this run, free for a new table, so runs side by side leave each other's tables alone."""
    create_database(spark, DATABASE, scratch_path(spark, "database"))
    return f"{label}_{zlib.crc32(sf_dir.encode()):08x}_{uuid.uuid4().hex[:8]}"
