"""Column metadata as frames, and tables in the catalog."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions.warehouse_types import catalog_type
from lakewright.session import sql_text

log = logging.getLogger(__name__)

DISCOVERED_PREFIX = "delta_"  # fixed value: what discovered tables are called


def schema_frame(df: DataFrame) -> DataFrame:
    """(column_name, column_type) of a frame."""
    rows = [(f.name, catalog_type(f.dataType)) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "column_name string, column_type string")


def position_frame(df: DataFrame) -> DataFrame:
    """(column_name, order_index) of a frame."""
    rows = [(name, i) for i, name in enumerate(df.columns)]
    return df.sparkSession.createDataFrame(rows, "column_name string, order_index int")


CATALOG_COLUMNS = "schemaname string, tablename string, columnname string, external_type string, order_index int"


def catalog_columns(spark: SparkSession, database: str, skip_broken: bool = False) -> DataFrame:
    """The columns of every table of a catalog database.

    A table whose schema cannot be read, a view over one that is gone for instance, is an error, or is logged and left out.
    """
    rows = []
    for table in (t for t in spark.catalog.listTables(database) if not t.isTemporary):
        try:
            schema = spark.table(f"`{database}`.`{table.name}`").schema
        except PySparkException:
            if not skip_broken:
                raise
            log.warning("left out %s.%s: its schema cannot be read", database, table.name)
            continue
        rows += [(database, table.name, f.name, catalog_type(f.dataType), i) for i, f in enumerate(schema)]
    return spark.createDataFrame(rows, CATALOG_COLUMNS)


def table_columns(spark: SparkSession, database: str, table: str) -> DataFrame:
    """(column_name, column_type) of one table; no other table of the database is looked at."""
    rows = [(f.name, catalog_type(f.dataType)) for f in spark.table(f"`{database}`.`{table}`").schema]
    return spark.createDataFrame(rows, "column_name string, column_type string")


def lookup_columns(columns: DataFrame, schema_name: str, table_name: str) -> DataFrame:
    """(column_name, column_type) of one table."""
    found = columns.where((F.col("schemaname") == schema_name) & (F.col("tablename") == table_name))
    return found.select(F.col("columnname").alias("column_name"), F.col("external_type").alias("column_type"))


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION {sql_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def _definition(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def create_table_if_absent(
    spark: SparkSession,
    database: str,
    table: str,
    columns: str,
    location: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Create a table, and its database, from column definitions; an existing table of any shape stays."""
    create_database(spark, database)
    where = f" LOCATION {sql_text(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({columns}) USING {fmt}{where}")


def register_external(
    spark: SparkSession,
    df: DataFrame,
    database: str,
    table: str,
    location: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Register the files at ``location`` under the schema of ``df``. Dropping the table keeps the files."""
    create_database(spark, database)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE `{database}`.`{table}` ({_definition(df.schema)}) USING {fmt}{parts} LOCATION {sql_text(location)}"
    )
    _recover_partitions(spark, database, table)


def _recover_partitions(spark: SparkSession, database: str, table: str) -> None:
    name = f"`{database}`.`{table}`"
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def table_name_for(path: str, prefix: str = DISCOVERED_PREFIX) -> str:
    last = path.rstrip("/").rsplit("/", 1)[-1]
    return prefix + re.sub(r"\W", "_", last).lower()


def _plain_path(path: str) -> str:
    return re.sub(r"^file:/*", "/", path.rstrip("/"))


def discover_table(
    spark: SparkSession,
    path: str,
    database: str,
    fmt: str = "parquet",
    prefix: str = DISCOVERED_PREFIX,
    merge_schema: bool = True,
) -> str:
    """Bring the catalog up to date with the files under ``path``; returns the table's full name.

    A new path becomes a table, new columns are added to a known one, new partitions are found. All files
    are looked into for that, in parallel; ``merge_schema=False`` looks at a few, and may miss new columns. Two
    folders of one name would be one table: the second is an error, to be settled by another ``prefix``.
    """
    create_database(spark, database)
    table = table_name_for(path, prefix)
    name = f"`{database}`.`{table}`"
    if not spark.catalog.tableExists(f"{database}.{table}"):
        schema_option = " OPTIONS (mergeSchema 'true')" if merge_schema else ""
        spark.sql(f"CREATE TABLE {name} USING {fmt}{schema_option} LOCATION {sql_text(path)}")
    else:
        known_path = next(r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect() if r["col_name"] == "Location")
        if _plain_path(known_path) != _plain_path(path):
            raise ValueError(f"{name} is the table of {known_path}; give {path} another prefix")
        found = spark.read.format(fmt).option("mergeSchema", str(merge_schema).lower()).load(path).schema
        known = set(spark.table(name).columns)
        added = T.StructType([f for f in found if f.name not in known])
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_definition(added)})")
    _recover_partitions(spark, database, table)
    return name
