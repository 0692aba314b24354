"""The recurring jobs, put together from the operators."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions.masking import dummy_values
from lakewright.functions.warehouse_types import spark_column_type
from lakewright.operators.changes import project_to, upsert
from lakewright.operators.columns import ColumnRule, preview
from lakewright.operators.commands import apply_delete_commands
from lakewright.operators.keyed_joins import matching_keys
from lakewright.plans.catalog import create_table_if_absent, register_external
from lakewright.plans.ddl import sized_columns
from lakewright.session import scratch_path
from lakewright.sinks.tables import (
    clear_staging,
    insert_by_position,
    partition_columns,
    publish,
    refuse_overlap,
    replace_partitions,
    write_partitioned,
    write_table,
)
from lakewright.sinks.text import write_csv
from lakewright.sources.commands import existing_delete_file, read_delete_commands
from lakewright.sources.files import dated_directory, existing_directory
from lakewright.sources.lake import glob_scan, read_table
from lakewright.sources.loads import load_by_name, load_csv, nested_to_json

log = logging.getLogger(__name__)


def dummy_copy(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> None:
    """A copy of a table with dummy constants in its text and integer columns."""
    refuse_overlap(source, target)
    write_table(dummy_values(read_table(spark, source, fmt)), target, fmt)


def rebuild_table(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str] = ("ingestion_date",),
    fmt: str = "parquet",
    clustered: bool = False,
) -> None:
    """A partitioned table from the data files of another, whose log is ignored; never in the place of its source."""
    refuse_overlap(source, target)
    write_partitioned(glob_scan(spark, source), target, partition_by, fmt, clustered=clustered)


@dataclass(frozen=True)
class DailyRun:
    """The folder of the new files, None if there was nothing to write; whether rows were deleted or changed, whether rows were
    added; how many partitions were written anew, None where the whole table was or nothing.
    """

    version: str | None
    deleted: bool
    appended: bool
    rewritten: int | None = None


def daily_delete_and_append(
    target: DataFrame,
    root: str,
    append_root: str,
    as_of: dt.date,
    delete: Callable[[DataFrame], DataFrame] | None = None,
    on_delete_error: str = "continue",
    scope: str = "date",
    append_fmt: str = "avro",
    table: str | None = None,
    fmt: str = "parquet",
    delete_root: str | None = None,
    delete_from: str | None = None,
) -> DailyRun:
    """Apply the deletes of the previous day, add its anonymised rows, publish the result.

    Deletes come from a file of commands, ``delete_root/YYYY-MM-DD.sql`` of the previous day if there is one, for the table
    ``delete_from`` or else ``table``; or from a callable, which may also change rows. Nothing is appended when the previous day
    has no files. ``scope="prefix"`` then appends every day under ``append_root`` and not just that one.

    Of a partitioned ``table`` only the partitions whose rows differ after the delete are written anew, and new rows come as further
    files; anything else becomes a whole new version. If the delete changes no row and there is nothing to append, no version
    is left and the table stays as it is. If the delete fails, and ``on_delete_error`` is "continue", the rows stay and the
    append still happens; a write that fails is an error in any case. To tell, the delete is evaluated once, into sums of row hashes by
    partition, before anything is written.
    """
    if on_delete_error not in ("continue", "fail"):
        raise ValueError(f"on_delete_error must be 'continue' or 'fail', not {on_delete_error!r}")
    spark = target.sparkSession
    day = as_of - dt.timedelta(days=1)
    if delete_root is not None:
        if delete is not None or not (delete_from or table):
            raise ValueError("deletes come from a callable or from files, and files need the name of the table")
        listed = existing_delete_file(spark, delete_root, day)
        if listed is not None:
            delete = lambda rows: apply_delete_commands(rows, read_delete_commands(spark, listed), delete_from or table)
    found = existing_directory(spark, append_root, day)
    incoming = None
    if found is not None:
        path = dated_directory(append_root, day) if scope == "date" else append_root
        incoming = project_to(load_by_name(spark, path, target, append_fmt), target)
    columns = partition_columns(spark, table) if table else []

    touched = kept = None
    if delete is not None:
        try:
            kept = delete(target)
            touched = _partitions_that_change(target, kept, columns)
        except Exception:
            if on_delete_error == "fail":
                raise
            log.exception("delete step failed; appending without it")
            touched = None
    changed = 0 if touched is None else touched.count()
    version = None
    if not columns:
        if changed or incoming is not None:
            rows = kept.select(*target.columns) if changed else target
            version = publish(rows if incoming is None else rows.unionByName(incoming), root, table, fmt)
        return DailyRun(version, changed > 0, incoming is not None)
    if changed:
        same = [kept[c].eqNullSafe(touched[c]) for c in columns]
        rest = kept.join(F.broadcast(touched), same, "left_semi").select(*target.columns)
        version = replace_partitions(table, rest, touched, root, fmt)
    if incoming is not None:
        insert_by_position(incoming.select(*spark.table(table).columns), table)
        spark.catalog.refreshTable(table)
    return DailyRun(version, changed > 0, incoming is not None, changed)


def _row_hash(df: DataFrame) -> Column:
    """A hash of all values of a row, wide enough to be summed over any number of rows."""
    plain = (F.to_json(F.col(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema)
    return F.xxhash64(*plain).cast("decimal(38, 0)")


def _changes(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Of every group of rows, how many there are more after than before, and what their hashes sum to."""
    signed = [
        df.select(*(F.col(f"`{c}`") for c in columns), F.lit(sign).alias("_n"), (sign * _row_hash(df)).cast("decimal(38, 0)").alias("_hash"))
        for df, sign in ((after.select(*before.columns), 1), (before, -1))
    ]
    return signed[0].unionByName(signed[1]).groupBy(*columns).agg(F.sum("_n").alias("_n"), F.sum("_hash").alias("_hash")).where("_n <> 0 OR _hash <> 0")


def _partitions_that_change(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The partitions whose rows differ, written to the shared folder; there are at most as many rows as partitions.

    A table without partitions counts as one, with a row if it differs.
    """
    spark = before.sparkSession
    changed = _changes(before, after, columns).select(*columns or [F.lit(1).alias("one")])
    path = scratch_path(spark, "touched")
    changed.write.parquet(path)
    return spark.read.schema(changed.schema).parquet(path)


def upsert_through_staging(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    root: str,
    staging: str,
    newest_by: Sequence[str] | None = None,
    table: str | None = None,
    fmt: str = "parquet",
) -> str:
    """Stage the source as Parquet, merge it into the target, publish, empty the staging area.

    Of a partitioned ``table`` only partitions that hold a row of a staged key, or get one, are written anew.
    """
    spark = target.sparkSession
    write_table(source, staging)
    staged = spark.read.schema(source.schema).parquet(staging)
    columns = partition_columns(spark, table) if table else []
    if columns:
        lost = matching_keys(target, staged, on, keep=True).select(*columns)
        path = scratch_path(spark, "touched")
        lost.union(staged.select(*columns)).distinct().write.parquet(path)
        touched = spark.read.schema(lost.schema).parquet(path)
        same = [target[c].eqNullSafe(touched[c]) for c in columns]
        version = replace_partitions(table, upsert(target.join(F.broadcast(touched), same, "left_semi"), staged, on, newest_by), touched, root, fmt)
    else:
        version = publish(upsert(target, staged, on, newest_by), root, table, fmt)
    clear_staging(spark, staging)
    return version


def size_and_load(df: DataFrame, database: str, table: str, location: str | None = None, **measure) -> None:
    """Measure the text columns, create the table with those sizes if it is absent, insert the rows.

    Only the column list reaches the driver. ``measure`` takes the options of ``sized_columns``; with ``extended=True``
    a ``bigint`` or ``decimal`` keeps its type. Values are cast to the warehouse type of their column;
    nested ones become JSON text.
    """
    spark = df.sparkSession
    typed = {r["column_name"]: spark_column_type(r["warehouse_type"]) for r in sized_columns(df, **measure).collect()}
    definitions = ", ".join(f"`{name}` {typed[name]}" for name in df.columns)
    create_table_if_absent(spark, database, table, definitions, location)
    loadable = nested_to_json(df).select(*(F.col(f"`{name}`").cast(_insertable(typed[name])).alias(name) for name in df.columns))
    insert_by_position(loadable, f"`{database}`.`{table}`")


def _insertable(spark_type: str) -> str:
    # The table's own length check reports text that is too long; a cast would not.
    return "string" if spark_type.startswith("VARCHAR") else spark_type


def consumer_extract(
    df: DataFrame, rule: ColumnRule, output: str, rows: int = 10, order_by: Sequence[str] = ()
) -> DataFrame:
    """The first rows of what a consumer may see, as CSV files under ``output``; returns what is there."""
    extract = preview(rule.apply(df), rows, order_by)
    write_csv(extract, output)
    return load_csv(df.sparkSession, output, extract.schema)


def register_lake_table(
    spark: SparkSession, path: str, database: str, table: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Register a lake table in a catalog under its own format, and read it back from there.

    ``partition_by`` names the columns that the folders under ``path`` stand for: queries then list only theirs.
    """
    register_external(spark, read_table(spark, path, fmt), database, table, path, fmt, partition_by)
    return spark.table(f"`{database}`.`{table}`")
