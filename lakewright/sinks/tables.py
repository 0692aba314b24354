"""Table writes. A table that is being read is never overwritten in place: see ``publish``."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright import storage
from lakewright.session import sql_text
from lakewright.sinks.swaps import folder_values, partition_folders, partition_locations, swap_partitions, unfinished_swaps

PARTITION_COLUMN = "ingestion_date"


def clustered_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one partition value together, so each value gets few files.

    A rebalance, unlike a plain repartition, lets Spark cut a value with too many rows into
    several tasks and merge values with few.
    """
    return df.hint("rebalance", *columns)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (PARTITION_COLUMN,),
    fmt: str = "parquet",
    overwrite: str = "static",
    clustered: bool = False,
) -> None:
    """Overwrite the table at ``path``, one directory per partition value.

    ``static`` clears the whole target. ``dynamic`` replaces only the partitions that occur in the
    frame, but those entirely. Pass ``clustered=True`` when the input already groups the values,
    which saves the shuffle.
    """
    if overwrite not in ("static", "dynamic"):
        raise ValueError(f"overwrite must be 'static' or 'dynamic', not {overwrite!r}")
    rows = df if clustered else clustered_by(df, *partition_by)
    (
        rows.write.format(fmt)
        .partitionBy(*partition_by)
        .option("partitionOverwriteMode", overwrite)
        .mode("overwrite")
        .save(path)
    )


def refuse_overlap(source: str, target: str) -> None:
    """Raise if a target that is to be overwritten is the source, lies in it or holds it.

    Of a source with wildcards the part before the first one counts.
    """
    fixed = re.split(r"[*?\[{]", source)[0] if re.search(r"[*?\[{]", source) else f"{source.rstrip('/')}/"
    one, two = (re.sub(r"^file:/*(?=/)", "", re.sub(r"/+", "/", p)) for p in (fixed, f"{target.rstrip('/')}/"))
    if one.startswith(two) or two.startswith(one.rpartition("/")[0] + "/"):
        raise ValueError(f"cannot overwrite {target!r} while reading {source!r}: write beside it, or publish a version")


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").save(path)


def new_version(root: str, whole: bool = True) -> str:
    """A folder for a version of a table, or (``whole`` is off) for new files of some of its partitions."""
    return f"{root.rstrip('/')}/{'v' if whole else 'p'}{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def publish(
    df: DataFrame, root: str, table: str | None = None, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> str:
    """Write a new version of a table under ``root``; readers move to it only once it is complete.

    With ``table`` the catalog entry is pointed at the new version, which is partitioned as the entry is; the entry's
    partitions move with it. Without one, ``partition_by`` names the partition columns. Returns the version's path.
    """
    spark, version = df.sparkSession, new_version(root)
    columns = partition_columns(spark, table) if table else list(partition_by)
    rows = clustered_by(df, *columns) if columns else df
    rows.write.format(fmt).mode("errorifexists").partitionBy(*columns).save(version)
    if table:
        point_at(spark, table, version, columns)
    return version


def point_at(spark: SparkSession, table: str, version: str, partition_by: Sequence[str]) -> None:
    """Let a catalog entry serve the files of a version.

    Partition entries have places of their own: each moves in one step, see ``swap_partitions``, and those that the version
    does not have go last.
    """
    columns = list(partition_by)
    if columns:
        _require_external(spark, table)
        folders = partition_folders(spark, version, len(columns))
        moves = dict.fromkeys(partition_locations(spark, table, columns)) | {folder_values(f): f"{version}/{f}" for f in folders}
        swap_partitions(spark, table, columns, version.rpartition("/")[0], moves)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {sql_text(version)}")
    spark.catalog.refreshTable(table)
    served = spark.table(table).select(F.col("_metadata.file_path").alias("path")).limit(1).collect()
    if served and version.split(":", 1)[-1].strip("/") not in served[0]["path"]:
        raise RuntimeError(f"{table} does not serve {version} but {served[0]['path']}")


def _require_external(spark: SparkSession, table: str) -> None:
    """Dropping a partition of a managed table would delete its files, which may be all there is of a version."""
    kind = spark.catalog.getTable(table).tableType
    if kind != "EXTERNAL":
        raise ValueError(f"{table} is {kind}; only an external table's partitions can move to a new version")


def remove_old_versions(spark: SparkSession, root: str, keep: str, table: str | None = None) -> list[str]:
    """Delete the versions under ``root`` that are older than ``keep``, on request; returns their paths.

    A version that a partition of ``table``, or the table itself, still lies in stays. Once single partitions have been replaced,
    versions of any age may be in use, so the table must be named; while a swap is unfinished, nothing is deleted.
    """
    found = [e for e in storage.entries(spark, root) if e.is_folder and re.fullmatch(r"[vp]\d{8}T\d{6}-[0-9a-f]{8}", e.name)]
    if table is None and any(e.name.startswith("p") for e in found):
        raise ValueError(f"partitions have been replaced under {root}: name the table, whose partitions say which versions are in use")
    if unfinished_swaps(spark, root):
        raise RuntimeError(f"a swap of partitions under {root} is unfinished; see finish_swaps")
    used = _locations(spark, table) if table else []
    newest = keep.rstrip("/").rsplit("/", 1)[-1][1:16]
    old = [e for e in found if e.name[1:16] < newest and not any(storage.lies_in(place, e.path) for place in used)]
    for entry in old:
        storage.remove(spark, entry.path)
    return [entry.path for entry in old]


def _locations(spark: SparkSession, table: str) -> list[str]:
    """Where the catalog says that files of a table are."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    columns = partition_columns(spark, table)
    return [row["data_type"] for row in described] + (list(partition_locations(spark, table, columns).values()) if columns else [])


def replace_partitions(
    table: str, rows: DataFrame, touched: DataFrame, root: str, fmt: str = "parquet"
) -> str:
    """Let new rows stand in the place of the touched partitions of a catalog table; no other file is written or read.

    ``touched`` lists partition values; a touched partition without new rows goes. The new files lie in a version of
    their own under ``root``. Returns its path.
    """
    spark, version = rows.sparkSession, new_version(root, whole=False)
    columns = partition_columns(spark, table)
    _require_external(spark, table)
    clustered_by(rows, *columns).write.format(fmt).mode("errorifexists").partitionBy(*columns).save(version)
    none = F.lit("__HIVE_DEFAULT_PARTITION__")  # fixed value: Spark's folder for a NULL, and for an empty text
    texts = (F.coalesce(F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")), none).alias(c) for c in columns)
    gone = {tuple(row) for row in touched.select(*texts).distinct().collect()}  # partitions, not rows
    folders = partition_folders(spark, version, len(columns))
    swap_partitions(spark, table, columns, root, dict.fromkeys(gone) | {folder_values(f): f"{version}/{f}" for f in folders})
    return version


def insert_by_position(df: DataFrame, table: str) -> None:
    df.write.insertInto(table)


def staging_directory(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/tmp/date={day.isoformat()}"


def append_through_staging(df: DataFrame, table: str, staging_root: str, day: dt.date) -> str:
    """Write to a staging directory of the day as Parquet, then append those files' rows to the table.

    The rows are computed once, whatever the append has to repeat. Rows are never deduplicated.
    """
    spark = df.sparkSession
    staged = f"{staging_directory(staging_root, day)}/{uuid.uuid4().hex}"
    write_table(df, staged)
    insert_by_position(spark.read.schema(df.schema).parquet(staged), table)
    return staged


def clear_staging(spark: SparkSession, staged: str) -> None:
    """Drop the staged rows but keep the directory and its schema."""
    write_table(spark.createDataFrame([], spark.read.parquet(staged).schema), staged)


def refresh_path(spark: SparkSession, path: str) -> None:
    spark.catalog.refreshByPath(path)


def refresh_table(spark: SparkSession, table: str) -> None:
    spark.catalog.refreshTable(table)


def write_date_paths(df: DataFrame, root: str, day: Column, fmt: str = "parquet", mode: str = "append") -> None:
    """Files by day under ``root/YYYY/MM/DD``. Rows without a day are an error: no path is theirs.

    Spark writes all days at once, each to a folder named after its column; the files are then renamed into their places, which
    moves no data. ``append`` puts them beside the files that a day has; ``overwrite`` removes those, once the new ones are there.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    spark, written = df.sparkSession, f"{root.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    named = F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.raise_error(F.lit("a row has no day")).cast("string"))
    write_partitioned(df.withColumn("__day", named), written, ("__day",), fmt)
    for folder in partition_folders(spark, written, 1):
        target = f"{root.rstrip('/')}/{folder.removeprefix('__day=').replace('-', '/')}"
        before = storage.data_files(spark, target) if mode == "overwrite" else []
        for name in storage.data_files(spark, f"{written}/{folder}"):
            storage.move(spark, f"{written}/{folder}/{name}", f"{target}/{name}")
        for name in before:
            storage.remove(spark, f"{target}/{name}")
    storage.remove(spark, written)
