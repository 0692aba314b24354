"""Loads that happen once, however often they are run: a ledger of load ids, and files that are moved into a table.

A load stages its rows, notes that in the ledger with the list of its files, moves those files into the table under names that follow
from the load's id, and notes that it is done. Run again after a crash at any point, it goes on where it stopped: rows are not computed
again once they are staged, and a file that is in its place already is not moved twice.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright import storage
from lakewright.session import sql_text
from lakewright.sinks.swaps import folder_values, partition_locations
from lakewright.sinks.tables import partition_columns

ENTRY = "load_id string, table_name string, state string, at timestamp, staged string, files array<string>, n_rows bigint"


@dataclass(frozen=True)
class Load:
    """What became of a load: whether this run finished it or found it done, and how many rows it has."""

    load_id: str
    finished_now: bool
    n_rows: int


def _entry(ledger: str, load_id: str, table: str, state: str) -> str:
    name = hashlib.sha256(json.dumps([table, load_id]).encode()).hexdigest()
    return f"{ledger.rstrip('/')}/{name}.{state}.json"


def append_once(df: DataFrame, table: str, load_id: str, ledger: str, staging_root: str, fmt: str = "parquet") -> Load:
    """Append the rows of ``df``, by position, to a catalog table over files, unless the load ``load_id`` of that table is done.

    A load that was interrupted is finished with the rows it staged then, not with those of ``df``. Two runs of one load at the
    same time end in an error of the later one. ``staging_root`` must lie in the store of the table, as files are renamed. Partitions
    that the table lacks are added.
    """
    spark = df.sparkSession
    noted, done = (_entry(ledger, load_id, table, state) for state in ("staged", "done"))
    if storage.exists(spark, done):
        return Load(load_id, False, json.loads(storage.read_text(spark, done))["n_rows"])
    columns = partition_columns(spark, table)
    if not storage.exists(spark, noted):
        _stage(df, table, load_id, f"{staging_root.rstrip('/')}/{uuid.uuid4().hex}", columns, noted, fmt)
    entry = json.loads(storage.read_text(spark, noted))
    _move_into(spark, table, columns, entry)
    spark.catalog.refreshTable(table)
    storage.write_text(spark, done, json.dumps(entry | {"state": "done", "at": _now()}))
    storage.remove(spark, entry["staged"])
    return Load(load_id, True, entry["n_rows"])


def _now() -> str:
    return dt.datetime.now(dt.UTC).isoformat()


def _stage(df: DataFrame, table: str, load_id: str, staged: str, columns: list[str], noted: str, fmt: str) -> None:
    spark = df.sparkSession
    target = spark.table(table).schema
    if len(df.columns) != len(target):
        raise ValueError(f"{table} has {len(target)} columns, the rows {len(df.columns)}")
    rows = df.toDF(*target.names).select(*(F.col(f"`{f.name}`").cast(f.dataType) for f in target))
    rows.write.format(fmt).partitionBy(*columns).save(staged)
    count = spark.read.format(fmt).schema(target).load(staged).count()
    entry = {"load_id": load_id, "table_name": table, "state": "staged", "at": _now(), "staged": staged}
    storage.write_text(spark, noted, json.dumps(entry | {"files": storage.data_files(spark, staged), "n_rows": count}))


def _move_into(spark: SparkSession, table: str, columns: list[str], entry: dict) -> None:
    """Move every staged file to where its partition lies; one that is no longer staged is there already."""
    mark = hashlib.sha256(entry["load_id"].encode()).hexdigest()[:16]
    root = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    places = partition_locations(spark, table, columns) if columns else {}
    for number, name in enumerate(entry["files"]):
        folder, _, file = name.rpartition("/")
        place = root
        if columns:
            values = folder_values(folder)
            if values not in places:
                places[values] = f"{root}/{folder}"
                spec = ", ".join(f"`{c}` = {sql_text(v)}" for c, v in zip(columns, values, strict=True))
                spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {sql_text(places[values])}")
            place = places[values]
        if storage.exists(spark, f"{entry['staged']}/{name}"):
            ending = file.partition(".")[2]
            storage.move(spark, f"{entry['staged']}/{name}", f"{place}/load-{mark}-{number:05d}.{ending}")


def load_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """(load_id, table_name, state, n_rows, staged_at, done_at) of every load that has got as far as staging its rows."""
    if not storage.entries(spark, ledger):
        return spark.createDataFrame([], "load_id string, table_name string, state string, n_rows bigint, staged_at timestamp, done_at timestamp")
    noted = spark.read.schema(ENTRY).json(ledger)
    done = F.max(F.when(F.col("state") == "done", F.col("at")))
    return noted.groupBy("load_id", "table_name").agg(
        F.when(done.isNull(), "staged").otherwise("done").alias("state"),
        F.max("n_rows").alias("n_rows"),
        F.max(F.when(F.col("state") == "staged", F.col("at"))).alias("staged_at"),
        done.alias("done_at"),
    )


def pending_loads(spark: SparkSession, ledger: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` (load_id, table_name, ...) whose load is not done."""
    return wanted.join(load_ledger(spark, ledger).where("state = 'done'"), ["load_id", "table_name"], "left_anti")
