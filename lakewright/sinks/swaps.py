"""Moves of a catalog table's partitions from one set of files to another.

A swap is written down before its first step, each step replaces one partition's location by another in one catalog call, and the
note is removed after the last. So no partition is ever missing in between, and after a crash ``finish_swaps`` takes the steps
that are left, or takes all of them back.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.sql import SparkSession

from lakewright import storage
from lakewright.session import sql_text

NOTES = "_swaps"  # folder of the notes, under the root of a table's versions

Values = tuple[str, ...]  # of a partition, one for each of its columns, as the catalog has them


@dataclass(frozen=True)
class Step:
    """One partition's location before and after; None where there is no such partition."""

    values: Values
    before: str | None
    after: str | None


def partition_locations(spark: SparkSession, table: str, columns: list[str]) -> dict[Values, str]:
    """Where the files of every partition are, as the catalog has it."""
    state = spark._jsparkSession.sessionState()
    jvm = spark.sparkContext._jvm
    listed = state.catalog().listPartitions(state.sqlParser().parseTableIdentifier(table), jvm.scala.Option.empty())
    found = {}
    for i in range(listed.size()):
        part = listed.apply(i)
        spec = {name.lower(): part.spec().apply(name) for name in _keys(part.spec())}
        found[tuple(spec[column.lower()] for column in columns)] = jvm.org.apache.hadoop.fs.Path(part.location()).toString()  # not escaped
    return found


def _keys(spec) -> list[str]:
    keys = spec.keys().toSeq()
    return [keys.apply(i) for i in range(keys.size())]


def folder_values(folder: str) -> Values:
    """The values that a partition folder is named after: ``day=2024-01-01/kind=c%2Fd`` holds ``c/d``."""
    return tuple(unquote(part.split("=", 1)[1]) for part in folder.split("/"))


def partition_folders(spark: SparkSession, version: str, depth: int, below: str = "") -> list[str]:
    """The partition folders of a version, relative to it."""
    found = [f"{below}{e.name}" for e in storage.entries(spark, f"{version}/{below}") if e.is_folder and "=" in e.name]
    return found if depth == 1 else [inner for one in found for inner in partition_folders(spark, version, depth - 1, f"{one}/")]


def swap_partitions(spark: SparkSession, table: str, columns: list[str], root: str, moves: Mapping[Values, str | None]) -> None:
    """Give partitions new locations, or none; a swap of this table that was not finished is finished first."""
    finish_swaps(spark, table, columns, root)
    held = partition_locations(spark, table, columns)
    steps = [Step(values, held.get(values), location) for values, location in sorted(moves.items())]
    note = f"{root.rstrip('/')}/{NOTES}/{uuid.uuid4().hex}.json"
    storage.write_text(spark, note, json.dumps({"table": table, "steps": [asdict(step) for step in steps]}))
    for step in steps:
        _relocate(spark, table, columns, step.values, step.after)
    spark.catalog.refreshTable(table)
    storage.remove(spark, note)


def unfinished_swaps(spark: SparkSession, root: str) -> list[str]:
    """The notes of swaps that have not come to their end."""
    return [e.path for e in storage.entries(spark, f"{root.rstrip('/')}/{NOTES}") if e.name.endswith(".json")]


def finish_swaps(spark: SparkSession, table: str, columns: list[str], root: str, undo: bool = False) -> int:
    """Take all steps of the swaps of a table that a crash left unfinished, or take them back; how many swaps there were."""
    count = 0
    for note in unfinished_swaps(spark, root):
        written = json.loads(storage.read_text(spark, note))
        if written["table"] != table:
            continue
        for step in written["steps"]:
            _relocate(spark, table, columns, tuple(step["values"]), step["before" if undo else "after"])
        spark.catalog.refreshTable(table)
        storage.remove(spark, note)
        count += 1
    return count


def _relocate(spark: SparkSession, table: str, columns: list[str], values: Values, location: str | None) -> None:
    """One partition in one catalog call; the same call again changes nothing."""
    spec = ", ".join(f"`{column}` = {sql_text(value)}" for column, value in zip(columns, values, strict=True))
    if location is None:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    elif values in partition_locations(spark, table, columns):
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {sql_text(location)}")
    else:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {sql_text(location)}")
