"""Deletes that rewrite single files of a partitioned table, and leave all others as they are.

Files with a listed key are found by a scan of the key columns; Bloom filters on them, see ``write_keyed``, spare most of the others
even that. What is kept of the touched files is written beside the table, the change is noted down, and then files are renamed
into their places and the old ones removed. A change that a crash interrupts is finished by the next call, or by
``finish_rewrites``. While files are renamed a reader may see rows twice: those who must not read by a manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright import storage
from lakewright.operators.keyed_joins import matching_keys
from lakewright.sinks.tables import clustered_by

NOTES = "_rewrites"
PUSHED_KEYS = 1000  # up to so many keys, the scan is given the keys themselves, which Bloom filters can tell absent
_PUSHDOWN = "spark.sql.parquet.pushdown.inFilterThreshold"


@dataclass(frozen=True)
class Rewrite:
    """Files that were replaced and the files that took their place, relative to the table."""

    replaced: tuple[str, ...]
    written: tuple[str, ...]


def write_keyed(
    df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], distinct_keys: int | None = None, mode: str = "errorifexists"
) -> None:
    """Write a Parquet table with Bloom filters on the key columns; ``distinct_keys`` are expected in a row group."""
    writer = clustered_by(df, *partition_by).write.mode(mode).partitionBy(*partition_by)
    _with_filters(writer, keys, distinct_keys).parquet(path)


def _with_filters(writer, keys: Sequence[str], distinct_keys: int | None):
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        if distinct_keys:
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", distinct_keys)
    return writer


def files_with_keys(table: DataFrame, keys: DataFrame, on: Sequence[str]) -> list[str]:
    """Paths of the files behind ``table`` that hold a row of a listed key; their number is at most that of the files."""
    spark = table.sparkSession
    rows = table.select(*(F.col(f"`{c}`") for c in on), F.col("_metadata.file_path").alias("_file"))
    before = spark.conf.get(_PUSHDOWN)
    if len(on) == 1:
        few = keys.select(on[0]).distinct().limit(PUSHED_KEYS + 1).collect()
        if len(few) <= PUSHED_KEYS:
            rows = rows.where(F.col(f"`{on[0]}`").isin([row[0] for row in few if row[0] is not None]))
    try:
        spark.conf.set(_PUSHDOWN, str(PUSHED_KEYS))
        found = matching_keys(rows, keys, on, keep=True).select("_file").distinct().collect()
    finally:
        spark.conf.set(_PUSHDOWN, before)
    return sorted(unquote(row["_file"]) for row in found)


def delete_keys_in_files(spark: SparkSession, path: str, keys: DataFrame, on: Sequence[str], partition_by: Sequence[str]) -> Rewrite:
    """Delete the rows of the listed keys from the Parquet table at ``path``; only files that hold one are read whole and written anew.

    All other files keep their names and times, those in the same partitions too. New files have Bloom filters on the keys. Rows
    with a NULL in a key stay. With no row to delete nothing is written.
    """
    finish_rewrites(spark, path)
    table = spark.read.parquet(path)
    touched = files_with_keys(table, keys, on)
    if not touched:
        return Rewrite((), ())
    staged = f"{path.rstrip('/')}/_rewrite-{uuid.uuid4().hex}"
    held = spark.read.schema(table.schema).option("basePath", path).parquet(*touched)
    kept = clustered_by(matching_keys(held, keys, on, keep=False), *partition_by)
    _with_filters(kept.write.partitionBy(*partition_by), on, None).parquet(staged)
    replaced = [storage.plain_path(f).removeprefix(f"{storage.plain_path(path)}/") for f in touched]
    written = storage.data_files(spark, staged)
    note = f"{path.rstrip('/')}/{NOTES}/{uuid.uuid4().hex}.json"
    storage.write_text(spark, note, json.dumps({"staged": staged.rsplit("/", 1)[-1], "written": written, "replaced": replaced}))
    _put_in_place(spark, path, note)
    spark.catalog.refreshByPath(path)
    return Rewrite(tuple(replaced), tuple(written))


def finish_rewrites(spark: SparkSession, path: str) -> int:
    """Put the files of interrupted rewrites in their places; how many rewrites there were."""
    notes = [e.path for e in storage.entries(spark, f"{path.rstrip('/')}/{NOTES}") if e.name.endswith(".json")]
    for note in notes:
        _put_in_place(spark, path, note)
    if notes:
        spark.catalog.refreshByPath(path)
    return len(notes)


def _put_in_place(spark: SparkSession, path: str, note: str) -> None:
    """Every step is taken or found taken, so all of this can be done again."""
    change, root = json.loads(storage.read_text(spark, note)), path.rstrip("/")
    staged = f"{root}/{change['staged']}"
    for name in change["written"]:
        if storage.exists(spark, f"{staged}/{name}"):
            storage.move(spark, f"{staged}/{name}", f"{root}/{name}")
    for name in change["replaced"]:
        storage.remove(spark, f"{root}/{name}")
    storage.remove(spark, staged)
    storage.remove(spark, note)
