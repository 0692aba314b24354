"""Incremental ingest: each run handles the files that came since the last one."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ANY_AGE = "36500d"


def new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    suffix: str | None = None,
    max_files_per_batch: int | None = None,
    options: Mapping[str, str] | None = None,
    max_file_age: str = ANY_AGE,
    clean_source: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """A stream over the files under ``path``, only those with ``suffix`` if one is given.

    A file counts as new however old its time is: backfills and copies that keep their times are taken in like
    any other. For that Spark keeps the paths it has seen on the driver; ``clean_source`` ("delete", or "archive"
    with a folder) removes finished files, so the landing folder, which is listed each time, stays small. A
    shorter ``max_file_age`` drops files that are so much older than the newest one seen.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFileAge", max_file_age).options(**(options or {}))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path)


def ingest_available(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Append everything that has arrived to ``target``, then stop.

    The checkpoint remembers which files are done and the file sink commits a batch as a whole, so
    running again, or again after a failure, adds no row twice. Both paths must be shared storage.
    """
    query = (
        transform(stream)
        .writeStream.format(fmt)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
