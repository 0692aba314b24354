"""What files are there, without reading them."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.storage import entries, exists

LOOKED_UP = 62  # days of a range that are looked up one by one


def list_files(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, length, modificationTime) of every file; the contents are pruned from the scan."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")


def dated_directory(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/date={day.isoformat()}/"


def existing_directory(spark: SparkSession, root: str, day: dt.date) -> str | None:
    """The directory of a day if it holds any file, else None."""
    directory = dated_directory(root, day)
    try:
        return None if list_files(spark, directory).isEmpty() else directory
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def day_folders(spark: SparkSession, root: str, first: dt.date, last: dt.date) -> list[str]:
    """The ``date=`` directories under ``root`` of the days of a range, both ends included.

    A range of up to LOOKED_UP days is looked up day by day, whatever else lies under ``root``; a longer one is picked from one listing of
    the names there.
    """
    if (last - first).days < LOOKED_UP:
        days = (first + dt.timedelta(days=n) for n in range((last - first).days + 1))
        return [path for path in (dated_directory(root, day).rstrip("/") for day in days) if exists(spark, path)]
    named = ((e.path, re.fullmatch(r"date=(\d{4}-\d{2}-\d{2})", e.name)) for e in entries(spark, root) if e.is_folder)
    return [path for path, match in named if match and first.isoformat() <= match[1] <= last.isoformat()]


def missing_directories(spark: SparkSession, root: str, first: dt.date, last: dt.date) -> DataFrame:
    """(day) of every day of the range, both ends included, without any file in its ``date=`` directory.

    Only directories of the range are listed. Under a root that is absent every day is missing.
    """
    ends = F.sequence(F.lit(first.isoformat()).cast("date"), F.lit(last.isoformat()).cast("date"))
    days = spark.range(1).select(F.explode(ends).alias("day"))
    folders = day_folders(spark, root, first, last)
    if not folders:
        return days
    found = F.regexp_extract("path", r"/date=(\d{4}-\d{2}-\d{2})/", 1)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    present = listed.select(found.alias("day")).where("day <> ''").select(F.col("day").cast("date")).distinct()
    return days.join(present, "day", "left_anti")


def file_manifest(df: DataFrame) -> DataFrame:
    """(file_path, n_rows) of the files behind a file-based frame."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("n_rows"))
