"""Manifests of tables: lists of data files that are read, and compared.

Paths stand in them as in ``_metadata.file_path``: percent-escaped, like web addresses.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def full_manifest(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(file_path, length, modified) of every data file under ``path``; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return listed.select(F.col("_metadata.file_path").alias("file_path"), "length", F.col("modificationTime").alias("modified"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file_path) of a manifest with a path a line, as ``write_manifest`` writes it; blank lines are none."""
    return spark.read.text(path).select(F.trim("value").alias("file_path")).where("file_path <> ''")


def scan_manifest(
    spark: SparkSession, manifest: DataFrame, base_path: str, schema: T.StructType | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The rows of exactly the files that a manifest lists (file_path), with the partition values that their paths hold.

    Files that lie beside them are not read, and not listed. A listed file that is gone is an error. The paths pass through the
    driver, which holds those of every scan. A manifest that lists nothing needs a ``schema``.
    """
    paths = [unquote(row["file_path"]) for row in manifest.select("file_path").distinct().orderBy("file_path").collect()]
    reader = spark.read.format(fmt).option("basePath", base_path)
    if schema is not None:
        reader = reader.schema(schema)
    if not paths:
        if schema is None:
            raise ValueError("an empty manifest has no schema")
        return spark.createDataFrame([], schema)
    return reader.load(paths)


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(file_path, change) between two manifests (file_path and any measures): ``added``, ``gone``, or ``changed`` in a measure."""
    measures = [c for c in new.columns if c != "file_path" and c in old.columns]
    sides = [df.select("file_path", F.struct(*measures, F.lit(True).alias("listed")).alias(side)) for df, side in ((old, "old"), (new, "new"))]
    both = sides[0].join(sides[1], "file_path", "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "gone").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return both.select("file_path", change.alias("change")).where("change IS NOT NULL")
