"""Lake tables: snapshot reads, raw file scans, catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current snapshot of the table at ``path``.

    ``fmt="delta"`` honours the transaction log and needs that package on the cluster. Failures
    are raised, never turned into an absent frame.
    """
    return spark.read.format(fmt).load(path)


def glob_scan(
    spark: SparkSession,
    path: str,
    pattern: str = "date=*/part-*.parquet",
    fmt: str = "parquet",
    keep_partition_cols: bool = False,
) -> DataFrame:
    """All data files that match, whatever a table log says about them.

    Files the log has dropped are seen too, so rows deleted from the table can come back; use
    ``read_table`` where that matters. The directory's own column is left out unless asked for.
    """
    root = path.rstrip("/")
    reader = spark.read.format(fmt)
    if keep_partition_cols:
        reader = reader.option("basePath", root)
    return reader.load(f"{root}/{pattern}")


def catalog_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")
