"""Warehouse connections. Credentials come from the caller's options or the environment, never from code."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def connection_options(
    url: str, options: Mapping[str, str] | None = None, credentials_prefix: str | None = None
) -> dict[str, str]:
    """JDBC options; user and password are read from ``<PREFIX>_USER`` and ``<PREFIX>_PASSWORD``."""
    found = {"url": url}
    if credentials_prefix:
        found["user"] = os.environ[f"{credentials_prefix}_USER"]
        found["password"] = os.environ[f"{credentials_prefix}_PASSWORD"]
    return {**found, **(options or {})}


def read_query(
    spark: SparkSession,
    connection: Mapping[str, str],
    query: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> DataFrame:
    """The result of a query that the warehouse runs.

    With a partition column the result is read over ``partitions`` connections; without one it all
    comes through a single task, which only suits small results. Spark takes a partitioned read
    only from a table expression, hence the two forms.
    """
    reader = spark.read.format("jdbc").options(**connection).option("fetchsize", fetch_size)
    if partition_column is None:
        return reader.option("query", query).load()
    if bounds is None:
        raise ValueError("a partitioned read needs the bounds of its partition column")
    return (
        reader.option("dbtable", f"({query}) pushed_query")
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", partitions)
        .load()
    )


def append_table(
    df: DataFrame, connection: Mapping[str, str], table: str, partitions: int = 32, batch_size: int = 10_000
) -> None:
    """Append to a warehouse table over at most ``partitions`` connections."""
    (
        df.write.format("jdbc")
        .options(**connection)
        .option("dbtable", table)
        .option("numPartitions", partitions)
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )
