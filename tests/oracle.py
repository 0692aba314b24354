"""Run a registered query and its SQL, and compare rows and column types."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb
from pyspark.sql import SparkSession

from lakewright.workloads.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"

# Column types that count as equal, by engine.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def _plain(value: object) -> object:
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def compare(
    spark: SparkSession, connection: duckdb.DuckDBPyConnection, name: str, sf_dir: str, queries: dict = QUERIES, oracles: dict = ORACLES
) -> str | None:
    """What differs, or None."""
    frame = queries[name](spark, sf_dir)
    names = sorted(frame.columns)
    types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in frame.schema}
    got = [tuple(_plain(row[n]) for n in names) for row in frame.collect()]
    relation = connection.sql(oracles[name])
    expected_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    if sorted(expected_types) != names:
        return f"columns {names} against {sorted(expected_types)}"
    if types != expected_types:
        return f"types {types} against {expected_types}"
    order = [relation.columns.index(n) for n in names]
    expected = [tuple(row[i] for i in order) for row in relation.fetchall()]
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    for ours, theirs in zip(sorted(got, key=_sortable), sorted(expected, key=_sortable), strict=True):
        if ours != theirs:
            return f"row {ours} against {theirs}"
    return None if got else "no rows"
