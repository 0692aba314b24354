"""Text measures of a partitioned table that are kept by partition: only partitions that changed are read again."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewright import storage
from lakewright.functions.text import text_size
from lakewright.functions.warehouse_types import DEFAULT_TEXT
from lakewright.operators.columns import columns_of_type
from lakewright.sinks.swaps import Values, partition_locations
from lakewright.sinks.tables import partition_columns

STATE = "part string, location string, n_files bigint, bytes bigint, newest timestamp"
MEASURES = f"{STATE}, measured_at timestamp, column_name string, n_rows bigint, n_values bigint, longest int, sketch binary"


def _part(values: Values) -> str:
    return json.dumps(values)


def partition_states(spark: SparkSession, table: str) -> DataFrame:
    """(part, location, n_files, bytes, newest) of every partition of a catalog table, from listings alone."""
    held = partition_locations(spark, table, partition_columns(spark, table))
    rows = [(_part(values), storage.plain_path(place)) for values, place in held.items() if storage.exists(spark, place)]
    named = spark.createDataFrame(rows, "part string, location string")
    if not rows:
        return spark.createDataFrame([], STATE)
    files = spark.read.format("binaryFile").load([place for place in held.values() if storage.exists(spark, place)])
    folder = F.regexp_replace(F.regexp_replace("path", r"/[^/]*$", ""), r"^[a-z0-9+.-]+:(//[^/]*(?=/))?/*", "/")
    listed = files.groupBy(folder.alias("location")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest")
    )
    return named.join(listed, "location", "left").select("part", "location", F.coalesce("n_files", F.lit(0)).alias("n_files"), F.coalesce("bytes", F.lit(0)).alias("bytes"), "newest")


def update_measures(spark: SparkSession, table: str, measures: str, unit: str = "chars") -> list[Values]:
    """Measure the text columns of the partitions whose files are not those that were measured last; which partitions.

    Measures are added to the files under ``measures``: per partition and text column the rows, the values that are not NULL, the longest one,
    and a sketch of all lengths. Names of partitions pass through the driver, rows do not.
    """
    states = partition_states(spark, table)
    if storage.entries(spark, measures):
        known = _newest(spark, measures).select("part", "location", "n_files", "bytes", "newest").distinct()
        same = reduce(and_, (states[c].eqNullSafe(known[c]) for c in known.columns))
        states = states.join(known, same, "left_anti")
    stale = {tuple(json.loads(row["part"])): row for row in states.collect()}
    rows = spark.table(table)
    keys = partition_columns(spark, table)
    texts = [c for c in columns_of_type(rows, "string") if c not in keys]
    if not stale or not texts:
        return []
    measured = _measured(rows.where(_among(rows, keys, list(stale))), keys, texts, unit)
    told = spark.createDataFrame([tuple(row) for row in stale.values()], STATE)
    _told_and_measured(told, measured, texts).write.mode("append").parquet(measures)
    return sorted(stale)


def _told_and_measured(told: DataFrame, measured: DataFrame, texts: Sequence[str]) -> DataFrame:
    """The measures of the partitions in ``told``, one row for each and text column, in one task.

    A partition without rows is measured too, or it would be read again each time. The names come together before the join: a task
    that ran the join for many small parts would count the broadcast table's memory once for each.
    """
    named = told.coalesce(1).select("*", F.explode(F.array(*map(F.lit, texts))).alias("column_name"))
    whole = named.join(F.broadcast(measured), ["part", "column_name"], "left").withColumn("measured_at", F.current_timestamp())
    counted = whole.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_rows", "n_values")})
    return counted.select(*(c.split()[0] for c in MEASURES.split(", ")))


def _among(rows: DataFrame, keys: Sequence[str], parts: list[Values]) -> Column:
    """Whether a row is in one of the partitions: a predicate of partition columns only, so the others are not listed."""
    def same(key: str, value: str) -> Column:
        column = F.col(f"`{key}`")
        return column.isNull() if value == "__HIVE_DEFAULT_PARTITION__" else column == F.lit(value).cast(rows.schema[key].dataType)

    return reduce(or_, (reduce(and_, (same(k, v) for k, v in zip(keys, values, strict=True))) for values in parts))


def _measured(rows: DataFrame, keys: Sequence[str], texts: Sequence[str], unit: str) -> DataFrame:
    """(part, column_name, n_rows, n_values, longest, sketch); one pass, one row of sums for each partition and task."""
    sizes = {c: text_size(F.col(f"`{c}`"), unit) for c in texts}
    sums = [
        F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count(size).alias("n_values"), F.max(size).alias("longest"),
            F.kll_sketch_agg_bigint(size.cast("bigint")).alias("sketch"),
        ).alias(f"_{i}")
        for i, (c, size) in enumerate(sizes.items())
    ]
    grouped = rows.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(*sums)
    texts_of = (F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")) for k in keys)
    # The same text as ``_part`` makes of the values.
    part = F.concat(F.lit("["), F.array_join(F.array(*(F.concat(F.lit('"'), _escaped(t), F.lit('"')) for t in texts_of)), ", "), F.lit("]"))
    return grouped.select(part.alias("part"), F.inline(F.array(*(f"_{i}" for i in range(len(texts))))))


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def _newest(spark: SparkSession, measures: str) -> DataFrame:
    """The last measure of every partition and column."""
    order = Window.partitionBy("part", "column_name").orderBy(F.desc("measured_at"))
    rows = spark.read.schema(MEASURES).parquet(measures)
    return rows.withColumn("_turn", F.row_number().over(order)).where("_turn = 1").drop("_turn")


def table_measures(spark: SparkSession, table: str, measures: str, buffer_percent: float = 20, shares: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """(column_name, n_rows, n_values, max_length, lengths) of a table, merged from the measures of the partitions it has now.

    ``max_length`` is what ``max_text_length`` gives for the whole table; ``lengths`` has the lengths below which the given shares
    of the values lie, within the error of the sketch. No row of the table is read.
    """
    now = partition_states(spark, table).select("part")
    merged = _newest(spark, measures).join(now, "part", "left_semi").groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.max("longest").alias("longest"), F.kll_merge_agg_bigint("sketch").alias("sketch")
    )
    length = F.coalesce("longest", F.lit(DEFAULT_TEXT))
    grown = F.bround(length + length * F.lit(float(buffer_percent)) / 100, 0).cast("int")
    quantiles = F.when(F.col("n_values") > 0, F.array(*(F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(s))) for s in shares)))
    return merged.select("column_name", "n_rows", "n_values", grown.alias("max_length"), quantiles.alias("lengths"))
