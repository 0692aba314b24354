"""Equi-joins that hold up when the key side is large or one key holds much of the data.

The key side is broadcast only when its measured size fits. Otherwise both sides shuffle on the
key, and keys that hold an outsized share of the rows are salted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.session import shuffle_partitions

BROADCAST_SETTING = "spark.lakewright.broadcastBytes"
BROADCAST_BYTES = 64 << 20
HASH_BYTES = 32 << 20  # what one task may hold of the right side as a hash table
ROW_OVERHEAD = 16
MIN_BUCKETS, MAX_BUCKETS = 1024, 65_536  # key buckets in which hot keys are looked for
OVERLOAD = 2  # a bucket with more rows than this many average partitions is hot

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _broadcast_limit(df: DataFrame, given: int | None) -> int:
    return int(df.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES))) if given is None else given


def row_bytes(schema: T.StructType) -> Column:
    """About how much memory a row takes."""

    def width(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _FIXED_WIDTH):
            return F.lit(8)
        if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            value = F.to_json(F.struct(value))
        return F.coalesce(F.octet_length(value), F.lit(0))

    return reduce(add, map(width, schema), F.lit(ROW_OVERHEAD)).cast("bigint")


def estimated_bytes(df: DataFrame) -> int:
    """Size of a frame from its own values, measured by one aggregate over it."""
    return df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0


def key_profile(df: DataFrame, on: Sequence[str]) -> tuple[int, int]:
    """(bytes of the distinct keys, rows of the most frequent key), in one pass over the key columns."""
    keys = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    width = row_bytes(keys.drop("_n").schema)
    size, rows = keys.agg(F.sum(width), F.max("_n")).first()
    return size or 0, rows or 0


def hot_buckets(df: DataFrame, on: Sequence[str]) -> DataFrame | None:
    """(_bucket, _parts) of the key buckets that overload a shuffle partition, None if there are none.

    Keys are counted by hash bucket: each task sends one count per bucket, whatever the number of
    keys, and at most half as many buckets are returned as there are partitions. A hot key makes
    its bucket hot; that the bucket's other keys are cut up with it costs next to nothing.
    """
    spark = df.sparkSession
    partitions = max(2, shuffle_partitions(spark))
    buckets = _buckets(spark)
    counts = df.groupBy(_bucket(on, buckets).alias("_bucket")).agg(F.count(F.lit(1)).alias("n"))
    # A window over all buckets is a window over no more than MAX_BUCKETS rows.
    load = F.col("n") * F.lit(partitions) / F.sum("n").over(Window.partitionBy())
    overloaded = counts.select("_bucket", load.alias("load")).where(F.col("load") > OVERLOAD)
    hot = overloaded.select("_bucket", F.ceil("load").cast("int").alias("_parts")).collect()
    return spark.createDataFrame(hot, "_bucket int, _parts int") if hot else None


def _buckets(spark: SparkSession) -> int:
    return min(max(MIN_BUCKETS, 4 * shuffle_partitions(spark)), MAX_BUCKETS)


def _bucket(on: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(buckets)).cast("int")


def _split(df: DataFrame, hot: DataFrame | None, on: Sequence[str], salt: str, repeat: bool) -> DataFrame:
    """Add a salt below the bucket's number of parts: one value, or (``repeat``) the row once for each.

    The one value is a hash of the row and of the task that reads it, so rows of a hot key part wherever they
    stand, and a task that is run again after a lost executor gives its rows the same salt.
    """
    if hot is None:
        return df
    marked = df.withColumn("_bucket", _bucket(on, _buckets(df.sparkSession))).join(F.broadcast(hot), "_bucket", "left")
    parts = F.coalesce("_parts", F.lit(1))
    hashable = (F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType)))
    row = F.xxhash64(F.spark_partition_id(), F.lit(salt), *hashable)
    value = F.explode(F.sequence(F.lit(0), parts - 1)) if repeat else F.pmod(row, parts).cast("int")
    return marked.withColumn(salt, value).drop("_bucket", "_parts")


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, right_bytes: int | None = None
) -> DataFrame:
    """A shuffle join in which the rows of a hot key go to several tasks.

    Left rows of a key that is hot on the left are spread, and its right rows repeated to meet
    them. An inner join does the same for keys that are hot on the right; the other kinds need
    every right row of a key next to each left row, and are meant for right sides of distinct keys.
    A right side known to be small enough per task is hashed, which saves sorting the left one.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting does not support {how!r} joins")
    hot_left = hot_buckets(left, on)
    hot_right = hot_buckets(right, on) if how == "inner" else None
    salts = [name for name, hot in (("_salt_left", hot_left), ("_salt_right", hot_right)) if hot is not None]
    # Own salts first: a repeated row must not be spread by its copies' position.
    left = _split(_split(left, hot_left, on, "_salt_left", False), hot_right, on, "_salt_right", True)
    right = _split(_split(right, hot_right, on, "_salt_right", False), hot_left, on, "_salt_left", True)
    share = HASH_BYTES * shuffle_partitions(left.sparkSession)
    hashed = right_bytes is not None and right_bytes <= share
    # A hint either way, or Spark's own size estimate could turn this back into a broadcast.
    return left.join(right.hint("shuffle_hash" if hashed else "merge"), [*on, *salts], how).drop(*salts)


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    broadcast_bytes: int | None = None,
    right_bytes: int | None = None,
) -> DataFrame:
    """Join a large left side to a right side whose size is measured, unless the caller knows it."""
    size = estimated_bytes(right) if right_bytes is None else right_bytes
    if size <= _broadcast_limit(left, broadcast_bytes):
        return left.join(F.broadcast(right), list(on), how)
    return salted_join(left, right, on, how, size)


def matching_keys(
    left: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    keep: bool,
    broadcast_bytes: int | None = None,
    key_bytes: int | None = None,
) -> DataFrame:
    """Left rows whose key is (``keep``) or is not among ``keys``; a NULL key matches nothing.

    Repeated keys are only reduced to distinct ones when they do not fit as they are. ``keys`` is
    evaluated to measure it and again to join it; write it out first if that is costly.
    """
    how = "left_semi" if keep else "left_anti"
    listed = keys.select(*on)
    if key_bytes is None and estimated_bytes(listed) <= _broadcast_limit(left, broadcast_bytes):
        joined = left.join(F.broadcast(listed), list(on), how)
    else:
        joined = keyed_join(left, listed.distinct(), on, how, broadcast_bytes, key_bytes)
    return joined.select(*left.columns)
