"""Expected days against the days that are there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def day_counts(df: DataFrame, day: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per (key, day), summed up within each task before the shuffle."""
    if not isinstance(df.schema[day].dataType, T.DateType):
        raise TypeError(f"{day} must be a date column")
    present = df.where(F.col(day).isNotNull())
    return present.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("n_rows"))


def rows_per_day(df: DataFrame, day: str, keys: Sequence[str] = (), spine: DataFrame | None = None) -> DataFrame:
    """Row count of every expected day, 0 where a day has none.

    Expected are the (key, day) rows of ``spine``, or without one every day from a key's first to
    its last. In that case each day present also stands for the gap up to the next one, so the data
    is scanned once; the window holds one row per key and day, however many rows a day has.
    """
    counts = day_counts(df, day, keys)
    if spine is not None:
        joined = spine.join(counts, [*keys, day], "left")
        return joined.select(*keys, day, F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"))
    following = F.lead(day).over(Window.partitionBy(*keys).orderBy(day))
    until = counts.withColumn("_until", F.coalesce(F.date_sub(following, 1), F.col(day)))
    covered = until.withColumn("_day", F.explode(F.sequence(day, "_until", F.expr("interval 1 day"))))
    n_rows = F.when(F.col("_day") == F.col(day), F.col("n_rows")).otherwise(0)
    return covered.select(*keys, F.col("_day").alias(day), n_rows.alias("n_rows"))


def missing_days(df: DataFrame, day: str, keys: Sequence[str] = (), spine: DataFrame | None = None) -> DataFrame:
    """Expected days without any row."""
    return rows_per_day(df, day, keys, spine).where("n_rows = 0").select(*keys, day)
