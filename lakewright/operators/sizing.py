"""Measure text columns to size warehouse columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.functions.text import text_size
from lakewright.functions.warehouse_types import DEFAULT_TEXT
from lakewright.operators.columns import columns_of_type

LENGTHS = "column_name string, max_length int"


def max_text_length(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    buffer_percent: float = 20,
    unit: str = "chars",
) -> DataFrame:
    """(column_name, max_length) of every text column, with room to grow.

    One pass and one global aggregate; only the text columns are read. A column without values
    counts as the default length, and the growth buffer is added to that too.
    """
    columns = columns_of_type(df, "string") if columns is None else list(columns)
    if not columns:
        return df.sparkSession.createDataFrame([], LENGTHS)
    longest = df.agg(*(F.max(text_size(F.col(f"`{c}`"), unit)).alias(c) for c in columns))
    rows = longest.unpivot([], [f"`{c}`" for c in columns], "column_name", "measured")
    length = F.coalesce("measured", F.lit(DEFAULT_TEXT))
    grown = F.bround(length + length * F.lit(float(buffer_percent)) / 100, 0)
    return rows.select("column_name", grown.cast("int").alias("max_length"))


def enriched_columns(columns: DataFrame, lengths: DataFrame, positions: DataFrame) -> DataFrame:
    """Column metadata with measured length and position, each NULL where there is none.

    Lengths and positions have one row per column of one table, so both are broadcast.
    """
    measured = columns.join(F.broadcast(lengths), "column_name", "left")
    return measured.join(F.broadcast(positions), "column_name", "left")
