"""Warehouse DDL from column metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions.warehouse_types import fixed_type, sized_type
from lakewright.operators.sizing import enriched_columns, max_text_length
from lakewright.plans.catalog import position_frame, schema_frame


def sized_columns(
    df: DataFrame,
    columns: DataFrame | None = None,
    buffer_percent: float = 20,
    unit: str = "chars",
    extended: bool = False,
) -> DataFrame:
    """Column metadata of ``df`` with measured lengths, positions and warehouse types.

    ``columns`` is the catalog's view of the table where that differs from the frame's schema. A
    column the frame lacks has no position and comes first. ``extended`` gives further types, such as
    ``bigint``, a type of their own in place of text.
    """
    columns = schema_frame(df) if columns is None else columns
    enriched = enriched_columns(columns, max_text_length(df, None, buffer_percent, unit), position_frame(df))
    return enriched.withColumn("warehouse_type", sized_type(F.col("column_type"), F.col("max_length"), extended))


def fold_definitions(
    columns: DataFrame, order: str, by: Sequence[str] = (), separator: str = ",\n", warehouse_type: str = "warehouse_type"
) -> DataFrame:
    """``name type`` of each column, joined in column order: one text per table.

    What is gathered is one table's column list, which a warehouse limits to a few thousand.
    """
    entry = F.struct(
        F.col(order).alias("position"),
        F.concat_ws(" ", F.col("column_name"), F.col(warehouse_type)).alias("definition"),
    )
    ordered = F.array_sort(F.collect_list(entry))
    return columns.groupBy(*by).agg(
        F.array_join(F.transform(ordered, lambda column: column["definition"]), separator).alias("definitions")
    )


def create_statements(schema: str | Column, table: str | Column, definitions: Column) -> Column:
    """CREATE SCHEMA and CREATE TABLE text around folded column definitions."""
    # The text of the statements is a fixed value.
    schema, table = (x if isinstance(x, Column) else F.lit(x) for x in (schema, table))
    return F.concat(
        F.lit("CREATE SCHEMA IF NOT EXISTS "), schema, F.lit(";\nCREATE TABLE IF NOT EXISTS "), schema, F.lit("."),
        table, F.lit(" (\n"), definitions, F.lit("\n);"),
    )


def sized_ddl(df: DataFrame, schema: str, table: str, columns: DataFrame | None = None, **measure) -> DataFrame:
    """One row with the DDL of ``df``, text columns sized from its data."""
    folded = fold_definitions(sized_columns(df, columns, **measure), "order_index")
    return folded.select(create_statements(schema, table, F.col("definitions")).alias("ddl"))


def fixed_ddl(
    columns: DataFrame, schema: str, table: str = "table_name", order: str = "order_index", extended: bool = False
) -> DataFrame:
    """One DDL row per table of a catalog listing, every text column at the longest size."""
    typed = columns.withColumn("warehouse_type", fixed_type(F.col("column_type"), extended))
    folded = fold_definitions(typed, order, [table], ", ")
    return folded.select(table, create_statements(schema, F.col(table), F.col("definitions")).alias("ddl"))
