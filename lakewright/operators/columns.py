"""Projections driven by column types and by what a consumer may see."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.functions.warehouse_types import catalog_type


def columns_of_type(df: DataFrame, column_type: str) -> list[str]:
    """Names of the columns whose catalog type is exactly ``column_type``."""
    return [f.name for f in df.schema if catalog_type(f.dataType) == column_type]


def project_by_type(df: DataFrame, column_type: str = "string") -> DataFrame:
    return df.select(*(F.col(f"`{name}`") for name in columns_of_type(df, column_type)))


@dataclass(frozen=True)
class ColumnRule:
    """What one consumer sees: only ``columns`` (allow), or everything but them (deny)."""

    mode: str
    columns: tuple[str, ...]

    def apply(self, df: DataFrame) -> DataFrame:
        """A misspelt name is an error in both modes: a deny rule must not fail open."""
        unknown = set(self.columns) - set(df.columns)
        if unknown:
            raise ValueError(f"rule names absent columns {sorted(unknown)}")
        if self.mode == "allow":
            return df.select(*self.columns)
        if self.mode == "deny":
            return df.drop(*self.columns)
        raise ValueError(f"rule mode must be 'allow' or 'deny', not {self.mode!r}")


def allow(*columns: str) -> ColumnRule:
    return ColumnRule("allow", columns)


def deny(*columns: str) -> ColumnRule:
    return ColumnRule("deny", columns)


def consumer_view(df: DataFrame, rules: Mapping[str, ColumnRule], consumer: str, view: str | None = None) -> DataFrame:
    """What ``consumer`` may see; a consumer without a rule gets an error, not the whole table.

    With ``view`` it is also registered as a temporary view. A view protects nothing from someone
    who can read the base table.
    """
    if consumer not in rules:
        raise PermissionError(f"no column rule for consumer {consumer!r}")
    visible = rules[consumer].apply(df)
    if view:
        visible.createOrReplaceTempView(view)
    return visible


def preview(df: DataFrame, rows: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows; with ``order_by`` the same ones each time."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
