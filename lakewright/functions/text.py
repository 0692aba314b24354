"""Text measures and names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two places in an identifier where an underscore goes, applied in this order.
# "[^\n]" rather than "." keeps one meaning of "any character" in every regex dialect.
WORD_BOUNDARIES = (
    r"([^\n])([A-Z][a-z]+)",
    r"([a-z0-9])([A-Z])",
)


def text_size(value: Column, unit: str = "chars") -> Column:
    """Length in characters, or in UTF-8 bytes for warehouses that size text in bytes."""
    if unit == "chars":
        return F.length(value)
    if unit == "bytes":
        return F.octet_length(value)
    raise ValueError(f"unit must be 'chars' or 'bytes', not {unit!r}")


def snake_case(name: Column) -> Column:
    """camelCase to snake_case; acronyms are kept together (HTTPCode -> http_code)."""
    for boundary in WORD_BOUNDARIES:
        name = F.regexp_replace(name, boundary, "$1_$2")
    return F.lower(name)


def rename_columns_snake(df: DataFrame) -> DataFrame:
    """The same frame with every column name in snake_case."""

    def renamed(name: str) -> str:
        for boundary in WORD_BOUNDARIES:
            name = re.sub(boundary, r"\1_\2", name)
        return name.lower()

    return df.toDF(*map(renamed, df.columns))
