"""Results that come as records of tagged values: one struct per cell, one non-null tag in it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The tags, in order of precedence.
TAGS = ("stringValue", "longValue", "doubleValue", "booleanValue")

TAGGED_VALUE = "struct<stringValue:string,longValue:bigint,doubleValue:double,booleanValue:boolean,isNull:boolean>"


def tagged_value(cell: Column) -> Column:
    """The first non-null tag as text; NULL for a null or unknown tag, which keeps its position."""
    return F.coalesce(*(cell[tag].cast("string") for tag in TAGS))


def tagged_map(record: Column, keys: Sequence[str]) -> Column:
    """A record as key -> text; cells beyond the keys, and keys beyond the cells, are left out."""
    width = F.least(F.size(record), F.lit(len(keys)))
    names = F.slice(F.array(*map(F.lit, keys)), F.lit(1), width)
    return F.map_from_arrays(names, F.transform(F.slice(record, F.lit(1), width), tagged_value))


def decode_tagged(df: DataFrame, record: str, keys: Sequence[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Records as columns named by ``keys``, cast where ``types`` names a type."""
    types = types or {}
    cells = {key: tagged_value(F.get(F.col(record), F.lit(i))) for i, key in enumerate(keys)}
    kept = [name for name in df.columns if name != record]
    return df.select(*kept, *(value.cast(types.get(key, "string")).alias(key) for key, value in cells.items()))
