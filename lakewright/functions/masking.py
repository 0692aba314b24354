"""Column masks for anonymised and dummy copies."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a dummy copy holds in place of data.
DUMMY_TEXT = "dummy_value"
DUMMY_INT = 0


def dummy_constant(data_type: T.DataType) -> Column | None:
    """The dummy for text and 32-bit integer columns; None for every other type."""
    if isinstance(data_type, T.StringType):
        return F.lit(DUMMY_TEXT)
    if isinstance(data_type, T.IntegerType):
        return F.lit(DUMMY_INT)
    return None


def dummy_values(df: DataFrame) -> DataFrame:
    """Text and 32-bit integer columns become constants, NULLs included; the rest is untouched.

    One projection: the replaced columns are not even read from columnar files.
    """
    replaced = {field.name: dummy_constant(field.dataType) for field in df.schema}
    return df.select(*(F.col(n) if v is None else v.alias(n) for n, v in replaced.items()))


SALT_VARIABLE = "LAKEWRIGHT_MASK_SALT"


def masked(value: Column, data_type: T.DataType, how: str, salt: str | None = None) -> Column:
    """``constant`` as in a dummy copy, ``sha256`` of the text, or ``null``.

    A hash of a small number is found by trying them all, unless a secret ``salt`` stands before it: give one here or in
    the environment of the driver. Equal values have equal hashes under one salt.
    """
    if how == "null":
        return F.lit(None).cast(data_type)
    if how == "sha256":
        secret = os.environ.get(SALT_VARIABLE, "") if salt is None else salt
        return F.sha2(F.concat(F.lit(secret), value.cast("string")), 256)
    if how == "constant":
        constant = dummy_constant(data_type)
        if constant is None:
            raise ValueError(f"no constant mask for {data_type.simpleString()}; use 'null' or 'sha256'")
        return constant
    raise ValueError(f"unknown mask {how!r}")


def mask_columns(df: DataFrame, masks: Mapping[str, str], salt: str | None = None) -> DataFrame:
    """Apply one mask per named column, in place."""
    missing = set(masks) - set(df.columns)
    if missing:
        raise ValueError(f"cannot mask absent columns {sorted(missing)}")
    return df.select(
        *(
            masked(F.col(f.name), f.dataType, masks[f.name], salt).alias(f.name) if f.name in masks else F.col(f.name)
            for f in df.schema
        )
    )
