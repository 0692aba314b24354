"""Catalog type names to warehouse type names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse types by catalog type.
EXACT_TYPES = {"int": "INTEGER", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}
PREFIX_TYPES = {"double": "DOUBLE PRECISION", "array": "SUPER"}
DEFAULT_TEXT = 255
LONGEST_TEXT = 65535

# Types without a rule of their own fall back to text; ``extended`` gives them one.
EXTENDED_TYPES = {
    "bigint": "BIGINT",
    "smallint": "SMALLINT",
    "tinyint": "SMALLINT",
    "float": "REAL",
    "date": "DATE",
    "binary": "VARBYTE",
}
EXTENDED_PREFIXES = {"decimal": "", "map": "SUPER", "struct": "SUPER"}  # "" keeps the name, in capitals


def catalog_type(data_type: T.DataType) -> str:
    """The catalog's name of a Spark type; both timestamp types are ``timestamp`` there."""
    return "timestamp" if isinstance(data_type, T.TimestampNTZType) else data_type.simpleString()


def _mapped(column_type: Column, text: Column, text_rule: Column, fallback: int, extended: bool) -> Column:
    rule = F.when(text_rule, text)
    for name, target in (EXACT_TYPES | (EXTENDED_TYPES if extended else {})).items():
        rule = rule.when(column_type == name, F.lit(target))
    for prefix, target in (PREFIX_TYPES | (EXTENDED_PREFIXES if extended else {})).items():
        rule = rule.when(column_type.startswith(prefix), F.lit(target) if target else F.upper(column_type))
    return rule.otherwise(F.lit(f"VARCHAR({fallback})"))


def sized_type(column_type: Column, max_length: Column, extended: bool = False) -> Column:
    """Text gets its measured length; no length, or length 0, gives the default."""
    measured = F.when(max_length > 0, max_length).otherwise(F.lit(DEFAULT_TEXT))
    text = F.concat(F.lit("VARCHAR("), measured.cast("string"), F.lit(")"))
    return _mapped(column_type, text, column_type.startswith("string"), DEFAULT_TEXT, extended)


def fixed_type(column_type: Column, extended: bool = False) -> Column:
    """Text gets the longest size there is; nothing is measured."""
    text = F.lit(f"VARCHAR({LONGEST_TEXT})")
    return _mapped(column_type, text, column_type == "string", LONGEST_TEXT, extended)


def spark_column_type(warehouse_type: str) -> str:
    """The Spark type that stores a warehouse type; semi-structured values are kept as JSON text."""
    stored = {
        "INTEGER": "INT",
        "TIMESTAMP": "TIMESTAMP_NTZ",
        "DOUBLE PRECISION": "DOUBLE",
        "SUPER": "STRING",
        "REAL": "FLOAT",
        "VARBYTE": "BINARY",
    }
    return stored.get(warehouse_type, warehouse_type)
