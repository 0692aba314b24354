"""Texts as they reach a Python task: Arrow columns in, plain bytes or strings out."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BATCH_CHARS = 2 << 20  # how much text a helper handles at a time


def utf8_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 of every text; a null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def strings_of(column: pa.Array) -> list[str]:
    """Every text; a null counts as empty."""
    return [value or "" for value in column.to_pylist()]


def portions(batch: pa.RecordBatch, name: str = "text", size: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``size`` bytes of text (or list values): working memory stays small."""
    column = batch.column(name)
    length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    widths = pc.fill_null(length(column), 0).to_pylist()
    first = held = 0
    for row, width in enumerate(widths):
        if held and held + width > size:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += width
    if len(widths) > first:
        yield batch.slice(first)


def map_batches(
    df: DataFrame,
    schema: str,
    convert: Callable[[pa.RecordBatch], dict[str, object]],
    text: str = "text",
    size: int = BATCH_CHARS,
) -> DataFrame:
    """Apply ``convert`` to portions of every partition; it returns the columns of ``schema`` by name."""
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion in portions(batch, text, size):
                yield _batch(convert(portion), arrow)
        release()

    return df.mapInArrow(run, schema)


def add_columns(
    df: DataFrame, schema: str, convert: Callable[[pa.RecordBatch], dict[str, object]], text: str = "text"
) -> DataFrame:
    """``df`` with further columns; one that has the name of a new column gives way to it."""
    fields = T._parse_datatype_string(schema)
    kept = [name for name in df.columns if name not in fields.names]
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion in portions(batch, text):
                made = _batch(convert(portion), arrow)
                columns = [portion.column(name) for name in kept] + made.columns
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *fields.names])
        release()

    whole = T.StructType([df.schema[name] for name in kept] + fields.fields)
    return df.mapInArrow(run, whole)


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    """The C library's call that gives freed memory back to the system, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Workers live on after a task: give the memory of its batches back."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def _batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def id_text(column: str = "doc_id") -> Column:
    """An id as text; a null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_remainder(divisor: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``: the fold a row belongs to."""
    return F.pmod(F.crc32(id_text(column).cast("binary")), F.lit(divisor)).cast("int")
