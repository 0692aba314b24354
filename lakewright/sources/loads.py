"""Bulk loads of external files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.operators.changes import project_to
from lakewright.operators.keyed_joins import keyed_join

# Microseconds survive a text round trip; Spark's default pattern stops at milliseconds.
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CSV_OPTIONS = {
    "header": "true",
    "timestampFormat": TIMESTAMP_TEXT,
    "timestampNTZFormat": TIMESTAMP_TEXT,
    "escape": '"',
    "nullValue": "\\N",  # so that NULL and empty text differ
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
LINE_BREAKS = ("escaped", "quoted", "none")
# A backslash is written too, so that each one in a file stands before one of these letters.
_ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def load_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Any format with the caller's options; a given schema saves the inference pass."""
    reader = spark.read.format(fmt).options(**(options or {}))
    return (reader.schema(schema) if schema is not None else reader).load(path)


def escaped(df: DataFrame) -> DataFrame:
    """Line breaks in text columns as ``\\n`` and ``\\r``, backslashes as ``\\b``: a row is then one line of a file."""
    return _with_texts(df, _ESCAPES)


def unescaped(df: DataFrame) -> DataFrame:
    return _with_texts(df, [(b, a) for a, b in reversed(_ESCAPES)])


def _with_texts(df: DataFrame, changes: Sequence[tuple[str, str]]) -> DataFrame:
    def changed(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return value
        return reduce(lambda text, pair: F.replace(text, *map(F.lit, pair)), changes, value).alias(field.name)

    return df.select(*map(changed, df.schema))


def load_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    delimiter: str = ",",
    line_breaks: str = "escaped",
    strict: bool = True,
) -> DataFrame:
    """Delimited text with one header line per file, as ``write_csv`` writes it.

    Line breaks inside of values: "escaped" files split over tasks. Foreign files mostly have them "quoted", and a
    file is then one task; "none" takes every line for a row and every value as it stands. A value that does not
    fit its type, or a line with a wrong number of fields, is an error, unless ``strict`` is off, which makes it
    NULL; ``checked_csv_load`` lists such lines instead.
    """
    if line_breaks not in LINE_BREAKS:
        raise ValueError(f"line_breaks must be one of {LINE_BREAKS}, not {line_breaks!r}")
    how = {"sep": delimiter, "mode": "FAILFAST" if strict else "PERMISSIVE", "multiLine": str(line_breaks == "quoted").lower()}
    loaded = load_files(spark, path, "csv", {**CSV_OPTIONS, **how}, schema)
    return unescaped(loaded) if line_breaks == "escaped" else loaded


def nested_to_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, NULL fields included; every other column unchanged."""

    def flat(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, _NESTED):
            return value
        return F.to_json(value, {"ignoreNullFields": "false"}).alias(field.name)

    return df.select(*map(flat, df.schema))


def load_parquet_as_json(spark: SparkSession, root: str, day: dt.date | None = None) -> DataFrame:
    """Parquet of one ``date=`` directory, or of all of them, with nested values as JSON text."""
    directory = f"date={day.isoformat()}" if day else "date=*"
    return nested_to_json(spark.read.parquet(f"{root.rstrip('/')}/{directory}"))


def load_by_name(
    spark: SparkSession,
    path: str,
    target: DataFrame,
    fmt: str = "avro",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files whose fields are matched to the target by name. Avro needs its package on the cluster."""
    return project_to(load_files(spark, path, fmt, options), target)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files line by line; a large file is split over tasks. Only a line feed ends a line."""
    return spark.read.option("lineSep", "\n").text(path)


def lines_with_places(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _block, _place, _line): the lines of text files, with the block that a task read and a number that rises within it.

    ``numbered`` turns these into line numbers. Write them out first: the numbers hold only for one reading of the files.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
        F.col("value").alias("_line"),
    )


def numbered(written: DataFrame) -> DataFrame:
    """Add ``line_number``, from 1 in every file, to rows of ``lines_with_places`` that have been written out, one for each line.

    Lines are counted by block; the counts of a file's blocks are summed up in order, and a line's place within its block is
    added. Only the counts are shuffled.
    """
    blocks = written.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_place") - F.col("_first") + 1
    return keyed_join(written, before, ["_file", "_block"], "inner").withColumn("line_number", number).drop("_before", "_first")


class LoadFailed(RuntimeError):
    """A load with more bad fields than it may have; the message shows the first ones."""


@dataclass(frozen=True)
class CheckedLoad:
    """Outcome of a checked load: typed rows, one row per bad field, and a summary per load."""

    rows: DataFrame
    errors: DataFrame
    history: DataFrame


def checked_csv_load(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    table: str,
    query_id: int,
    start_time: dt.datetime,
    max_lengths: Mapping[str, int] | None = None,
    delimiter: str = ",",
    staging: str | None = None,
    line_breaks: str = "escaped",
    max_errors: int | None = None,
) -> CheckedLoad:
    """Load delimited text, setting aside lines with a wrong field count, type or text length.

    With a ``staging`` path the text is parsed and checked once and written there as Parquet, which all three results then read,
    and errors have the number of their line in the file, also where a file is cut into several tasks. Without one, each result
    that is used parses the text, and ``line_number`` is NULL; it is so too with ``line_breaks="quoted"``, where a row may
    have several lines. With ``max_errors``, which needs ``staging``, more errors than that raise ``LoadFailed`` with
    the first of them, by file and line.
    """
    if max_errors is not None and not staging:
        raise ValueError("an error limit needs a staging path: the errors are counted before any row is used")
    lengths, corrupt = max_lengths or {}, "_corrupt_record"
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema]).add(corrupt, T.StringType())
    by_line = staging is not None and line_breaks != "quoted"
    # Every field is parsed whichever are selected later, or the field count could not be checked.
    checking = {**CSV_OPTIONS, "sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "columnPruning": "false"}
    if by_line:
        parsed = F.from_csv("_line", as_text.simpleString(), {k: v for k, v in checking.items() if k != "header"})
        blank = F.trim("_line") == ""
        raw = lines_with_places(spark, path).withColumns({"_blank": blank, "_row": parsed}).select("_file", "_block", "_place", "_blank", "_row.*")
    else:
        checking["multiLine"] = str(line_breaks == "quoted").lower()
        raw = load_files(spark, path, "csv", checking, as_text).withColumn("_file", F.col("_metadata.file_path"))
    if line_breaks == "escaped":
        raw = unescaped(raw)

    def fault(column: str, column_type: str, value: Column, message: str) -> Column:
        return F.struct(
            F.lit(column).alias("column_name"),
            F.lit(column_type).alias("column_type"),
            value.alias("raw_value"),
            F.lit(message).alias("error_message"),
        )

    malformed = F.col(corrupt).isNotNull()
    checks = [F.when(malformed, fault("", "", F.col(corrupt), "wrong number of fields"))]
    typed = []
    for field in schema:
        text, type_name = F.col(f"`{field.name}`"), field.dataType.simpleString()
        problems = []
        if isinstance(field.dataType, T.StringType):
            typed.append(text)
        else:
            value = text.try_cast(field.dataType)
            typed.append(value.alias(field.name))
            problems.append((text.isNotNull() & value.isNull(), "invalid value"))
        if field.name in lengths:
            problems.append((F.length(text) > lengths[field.name], "value too long"))
        checks += [F.when(~malformed & bad, fault(field.name, type_name, text, message)) for bad, message in problems]
    faults = [f"_fault{i}" for i in range(len(checks))]
    marks = (check.alias(name) for check, name in zip(checks, faults, strict=True))
    checked = raw.select("*", *marks)
    if staging:
        checked.write.mode("overwrite").parquet(staging)
        checked = spark.read.schema(checked.schema).parquet(staging)
    if by_line:
        # The header is the first line of a file; blank lines are no rows, but count as lines.
        checked = numbered(checked).where((F.col("line_number") > 1) & ~F.col("_blank"))
    else:
        checked = checked.withColumn("line_number", F.lit(None).cast("bigint"))

    n_faults = reduce(add, (F.col(name).isNotNull().cast("bigint") for name in faults))
    sound = reduce(and_, (F.col(name).isNull() for name in faults))
    started = F.lit(start_time.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")
    load_id = (
        F.lit(query_id).cast("bigint").alias("query_id"),
        started.alias("start_time"),
        F.lit(table).alias("table_name"),
    )
    listed = checked.where(~sound).select("_file", "line_number", F.explode(F.array(*faults)).alias("fault")).where("fault IS NOT NULL")
    errors = listed.select(*load_id, F.col("_file").alias("file_name"), "line_number", "fault.*")
    if max_errors is not None:
        _refuse_more(errors, max_errors)
    history = checked.agg(
        F.count_if(sound).alias("loaded_rows"),
        F.count_if(~sound).alias("error_rows"),
        F.coalesce(F.sum(n_faults), F.lit(0).cast("bigint")).alias("error_count"),
    )
    status = F.when(F.col("error_count") == 0, "completed").otherwise("completed with errors").alias("status")
    return CheckedLoad(checked.where(sound).select(*typed), errors, history.select(*load_id, "*", status))


def _refuse_more(errors: DataFrame, max_errors: int, shown: int = 10) -> None:
    """Raise if there are more errors than allowed; no more than a few are sorted out and reach the driver."""
    count = errors.limit(max_errors + 1).count()
    if count > max_errors:
        first = errors.orderBy("file_name", "line_number", "column_name").limit(shown).collect()
        told = "; ".join(f"{r['file_name'].rsplit('/', 1)[-1]} line {r['line_number']} {r['column_name']}: {r['error_message']} {r['raw_value']!r:.60}" for r in first)
        raise LoadFailed(f"more than {max_errors} errors, the first: {told}")


def errors_of_load(errors: DataFrame, query_id: int) -> DataFrame:
    return errors.where(F.col("query_id") == query_id)


def newest_errors(errors: DataFrame) -> DataFrame:
    """Load errors, newest first.

    All errors of a load have one time, and many may have one value: the further columns, the last of which
    differs in every row, let the sort spread them over tasks.
    """
    rows = errors.withColumn("_row", F.monotonically_increasing_id())
    place = [name for name in ("file_name", "line_number", "column_name", "raw_value") if name in errors.columns]
    return rows.orderBy(F.desc("start_time"), "query_id", *place, "_row").drop("_row")
