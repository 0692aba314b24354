"""Files of delete commands: read by Spark, sorted into keys and predicates, and never run as they stand."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.sources.files import list_files

MAX_PREDICATES = 10_000  # statements other than plain key deletes, which the driver has parsed one by one

# What a predicate may hold besides columns and literals, by the names of Spark's own expressions.
_COMPARISONS: dict[str, Callable[..., Column]] = {
    "And": lambda a, b: a & b,
    "EqualNullSafe": lambda a, b: a.eqNullSafe(b),
    "EqualTo": lambda a, b: a == b,
    "GreaterThan": lambda a, b: a > b,
    "GreaterThanOrEqual": lambda a, b: a >= b,
    "In": lambda a, *values: a.isin(*values),
    "IsNotNull": lambda a: a.isNotNull(),
    "IsNull": lambda a: a.isNull(),
    "LessThan": lambda a, b: a < b,
    "LessThanOrEqual": lambda a, b: a <= b,
    "Like": lambda a, b: F.like(a, b),
    "Not": lambda a: ~a,
    "Or": lambda a, b: a | b,
}
_STATEMENT = r"(?is)^\s*DELETE\s+FROM\s+([`\w.]+)\s+WHERE\s+(.+?)\s*$"
_EQUALITY = r"(?s)^`?([A-Za-z_]\w*)`?\s*=\s*(-?\d{1,18}|'[^'\\]*')$"


class RefusedStatement(ValueError):
    """A statement that is not a delete by a predicate of columns, literals and comparisons."""


def read_delete_commands(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, statement, table_name, key_columns, key_values) of the statements in files under ``path``.

    A semicolon ends a statement. The last three columns are set for plain key deletes only, ``column = literal`` joined by AND, with
    whole numbers or text without quotes or backslashes as literals: those are taken apart here, by Spark, however many there are. All
    others are left to Spark's parser, see ``parsed``.
    """
    pieces = spark.read.option("lineSep", ";").text(path).select(F.col("_metadata.file_path").alias("file_name"), F.trim(F.translate("value", "\r\n\t", "   ")).alias("flat"), "value")
    spoken = pieces.where("flat <> ''")
    head, predicate = (F.regexp_extract("value", _STATEMENT, group) for group in (1, 2))
    parts = F.split(predicate, r"(?i)\s+AND\s+")
    names = F.transform(parts, lambda part: F.lower(F.regexp_extract(F.trim(part), _EQUALITY, 1)))
    values = F.transform(parts, lambda part: F.regexp_extract(F.trim(part), _EQUALITY, 2))
    plain = (head != "") & ~F.array_contains(names, "") & (F.size(F.array_distinct(names)) == F.size(names))
    order = F.array_sort(F.arrays_zip(names.alias("name"), values.alias("value")))  # one list for each set of columns
    return spoken.select(
        "file_name",
        F.trim("value").alias("statement"),
        F.when(plain, F.lower(F.translate(head, "`", ""))).alias("table_name"),
        F.when(plain, F.transform(order, lambda pair: pair["name"])).alias("key_columns"),
        F.when(plain, F.transform(order, lambda pair: pair["value"])).alias("key_values"),
    )


def delete_file(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{day.isoformat()}.sql"


def existing_delete_file(spark: SparkSession, root: str, day: dt.date) -> str | None:
    """The file of a day's delete commands if there is one."""
    path = delete_file(root, day)
    try:
        return None if list_files(spark, path).isEmpty() else path
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@dataclass(frozen=True)
class Predicate:
    """A checked delete: the table as named, lower-cased; which rows go; the columns that this depends on."""

    table_name: str
    condition: Column
    columns: tuple[str, ...]


def parsed(spark: SparkSession, statement: str) -> Predicate:
    """A statement through Spark's own parser; anything but a delete by comparisons of columns and literals is refused."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    except (ParseException, Py4JJavaError) as error:
        raise RefusedStatement(f"cannot parse {statement!r}") from error
    kind, relation, alias = _kind(plan), None, None
    if kind == "DeleteFromTable":
        relation = plan.child()
        if _kind(relation) == "SubqueryAlias":
            alias, relation = relation.alias().lower(), relation.child()
    if relation is None or _kind(relation) != "UnresolvedRelation":
        raise RefusedStatement(f"not a delete from a table: {statement!r}")
    name = _names(relation.multipartIdentifier())
    prefixes = {(alias,)} if alias else {tuple(name), tuple(name[-1:])}
    columns: list[str] = []
    condition = _column(plan.condition(), statement, columns, prefixes)
    if not columns:
        raise RefusedStatement(f"names no column, so it would take all rows or none: {statement!r}")
    return Predicate(".".join(name), condition, tuple(dict.fromkeys(columns)))


def _kind(node: JavaObject) -> str:
    return node.getClass().getSimpleName()


def _names(names: JavaObject) -> list[str]:
    return [names.apply(i).lower() for i in range(names.size())]


def _column(node: JavaObject, statement: str, columns: list[str], prefixes: set[tuple[str, ...]]) -> Column:
    """The column expression that a parsed one stands for; its columns are added to ``columns``."""
    kind = _kind(node)
    if kind == "Literal":
        return F.expr(node.sql())
    if kind == "UnresolvedAttribute":
        *prefix, name = _names(node.nameParts())
        if prefix and tuple(prefix) not in prefixes:
            raise RefusedStatement(f"reads a part of a column, or another table: {statement!r}")
        columns.append(name)
        return F.col(f"`{name}`")
    build = _COMPARISONS.get(kind)
    if kind == "UnresolvedFunction" and _names(node.nameParts()) == ["between"]:
        build = Column.between
    if build is None:
        raise RefusedStatement(f"{kind} is not allowed in {statement!r}")
    children = node.children()
    if kind == "Like" and node.escapeChar() != "\\":
        raise RefusedStatement(f"LIKE with an escape character of its own is not allowed in {statement!r}")
    return build(*(_column(children.apply(i), statement, columns, prefixes) for i in range(children.size())))
