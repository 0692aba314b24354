"""Delete commands applied to a table: key deletes as anti-joins, all other predicates as one."""

from __future__ import annotations

from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.operators.changes import delete_where
from lakewright.operators.keyed_joins import matching_keys
from lakewright.sources.commands import MAX_PREDICATES, RefusedStatement, parsed

MAX_KEY_SETS = 32  # different sets of key columns; each is one anti-join


def apply_delete_commands(df: DataFrame, commands: DataFrame, table: str) -> DataFrame:
    """The rows of ``df`` that no command for ``table`` deletes; ``commands`` as ``read_delete_commands`` gives them.

    As in SQL, a row goes if a predicate is TRUE of it; where that is unknown it stays. Key deletes meet the rows in one
    anti-join for each set of key columns, in whatever number; the others, at most MAX_PREDICATES, become one predicate, so the table
    is read once. Commands name the table with or without its database, in any case. Commands for other tables are
    checked too and then passed over; a statement that is no delete by comparisons of columns and literals, or
    names a column that ``df`` lacks, is an error, and then no command is applied.
    """
    spark, own = df.sparkSession, table.lower().replace("`", "")
    wanted = _name_matches(F.col("table_name"), own)
    integral = _columns_of(df, T.IntegralType)
    texts = _columns_of(df, T.StringType)
    keyed = commands.where(F.col("table_name").isNotNull() & wanted)
    fits = F.forall(
        F.arrays_zip(F.col("key_columns").alias("c"), F.col("key_values").alias("v")),
        lambda pair: F.when(pair["v"].startswith("'"), pair["c"].isin(*texts)).otherwise(pair["c"].isin(*integral)),
    )
    # Literals of another type than their column are compared as Spark does it.
    other = commands.where(F.col("table_name").isNull() | (wanted & ~fits)).select("statement").distinct().limit(MAX_PREDICATES + 1).collect()
    if len(other) > MAX_PREDICATES:
        raise RefusedStatement(f"more than {MAX_PREDICATES} statements besides plain key deletes")
    predicates = [p for p in (parsed(spark, row["statement"]) for row in other) if _is_table(p.table_name, own)]
    known = {f.name.lower() for f in df.schema}
    for predicate in predicates:
        if unknown := set(predicate.columns) - known:
            raise RefusedStatement(f"{table} has no columns {sorted(unknown)}")

    simple = keyed.where(fits)
    sets = [row["key_columns"] for row in simple.select("key_columns").distinct().limit(MAX_KEY_SETS + 1).collect()]
    if len(sets) > MAX_KEY_SETS:
        raise RefusedStatement(f"more than {MAX_KEY_SETS} different sets of key columns")
    for columns in sorted(sets):
        same = F.col("key_columns") == F.array(*map(F.lit, columns))
        keys = simple.where(same).select(*(_key(df, F.col("key_values")[i], name) for i, name in enumerate(columns)))
        df = matching_keys(df, keys.where(" AND ".join(f"`{n}` IS NOT NULL" for n in keys.columns)), keys.columns, keep=False)
    return delete_where(df, _any([p.condition for p in predicates])) if predicates else df


def _columns_of(df: DataFrame, kind: type[T.DataType]) -> list[str]:
    return [f.name.lower() for f in df.schema if isinstance(f.dataType, kind)]


def _key(df: DataFrame, text: Column, name: str) -> Column:
    """A literal's value under the name and type that its column has in the table; NULL where the type cannot hold it."""
    field = next(f for f in df.schema if f.name.lower() == name)
    plain = F.regexp_replace(text, r"(?s)^'(.*)'$", "$1")
    return (plain if isinstance(field.dataType, T.StringType) else plain.try_cast(field.dataType)).alias(field.name)


def _name_matches(name: Column, own: str) -> Column:
    return (name == own) | ((F.element_at(F.split(name, r"\."), -1) == own.rpartition(".")[2]) & (F.lit("." not in own) | ~name.contains(".")))


def _is_table(name: str, own: str) -> bool:
    return name == own or (name.rpartition(".")[2] == own.rpartition(".")[2] and not ("." in name and "." in own))


def _any(conditions: list[Column]) -> Column:
    """Conditions joined by OR in pairs of pairs: the expression is as deep as the logarithm of their number."""
    while len(conditions) > 1:
        pairs = zip(conditions[::2], conditions[1::2], strict=False)
        conditions = [or_(*pair) for pair in pairs] + (conditions[-1:] if len(conditions) % 2 else [])
    return conditions[0]
