"""Row-level changes to a table: snapshot, delete, anonymise, upsert, append."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.functions.masking import mask_columns
from lakewright.operators.keyed_joins import key_profile, matching_keys


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key.

    Spark applies the limit of one row per key before the shuffle as well as after it, so a key
    with a third of all rows sends only one row per task. Rows without a key are one group, as in a SQL
    GROUP BY, of which the newest stays; an upsert, like a SQL merge, keeps each of them.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order))
    return df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")


def latest_snapshot(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str, delete_value: str = "delete"
) -> DataFrame:
    """The state of a table after its change rows: newest row per key, deleted keys left out."""
    newest = newest_per_key(changes, keys, order)
    return newest.where(~F.coalesce(F.col(op) == delete_value, F.lit(False)))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Remove rows for which the predicate is TRUE; rows where it is NULL stay."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_keys(
    df: DataFrame, keys: DataFrame, on: Sequence[str], broadcast_bytes: int | None = None
) -> DataFrame:
    """Remove the rows whose key is listed."""
    return matching_keys(df, keys, on, keep=False, broadcast_bytes=broadcast_bytes)


def anonymise_subjects(
    df: DataFrame,
    subjects: DataFrame,
    on: Sequence[str],
    masks: Mapping[str, str],
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """The rows of the listed subjects, with the given columns masked."""
    return mask_columns(matching_keys(df, subjects, on, keep=True, broadcast_bytes=broadcast_bytes), masks)


def upsert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    newest_by: Sequence[str] | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Source rows replace the target rows of the same key; other source rows are added.

    Several source rows for one key are settled by ``newest_by``; without it they are an error.
    Rows without a key equal no other row, as in a SQL merge: they are all added. Values are cast to the target's
    types; a source column that the target lacks is an error.
    """
    unknown = set(source.columns) - set(target.columns)
    if unknown:
        raise ValueError(f"the target has no columns {sorted(unknown)}")
    keyless = reduce(or_, (F.col(c).isNull() for c in on))
    keys, key_bytes = source.where(~keyless), None
    if newest_by:
        source = newest_per_key(keys, on, newest_by).unionByName(source.where(keyless))
    else:
        key_bytes, most_rows = key_profile(keys, on)
        if most_rows > 1:
            raise ValueError(f"several source rows share a key {list(on)}; pass newest_by to pick one")
    untouched = matching_keys(target, keys, on, False, broadcast_bytes, key_bytes)
    return project_to(source, target).unionByName(untouched)


def append_by_position(target: DataFrame, incoming: DataFrame) -> DataFrame:
    return target.union(incoming)


def project_to(df: DataFrame, target: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Columns matched by name onto the target's columns and types: absent ones are NULL, others dropped.

    Without any match every value would be lost, so that is an error.
    """
    plain = str.lower if ignore_case else str
    present = {plain(name): name for name in df.columns}
    if len(present) < len(df.columns):
        raise ValueError(f"columns {df.columns} differ only in case")
    if not any(plain(f.name) in present for f in target.schema):
        raise ValueError(f"none of the columns {df.columns} is one of {target.columns}")
    return df.select(
        *(
            (F.col(f"`{present[plain(f.name)]}`") if plain(f.name) in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        )
    )


def append_by_name(target: DataFrame, incoming: DataFrame) -> DataFrame:
    return target.unionByName(project_to(incoming, target))
