"""File manifests: ``file@@@delete_query`` entries and the envelope sent to a loader."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "@@@"  # fixed value


def manifest_file(entry: Column) -> Column:
    return F.get(F.split(entry, SEPARATOR), F.lit(0))


def manifest_delete_query(entry: Column) -> Column:
    """The second part; NULL where the entry has none. Further parts are ignored."""
    return F.get(F.split(entry, SEPARATOR), F.lit(1))


def manifest_record(entry: Column, bucket: str | Column) -> Column:
    bucket = bucket if isinstance(bucket, Column) else F.lit(bucket)
    return F.struct(
        F.struct(
            F.struct(bucket.alias("name")).alias("bucket"),
            F.struct(manifest_file(entry).alias("key")).alias("object"),
            manifest_delete_query(entry).alias("delete_query"),
        ).alias("s3")
    )


def manifest_envelope(
    entries: Column,
    bucket: str | Column,
    triggered: bool = True,
    errors: Column | None = None,
) -> Column:
    """One envelope per row from an array of entries, so its size is that row's own array.

    ``errors`` is JSON text and becomes that value itself, an object for a mapping. No errors give the number
    ``0``; no entries give an empty record list.
    """
    # The names of the envelope's fields and the text "done" are fixed values.
    records = F.transform(entries, lambda entry: manifest_record(entry, bucket))
    nothing = F.filter(F.array(manifest_record(F.lit(""), bucket)), lambda _: F.lit(False))
    return F.struct(
        F.struct(F.lit("done").alias("execution")).alias("data"),
        F.coalesce(records, nothing).alias("Records"),
        F.lit(triggered).alias("StepFunctionTriggered"),
        F.parse_json(F.lit("0") if errors is None else F.coalesce(errors, F.lit("0"))).alias("Errors"),
    )
