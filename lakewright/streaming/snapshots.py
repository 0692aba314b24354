"""A table's newest state, kept up to date by a stream of changes.

The state has one row for each key, its newest change, in a partition that the key's hash decides. A batch of changes is merged into
the partitions of its keys and into no others. A deleted key keeps its row, as a mark: a change that arrives late is older than that and
stays without effect. Merging the same changes again gives the same state, so a batch that is repeated after a crash does no harm; one
that is noted as merged is not even looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright import storage
from lakewright.operators.changes import newest_per_key, project_to
from lakewright.plans.catalog import register_external
from lakewright.sinks.swaps import finish_swaps
from lakewright.sinks.tables import replace_partitions

BUCKET = "_bucket"
NOTES = "_batches"  # folder of the notes on merged batches, under the root of the state's versions


@dataclass(frozen=True)
class Snapshot:
    """A state table: its name, the folder of its versions, what makes a key, what orders changes, and which are deletes."""

    table: str
    root: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    op: str
    delete_value: str = "delete"
    buckets: int = 64

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows of keys that are not deleted."""
        kept = ~F.coalesce(F.col(self.op) == self.delete_value, F.lit(False))
        return spark.table(self.table).where(kept).drop(BUCKET)


def create_snapshot(
    spark: SparkSession,
    database: str,
    table: str,
    schema: T.StructType,
    root: str,
    keys: Sequence[str],
    order: Sequence[str],
    op: str,
    delete_value: str = "delete",
    buckets: int = 64,
) -> Snapshot:
    """An empty state table. ``buckets`` is how many partitions the keys are dealt to: a batch rewrites those of its keys."""
    if missing := {*keys, *order, op} - set(schema.names):
        raise ValueError(f"the changes have no columns {sorted(missing)}")
    empty = spark.createDataFrame([], schema.add(BUCKET, T.IntegerType()) if BUCKET not in schema.names else schema)
    storage.make_folder(spark, f"{root.rstrip('/')}/empty")
    register_external(spark, empty, database, table, f"{root.rstrip('/')}/empty", partition_by=(BUCKET,))
    return Snapshot(f"{database}.{table}", root.rstrip("/"), tuple(keys), tuple(order), op, delete_value, buckets)


def merge_changes(snapshot: Snapshot, changes: DataFrame, batch: str) -> bool:
    """Merge a batch of changes into the state, unless the batch is noted as merged; whether it was merged now.

    Changes to one key are settled by the order columns, across batches too; equal ones by their other columns, so that the
    result does not hang on the order of arrival. Rows without a key are one key, as in ``newest_per_key``.
    """
    spark = changes.sparkSession
    note = f"{snapshot.root}/{NOTES}/{batch}"
    if storage.exists(spark, note):
        return False
    finish_swaps(spark, snapshot.table, [BUCKET], snapshot.root)
    state = spark.table(snapshot.table)
    plain = [f.name for f in state.schema if f.name != BUCKET]
    bucket = F.pmod(F.xxhash64(*snapshot.keys), F.lit(snapshot.buckets)).cast("int")
    # A batch is reduced to a row for each key before it meets the state.
    fresh = _newest(project_to(changes, state.select(*plain)), snapshot).withColumn(BUCKET, bucket)
    touched = fresh.select(BUCKET).distinct()  # at most as many as there are buckets
    listed = [row[0] for row in touched.collect()]
    if listed:
        held = state.where(F.col(BUCKET).isin(listed)).select(*plain, BUCKET)
        merged = _newest(held.unionByName(fresh), snapshot).select(*state.columns)
        replace_partitions(snapshot.table, merged, spark.createDataFrame([(b,) for b in listed], f"{BUCKET} int"), snapshot.root)
    storage.write_text(spark, note, batch)
    return True


def _newest(rows: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The newest row of each key; of several with the same order, the one with the greatest hash of all its values."""
    tie = F.xxhash64(*(F.col(f"`{f.name}`") for f in rows.schema if f.name != BUCKET and not isinstance(f.dataType, T.MapType)))
    return newest_per_key(rows.withColumn("_tie", tie), snapshot.keys, [*snapshot.order, "_tie"]).drop("_tie")


def keep_snapshot(stream: DataFrame, snapshot: Snapshot, checkpoint: str, stream_name: str = "changes") -> None:
    """Merge everything that has arrived on a stream of changes into the state, then stop.

    Batches are numbered by the stream's checkpoint; ``stream_name`` tells the batches of several streams apart.
    """

    def merge(batch: DataFrame, number: int) -> None:
        merge_changes(snapshot, batch, f"{stream_name}-{number}")

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def forget_deleted(spark: SparkSession, snapshot: Snapshot, before: object) -> int:
    """Drop the marks of keys whose delete has a first order column below ``before``; how many partitions were rewritten.

    Changes older than that must not arrive any more: one that does would bring its key back.
    """
    state = spark.table(snapshot.table)
    gone = F.coalesce((F.col(snapshot.op) == snapshot.delete_value) & (F.col(snapshot.order[0]) < F.lit(before)), F.lit(False))
    touched = state.where(gone).select(BUCKET).distinct()
    listed = [row[0] for row in touched.collect()]
    if listed:
        kept = state.where(F.col(BUCKET).isin(listed)).where(~gone)
        replace_partitions(snapshot.table, kept, spark.createDataFrame([(b,) for b in listed], f"{BUCKET} int"), snapshot.root)
    return len(listed)
