"""Jump consistent hashing: stable keys to shards, without a ring and without Python.

A key's jumps are a pseudo-random sequence of shard numbers that depends on the key alone; the key lives in the
last one below the number of shards. One more shard therefore takes over just the keys that jump to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.session import shuffle_partitions

_STEPS = 1 << 31  # resolution of the random numbers


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a key (64-bit hash or integer; a null key counts as one more key).

    With r uniform in (0, 1], drawn from the key and the number of the draw, the jump from shard b goes to
    floor((b + 1) / r). Jumps only go up, so ``shards`` draws are enough for any key.
    """
    if shards < 1:
        raise ValueError("there must be a shard")

    def draw(step: Column) -> Column:
        return (F.pmod(F.xxhash64(key, step), F.lit(_STEPS)) + 1) / F.lit(float(_STEPS))

    def jump(state: Column, step: Column) -> Column:
        target = F.floor((state["shard"] + 1) / draw(step))
        moves = ~state["done"] & (target < shards)
        return F.struct(F.when(moves, target).otherwise(state["shard"]).alias("shard"), (~moves).alias("done"))

    start = F.struct(F.lit(0).cast("bigint").alias("shard"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump)["shard"].cast("int")


def assign_shards(df: DataFrame, key: str, shards: int, order: tuple[str, ...] = ()) -> DataFrame:
    """Add shard, grown_shard (with one shard more) and slot, the row's place in its shard from 0 without gaps.

    Rows of a shard are numbered by slice: slices are dealt by hash of the key and of the columns in
    ``order``, numbered each for itself, and moved up by the size of the slices before. A slice is a small part of
    a shard at any size, also when many rows share a key. Rows equal in all of them may swap their slots. An
    empty table gives no rows.
    """
    slices = 4 * max(4, shuffle_partitions(df.sparkSession) // shards + 1)
    spread = F.pmod(F.xxhash64(F.lit("slice"), key, *order), F.lit(slices)).cast("int")
    marked = df.select(
        "*",
        jump_shard(F.col(key), shards).alias("shard"),
        jump_shard(F.col(key), shards + 1).alias("grown_shard"),
        spread.alias("_slice"),
    )
    sizes = marked.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # shards x slices rows: a number that follows the settings and not the data.
    bases = sizes.select("shard", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("shard", "_slice").orderBy(key, *order)
    numbered = marked.withColumn("_row", F.row_number().over(within) - 1)
    placed = numbered.join(F.broadcast(bases), ["shard", "_slice"])
    return placed.withColumn("slot", (F.col("_base") + F.col("_row")).cast("bigint")).drop("_slice", "_base", "_row")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Put documents into shards by ``doc_id``, under the law ``key``: the id and the number of shards decide.

    doc_id, size (UTF-8 bytes of the text and 1), text_crc32 (of the UTF-8; a null text is empty), law, shard,
    slot, grown_shard. The text itself is not shuffled. Rows without an id share one shard.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    measured = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).cast("bigint").alias("text_crc32"),
    )
    placed = assign_shards(measured, "doc_id", shards, ("size", "text_crc32"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
