"""Token ids in ORC files: integer run-length encoding, row indexes, Bloom filters on document ids.

Rows stand in ascending ``doc_id`` order over the files and within them, so the statistics of a file, a
stripe or a row group bound its ids; Bloom filters settle the rest. Readers split files by stripe.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewright.llm.encoder import worker_encoder
from lakewright.llm.texts import map_batches, portions, strings_of

STRIPE_BYTES = 16 << 20
ROWS_PER_INDEX = 1000
REMEMBERED = 700_000  # chunks that a worker keeps the ids of

FILE_SCHEMA = "doc_id bigint, file_start bigint, n_tokens bigint, ids array<int>"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    keeps_space: bool = True,
    stripe_bytes: int = STRIPE_BYTES,
    rows_per_index: int = ROWS_PER_INDEX,
) -> None:
    """Encode ``docs`` (doc_id, text) and write the ids under ``path``.

    Each text's ids are followed by ``end_id``; a null text is empty. Rows without an id come first, rows
    with the same id stand together in any order, and further columns of ``docs`` are not written. An empty
    table gives a table without rows. ``file_start`` counts the ids of the file before the row.
    """
    # The text's hash splits the rows of an id, or of no id, that would overload one task.
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("_tie"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .drop("_tie")
    )

    def encode(batches):
        encoder, written = worker_encoder(tokenizer, keeps_space, REMEMBERED), 0
        for batch in batches:
            for portion in portions(batch):
                ids, bounds = encoder.encode(strings_of(portion.column("text")), end_id)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
                starts = pa.array(bounds[:-1] + written, pa.int64())
                lengths = pa.array(np.diff(bounds), pa.int64())
                names = ["doc_id", "file_start", "n_tokens", "ids"]
                yield pa.RecordBatch.from_arrays([portion.column("doc_id"), starts, lengths, lists], names=names)
                written += int(bounds[-1])

    (
        ordered.mapInArrow(encode, FILE_SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", rows_per_index)
        .option("orc.stripe.size", stripe_bytes)
        .option("maxRecordsPerFile", 0)  # a task writes one file, so its counts are the file's
        .option("compression", "zstd")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids); ``start`` counts the ids of all rows before it.

    Filters on ``doc_id`` and the choice of columns reach the files. The one frame that is broadcast has two
    numbers for each file.
    """
    rows = spark.read.schema(FILE_SCHEMA).orc(path).withColumn("_file", _file_number())
    totals = rows.groupBy("_file").agg(F.sum("n_tokens").alias("_ids"))
    before = F.coalesce(F.sum("_ids").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = totals.select("_file", before.alias("_base"))
    return rows.join(F.broadcast(bases), "_file").select(
        "doc_id", (F.col("_base") + F.col("file_start")).alias("start"), "n_tokens", "ids"
    )


def _file_number():
    """Spark numbers its files by partition, and a range partitioning numbers its partitions in order."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int")


def with_checksums(tokens: DataFrame) -> DataFrame:
    """Replace the ids of each row by their unsigned crc32, as little-endian unsigned 32-bit integers."""

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        lists = batch.column("ids")
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        bounds = lists.offsets.to_numpy()
        crcs = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return {name: batch.column(name) for name in ("doc_id", "start", "n_tokens")} | {"ids_crc32": crcs}

    return map_batches(tokens, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", convert, "ids")
