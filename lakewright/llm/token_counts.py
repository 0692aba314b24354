"""Exact histogram of encoded lengths, and what it answers for every context limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewright.llm.encoder import worker_encoder
from lakewright.llm.graph import saved
from lakewright.llm.texts import map_batches, strings_of

BLOCK = 256  # lengths that are summed up together before their sums are carried on


def encoded_lengths(docs: DataFrame, tokenizer: str, keeps_space: bool = True, end_ids: int = 1) -> DataFrame:
    """(length): ids of each whole text, and ``end_ids`` more. A null text is empty; no row is left out."""

    def convert(batch):
        lengths = worker_encoder(tokenizer, keeps_space).lengths(strings_of(batch.column("text")))
        return {"length": lengths + end_ids}

    return map_batches(docs.select("text"), "length bigint", convert)


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per distinct length, with prefix and suffix sums over all documents.

    length, n_docs; docs_at_least and tokens_at_least count the documents at least this long;
    truncated_tokens is the total when every document is cut to this length; share_at_most is the share of
    documents that fit whole. Lengths are summed by block first, so no task sees more than one block's
    lengths or one row per block. An empty table gives no rows.
    """
    # Written out, as the lengths are costly and read twice below.
    counts = saved(lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
    counts = counts.withColumn("_block", F.floor(F.col("length") / BLOCK))
    tokens = F.col("length") * F.col("n_docs")
    blocks = counts.groupBy("_block").agg(F.sum("n_docs").alias("_docs"), F.sum(tokens).alias("_tokens"))
    later = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_docs").over(later), F.lit(0)).alias("_docs_after"),
        F.coalesce(F.sum("_tokens").over(later), F.lit(0)).alias("_tokens_after"),
        F.sum("_docs").over(everything).alias("_all_docs"),
        F.sum("_tokens").over(everything).alias("_all_tokens"),
    )
    here = Window.partitionBy("_block").orderBy(F.desc("length"))
    docs_at_least = F.sum("n_docs").over(here) + F.col("_docs_after")
    tokens_at_least = F.sum(tokens).over(here) + F.col("_tokens_after")
    summed = counts.join(blocks, "_block").select(
        "length",
        "n_docs",
        docs_at_least.alias("docs_at_least"),
        tokens_at_least.alias("tokens_at_least"),
        "_all_docs",
        "_all_tokens",
    )
    cut = F.col("_all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")
    longer = F.col("docs_at_least") - F.col("n_docs")
    return summed.select(
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        cut.alias("truncated_tokens"),
        ((F.col("_all_docs") - longer) / F.col("_all_docs")).alias("share_at_most"),
    )


def at_limits(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, docs_over, truncated_tokens) for any limits, from the histogram alone."""
    spark = histogram.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in limits], "context_limit bigint")
    over = F.col("length") > F.col("context_limit")
    cut = F.least("length", "context_limit") * F.col("n_docs")
    # The limits are a short list given by the caller; the histogram is scanned once for all of them.
    joined = wanted.join(histogram.select("length", "n_docs"), F.lit(True), "left")
    return joined.groupBy("context_limit").agg(
        F.coalesce(F.sum(F.when(over, F.col("n_docs")).otherwise(0)), F.lit(0)).alias("docs_over"),
        F.coalesce(F.sum(cut), F.lit(0)).alias("truncated_tokens"),
    )


def length_quantiles(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the least length that at least this share of the documents does not exceed."""
    answers = [
        F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("share_at_most") >= s, F.col("length"))).alias("length"))
        for s in shares
    ]
    return histogram.agg(F.array(*answers).alias("a")).select(F.inline("a"))
