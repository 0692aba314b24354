"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns that ``docs`` came with.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm import decontamination, near_dup, packing, pii, quality
from lakewright.llm.graph import saved, small_batches

#: SQL has no tokenizer, no sketches and no trained models; tests compare the stages with brute force instead.
ORACLE_SQL = None


def _plain(docs: DataFrame) -> DataFrame:
    """``docs`` with its further columns under names that no operator uses."""
    return docs.select(*(F.col(f"`{name}`").alias(new) for name, new in _names(docs)))


def _names(docs: DataFrame) -> list[tuple[str, str]]:
    return [(name, name if name in ("doc_id", "text") else f"__column_{i}") for i, name in enumerate(docs.columns)]


def _same_columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``df`` with the columns, in the order and under the names, that ``docs`` has."""
    return df.select(*(F.col(new).alias(name) for name, new in _names(docs)))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. It is fitted on the labelled ones among them.

    Null and empty texts are scored like any other. Without labels all documents stay; an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    plain = _plain(docs)
    scored = quality.score_documents(plain, quality.train_model(plain, labels))
    return _same_columns(scored.where(F.col("predicted") == 1), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8 or more.

    The one with the smallest id stays. Texts without words, null ones among them, all stay; of rows that repeat id and text one stays.
    """
    return _same_columns(near_dup.without_copies(_plain(docs), words=5, percent=80), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark's questions and answers; null and empty texts stay."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontamination.find_windows(_plain(docs), benchmark)
    return _same_columns(found.where(F.size("hits") == 0), docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind; ``n_chars`` counts the new text. A null text stays null."""
    plain = _plain(docs)
    weights = pii.train_model(plain)
    with small_batches(spark):
        # Saved, as a task of both steps would hold two Python workers, and the executor keeps them for the stages that follow.
        found = saved(pii.find_spans(plain, weights), "spans", "zstd")
    redacted = _same_columns(pii.redact(found), docs)
    if "n_chars" in docs.columns:
        changed = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
        redacted = redacted.withColumn("n_chars", changed)
    return redacted


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 4096 tokens; a null text is the end token alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicate removal", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; returns the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return docs
