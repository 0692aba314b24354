"""The registered queries of this subpackage, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm import ball_tree, byte_bpe, collocations, decontamination, near_dup, packing, pii, quality, scoring, search, sharding, token_counts, token_files
from lakewright.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query
def op1_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.digest(pii.find_spans(docs, pii.train_model(docs)))


@_query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    docs = _table(spark, sf_dir, "documents")
    token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.with_checksums(token_files.read_tokens(spark, path))


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    lengths = token_counts.encoded_lengths(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.length_histogram(lengths)


@_query
def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=16)


@_query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


@_query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.digest(decontamination.find_windows(docs, items))


@_query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.digest(near_dup.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80))


@_query
def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.digest(quality.score_documents(docs, quality.train_model(docs, labels)))


@_query
def op6_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_held_out(_table(spark, sf_dir, "documents"), folds=7, held_out=2)


@_query
def op10_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    asked = docs.where(F.col("doc_id") % 20 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return search.top_k(docs, asked, k=10)


@_query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)
    return byte_bpe.digest(byte_bpe.decode_documents(encoded.drop("text"), ranks))


@_query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return ball_tree.rank_documents(docs, items, k=10)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op7_decontamination"] = f"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), items AS (
    SELECT item_id, words, least(10, len(words)) AS size
    FROM (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark)
    WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[i : i + size - 1], ' ') AS run
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM items)
), places AS (
    SELECT doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS run
    FROM (SELECT doc_id, words, size, unnest(range(1, greatest(len(words) - size + 2, 1))) AS i FROM texts, (SELECT DISTINCT size FROM items))
), hits AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, run)),
covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY doc_id),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

ORACLES["op12_ranked_search"] = f"""
WITH found AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents
), asked AS (
    SELECT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
), counts AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM found GROUP BY ALL),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
), scored AS (
    SELECT item_id, doc_id,
           CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
    FROM (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL)
    JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@_query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("text")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), listed AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
), ones AS (
    SELECT lang, word, count(*) AS f FROM (SELECT lang, unnest(words) AS word FROM listed) GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM ones GROUP BY ALL),
twos AS (
    SELECT lang, w[1] AS w1, w[2] AS w2, count(*) AS f
    FROM (SELECT lang, unnest(list_transform(range(1, len(words)), lambda i: words[i : i + 1])) AS w FROM listed) GROUP BY ALL
), threes AS (
    SELECT lang, w[1] AS w1, w[2] AS w2, w[3] AS w3, count(*) AS f
    FROM (SELECT lang, unnest(list_transform(range(1, len(words) - 1), lambda i: words[i : i + 2])) AS w FROM listed) GROUP BY ALL
), two AS (
    SELECT t.lang, t.w1, t.w2, t.f AS a, x.f AS l, y.f AS r, 1000000 * CAST(t.f AS HUGEINT) * t.f // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM twos t JOIN ones x ON x.lang = t.lang AND x.word = t.w1 JOIN ones y ON y.lang = t.lang AND y.word = t.w2 WHERE t.f >= 10
), three AS (
    SELECT t.lang, t.w1, t.w2, t.w3, t.f AS a, x.f AS l1, p.f AS r1, q.f AS l2, y.f AS r2,
           1000000 * CAST(t.f AS HUGEINT) * t.f // (CAST(x.f AS HUGEINT) * p.f) AS s1,
           1000000 * CAST(t.f AS HUGEINT) * t.f // (CAST(q.f AS HUGEINT) * y.f) AS s2
    FROM threes t JOIN ones x ON x.lang = t.lang AND x.word = t.w1 JOIN ones y ON y.lang = t.lang AND y.word = t.w3
    JOIN twos p ON p.lang = t.lang AND p.w1 = t.w2 AND p.w2 = t.w3 JOIN twos q ON q.lang = t.lang AND q.w1 = t.w1 AND q.w2 = t.w2
    WHERE t.f >= 10
), inside AS (
    SELECT lang, w1, w2, max(a) AS longer FROM (SELECT lang, w1, w2, a FROM three UNION ALL SELECT lang, w2, w3, a FROM three) GROUP BY ALL
), candidates AS (
    SELECT lang, w1 || ' ' || w2 AS phrase, a, l, r, score
    FROM two LEFT JOIN inside USING (lang, w1, w2) WHERE longer IS NULL OR 100 * longer < 50 * a
    UNION ALL
    SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
    FROM three
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
    FROM candidates JOIN totals USING (lang)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
