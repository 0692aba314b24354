"""Language-model scores by context-tree weighting over the binary decisions of bytes, beside a unigram base.

The trees are those of ``context_tree``: contexts are the bytes before as they stand, all that occur are counted, and
they are weighted in Spark. Words of the base are looked up if frequent and joined if not.

``counter_keys`` and ``weigh`` are a small form of the same weighting in memory, over classes of bytes. No query uses
them; tests hold the recursion against brute force with them.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm import context_tree
from lakewright.llm.graph import saved
from lakewright.llm.texts import add_columns, id_remainder, portions, utf8_of

CLASS_DEPTH, CLASS_BITS = 4, 5  # contexts: the classes of the last four bytes
PLACE_DEPTH, PLACE_BITS = 3, 6  # contexts: the byte's own class, then those of the last two bytes

TOP_WORDS = 200_000  # most frequent words, which tasks look up; all others are joined
TOP_WORD_BYTES = 64
HELD_WORDS = 300_000  # how many distinct words a task counts before it hands them on

_LOG10 = math.log(10)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """The class of every byte, and its place among the members."""
    of = np.full(256, 29, np.int32)
    of[97:123] = np.arange(26)
    of[32] = 26
    of[9:14] = 27
    of[48:58] = 28
    of[0xC0:] = 30
    of[0x80:0xC0] = 31
    place = np.zeros(256, np.int32)
    for c in range(32):
        members = np.flatnonzero(of == c)
        # More than 64 members cannot be: ASCII other than letters, digits and white space has under 100, of
        # which capitals never occur after lower-casing.
        members = members[(members < 65) | (members > 90)]
        place[members] = np.arange(len(members))
    return of, place


_CLASS, _PLACE = _classes()
_SEVERAL = np.bincount(_CLASS, minlength=32)[_CLASS] > 1
_END = 0xFF


def counter_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(class counter of each byte and end mark; place counter; whether it has one; bounds of the texts).

    Each text stands after CLASS_DEPTH end marks of its own, so it does not depend on its neighbours.
    """
    gap = bytes([_END]) * CLASS_DEPTH
    data = np.frombuffer(gap + gap.join(t.lower() for t in texts) + gap, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(bounds[-1]) + np.repeat(np.arange(1, len(texts) + 1) * CLASS_DEPTH - np.arange(len(texts)), sizes)
    # A text's symbols start after its gap; its end mark is the first of the next gap.
    kinds = _CLASS[data]
    code = np.zeros(len(at), np.int32)
    for back in range(1, CLASS_DEPTH + 1):
        code = (code << 5) | kinds[at - back]
    own, byte = kinds[at], data[at]
    classes = (code << CLASS_BITS) | own
    nearest = code >> (5 * (CLASS_DEPTH - PLACE_DEPTH + 1))
    places = (((own << (5 * (PLACE_DEPTH - 1))) | nearest) << PLACE_BITS) | _PLACE[byte]
    return classes, places, _SEVERAL[byte], bounds


def _decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each binary decision of a symbol went either way: counts by symbol to counts by node, from 1 on."""
    symbols = counts.shape[1]
    zeros, ones = np.zeros_like(counts), np.zeros_like(counts)
    level = counts
    while level.shape[1] > 1:
        half = level.shape[1] // 2
        zeros[:, half : 2 * half], ones[:, half : 2 * half] = level[:, 0::2], level[:, 1::2]
        level = level[:, 0::2] + level[:, 1::2]
    return zeros[:, :symbols], ones[:, :symbols]


def _symbol_logs(one: np.ndarray) -> np.ndarray:
    """log10 probability of each symbol from the probability of a 1 at each node."""
    symbols = one.shape[1]
    logs = np.zeros((len(one), symbols))
    symbol = np.arange(symbols)
    node = np.ones(symbols, np.int64)
    for bit in range(int(math.log2(symbols)) - 1, -1, -1):
        up = (symbol >> bit) & 1
        p = one[:, node]
        logs += np.log(np.where(up, p, 1 - p))
        node = 2 * node + up
    return (logs / _LOG10).astype(np.float32)


@dataclass
class Tree:
    """log10 probabilities of all symbols in every full context: a row for each, shared by contexts never seen."""

    row_of: np.ndarray
    logs: np.ndarray

    def log10(self, keys: np.ndarray, bits: int) -> np.ndarray:
        return self.logs[self.row_of[keys >> bits], keys & ((1 << bits) - 1)]


def weigh(keys: np.ndarray, counts: np.ndarray, depth: int, bits: int, least_depth: int = 0) -> Tree:
    """The mixture of all depths from ``least_depth`` on, from counters by context and symbol."""
    symbols = 1 << bits
    contexts, row = np.unique(keys >> bits, return_inverse=True)
    table = np.zeros((len(contexts), symbols))
    np.add.at(table, (row, keys & (symbols - 1)), counts)
    levels = [(contexts, table)]
    for _ in range(depth):
        deeper, table = levels[-1]
        contexts, row = np.unique(deeper >> 5, return_inverse=True)
        merged = np.zeros((len(contexts), symbols))
        np.add.at(merged, row, table)
        levels.append((contexts, merged))
    levels.reverse()  # by depth

    share: list[np.ndarray] = [np.empty(0)] * (depth + 1)  # weight of the node's own estimate
    own: list[np.ndarray] = [np.empty(0)] * (depth + 1)  # its probability of a 1
    below = None
    for d in range(depth, -1, -1):
        contexts, table = levels[d]
        zeros, ones = _decisions(table)
        coded = context_tree.log_gamma(zeros + 0.5) + context_tree.log_gamma(ones + 0.5) - context_tree.log_gamma(zeros + ones + 1) - math.log(math.pi)
        own[d] = (ones + 0.5) / (zeros + ones + 1)
        if below is None:
            weighted, share[d] = coded, np.ones_like(coded)
        else:
            children = np.zeros_like(coded)
            np.add.at(children, np.searchsorted(contexts, levels[d + 1][0] >> 5), below)
            if d < least_depth:
                weighted, share[d] = children, np.zeros_like(coded)
            else:
                weighted = np.logaddexp(coded, children) - math.log(2)
                share[d] = np.exp(coded - math.log(2) - weighted)
        below = weighted

    # Down the tree: what remains for deeper nodes, and what the nodes so far contribute.
    row_of = np.zeros(1 << (5 * depth), np.int32)
    rows = [np.full((1, symbols), 0.5)]
    total, passed = 1, None
    for d in range(depth + 1):
        contexts = levels[d][0]
        parent = np.searchsorted(levels[d - 1][0], contexts >> 5) if d else None
        left, got = (passed[0][parent], passed[1][parent]) if d else (np.ones_like(own[0]), np.zeros_like(own[0]))
        got = got + left * share[d] * own[d]
        left = left * (1 - share[d])
        passed = (left, got)
        rows.append(got + left * 0.5)  # a context below that was never seen knows nothing
        width = 1 << (5 * (depth - d))
        numbers = np.arange(total, total + len(contexts), dtype=np.int32)
        if len(contexts):
            grid = row_of.reshape(-1, width)
            grid[contexts] = numbers[:, None]
        total += len(contexts)
    return Tree(row_of, np.concatenate([_symbol_logs(np.clip(r, 1e-12, 1 - 1e-12)) for r in rows]))


@dataclass
class Model:
    trees: context_tree.Trees
    top: dict[bytes, int]  # frequent words and how often they occur
    words: DataFrame  # (word, n) of all words
    tokens: int  # N
    distinct: int  # V
    documents: int


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of ``docs`` (text): how often each word occurs; the null word counts the texts."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def rows(words, counts):
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts, pa.int64())], schema=schema)

    def run(batches):
        words: Counter[bytes] = Counter()
        documents = 0
        for batch in batches:
            for portion in portions(batch, size=2 << 20):
                texts = utf8_of(portion.column("text"))
                documents += len(texts)
                for text in texts:
                    words.update(text.lower().split())
                if len(words) > HELD_WORDS:
                    yield rows(list(words), list(words.values()))
                    words.clear()
        yield rows([*words, None], [*words.values(), documents])

    counted = docs.select("text").mapInArrow(run, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def train_model(docs: DataFrame) -> Model:
    """Count all of ``docs`` (text) and weigh the trees. Null texts are empty; no texts give a model that knows nothing."""
    trees = context_tree.train(docs)
    counts = saved(word_counts(docs), "counts")
    words = counts.where(F.col("word").isNotNull())
    documents = counts.where(F.col("word").isNull()).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    # The least frequency of which no more than TOP_WORDS words are: frequencies are counted in 16 steps an octave.
    step = F.floor(F.log2("n") * 16)
    steps = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.min("n").alias("least"))
    top_from, held, total, distinct = None, 0, 0, 0
    for row in steps.orderBy(F.desc("step")).collect():
        held, total, distinct = held + row["words"], total + row["n"], distinct + row["words"]
        if held <= TOP_WORDS:
            top_from = row["least"]
    frequent = (F.col("n") >= top_from) & (F.length("word") <= TOP_WORD_BYTES) if top_from else F.lit(False)
    found = words.where(frequent).toArrow()
    top = dict(zip(found["word"].to_pylist(), found["n"].to_pylist(), strict=True))
    return Model(trees, top, words, total + documents, distinct + (documents > 0), documents)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Add n_tokens, n_known, train_tokens, base_score and score to ``docs`` (text).

    Both scores are log10 probabilities of the whole lower-cased text with its end; a null text is empty and has
    only the end. Words that are not among the most frequent ones are joined to their counts. Columns with the names
    of new ones give way; all others, and all rows, stay.
    """
    spark = docs.sparkSession
    logs = {word: math.log10(n + 1) for word, n in model.top.items()}
    weights = spark.sparkContext.broadcast(logs)

    spent = [0]  # bytes of text in the task so far

    def convert(batch):
        known = weights.value
        texts = utf8_of(batch.column("text"))
        tokens, found, sums, rare = [], [], [], []
        for text in texts:
            words = text.lower().split()
            values = list(map(known.get, words))
            other = [w for w, value in zip(words, values, strict=True) if value is None] if None in values else []
            tokens.append(len(words) + 1)
            found.append(len(words) - len(other))
            sums.append(sum(value for value in values if value is not None) if other else sum(values))
            rare.append(other)
        number = (TaskContext.get().partitionId() << 32) + spent[0] // context_tree.SLICE_BYTES
        spent[0] += sum(map(len, texts))
        return {"n_tokens": tokens, "__lm_found": found, "__lm_sum": sums, "__lm_rare": rare, "__lm_slice": [number] * len(texts)}

    schema = "n_tokens bigint, __lm_found bigint, __lm_sum double, __lm_rare array<binary>, __lm_slice bigint"
    scored = saved(add_columns(docs, schema, convert).withColumn("__lm_row", F.monotonically_increasing_id()), "scored", "zstd")
    rare = scored.select("__lm_row", F.explode("__lm_rare").alias("word"))
    counted = rare.join(model.words, "word").select("__lm_row", F.log10(F.col("n") + 1).alias("log"))
    by_row = counted.groupBy("__lm_row").agg(F.count(F.lit(1)).alias("__lm_more"), F.sum("log").alias("__lm_logs"))
    by_text = context_tree.score(scored.select(F.col("__lm_row").alias("row"), F.col("__lm_slice").alias("slice"), "text"), model.trees)
    by_text = by_text.select(F.col("row").alias("__lm_row"), F.col("score").alias("__lm_score"))
    end_log, end_known = math.log10(model.documents + 1), int(model.documents > 0)
    whole = math.log10(model.tokens + model.distinct + 1)
    named = [n for n in docs.columns if n not in ("n_tokens", "n_known", "train_tokens", "base_score", "score")]
    return scored.join(by_row, "__lm_row", "left").join(by_text, "__lm_row").select(
        *(F.col(f"`{n}`") for n in named),
        "n_tokens",
        (F.col("__lm_found") + F.coalesce("__lm_more", F.lit(0)) + end_known).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("__lm_sum") + F.coalesce("__lm_logs", F.lit(0.0)) + end_log - F.col("n_tokens") * whole).alias("base_score"),
        F.col("__lm_score").alias("score"),
    )


def score_held_out(docs: DataFrame, folds: int = 7, held_out: int = 2) -> DataFrame:
    """Learn from the rows outside of one fold, crc32 of the id modulo ``folds``, and score all rows."""
    marked = docs.select("doc_id", "text").withColumn("held_out", id_remainder(folds) == held_out)
    model = train_model(marked.where(~F.col("held_out")))
    columns = (F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    return score_documents(marked, model).select(*columns)
