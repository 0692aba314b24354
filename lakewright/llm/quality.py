"""Quality scores: random-indexing word vectors pooled per document, and a small calibrated network.

Each token has a fixed sparse random vector, drawn from its own hash. A token's word vector is the sum of its
neighbours' random vectors over all texts outside of the held-out fold; a document is the mean of its tokens' word vectors. Two layers
turn that into a logit, and a temperature fitted on texts that the network did not see into a probability.
Tokens, never ids, sources, languages or labels, are all that a score depends on.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.texts import add_columns, id_remainder, map_batches, portions, release, strings_of

SAMPLE_DOCS = 6000  # labelled rows that the classifier is fitted on, drawn by hash
VOCABULARY = 16_384  # tokens with a word vector; the others count as one of a few kinds of rare token
DIMENSIONS = 64
NONZERO = 6
WINDOW = 2
BLOCK = 256  # word vectors that are added up together
HELD_TOKENS = 300_000  # how many distinct tokens a task counts before it hands them on
HIDDEN = 32
EPOCHS = 40
CALIBRATION = 5  # every fifth sampled row sets the temperature and not the weights
THRESHOLD = 0.3

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_AGAIN = "<again>"  # stands once more for every token that repeats one of the two before it
_KINDS = (_AGAIN, "<rare>", "<RARE>", "<Rare>", "<number>", "<marks>")


def tokens_of(text: str) -> list[str]:
    """Words, numbers and runs of marks as they stand; capitals tell words apart."""
    return _TOKEN.findall(text)


def _kind(token: str) -> str:
    if token.isdigit():
        return "<number>"
    if not token[0].isalpha():
        return "<marks>"
    return "<rare>" if token.islower() else "<RARE>" if token.isupper() and len(token) > 1 else "<Rare>"


class _Numbers(dict):
    """Token numbers; a token without one gets that of its kind."""

    def __missing__(self, token: str) -> int:
        return self[_kind(token)]


def _random_vectors(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each token's random vector."""
    hashes = np.array([[zlib.crc32(f"{k} {t}".encode()) for k in range(NONZERO)] for t in tokens], np.int64)
    return (hashes >> 1) % DIMENSIONS, 1.0 - 2.0 * (hashes & 1)


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n) of ``texts`` (text)."""

    def run(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for portion in portions(batch):
                for text in strings_of(portion.column("text")):
                    counts.update(tokens_of(text))
                    if len(counts) > HELD_TOKENS:
                        yield pa.RecordBatch.from_pydict({"token": list(counts), "n": list(counts.values())})
                        counts.clear()
        if counts:
            yield pa.RecordBatch.from_pydict({"token": list(counts), "n": list(counts.values())})
            counts.clear()
        release()

    return texts.mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def context_sums(texts: list[str], numbers: dict[str, int], places: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """The sum of its neighbours' random vectors for every token number."""
    gap = np.full(WINDOW, -1, np.int32)
    parts = [gap]
    for text in texts:
        parts += [np.array([*map(numbers.__getitem__, tokens_of(text))], np.int32), gap]
    stream = np.concatenate(parts)
    sums = np.zeros(len(places) * DIMENSIONS)
    for away in range(1, WINDOW + 1):
        both = (stream[:-away] >= 0) & (stream[away:] >= 0)
        left, right = stream[:-away][both].astype(np.int64), stream[away:][both].astype(np.int64)
        for one, other in ((left, right), (right, left)):
            for k in range(NONZERO):
                sums += np.bincount(one * DIMENSIONS + places[other, k], signs[other, k], len(sums))
    return sums.reshape(len(places), DIMENSIONS)


def word_vectors(texts: DataFrame) -> tuple[dict[str, int], np.ndarray]:
    """(token numbers, unit word vectors) from the neighbours of every token in all of ``texts`` (text).

    Tokens are counted and their neighbours added up in Spark; VOCABULARY vectors come to the driver.
    """
    common = token_counts(texts).where("n > 1").orderBy(F.desc("n"), "token").limit(VOCABULARY - len(_KINDS)).toArrow()
    names = [*_KINDS, *common["token"].to_pylist()]
    places, signs = _random_vectors(names)
    shared = texts.sparkSession.sparkContext.broadcast((names, places, signs))

    def blocks(sums):
        rows = [(i, sums[i * BLOCK : (i + 1) * BLOCK].astype("<i8").tobytes()) for i in range(-(-len(sums) // BLOCK))]
        return pa.RecordBatch.from_pydict({"block": [i for i, _ in rows], "sums": [x for _, x in rows]})

    def add_texts(batches):
        names, places, signs = shared.value
        numbers = _Numbers((t, i) for i, t in enumerate(names))
        sums = None
        for batch in batches:
            for portion in portions(batch):
                more = context_sums(strings_of(portion.column("text")), numbers, places, signs)
                sums = more if sums is None else sums + more
        if sums is not None:
            yield blocks(sums)
        sums = None
        release()

    def add_blocks(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                more = np.frombuffer(packed, "<i8")
                sums[i] = sums[i] + more if i in sums else more
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["block", "sums"]
        )

    parts = texts.mapInArrow(add_texts, "block bigint, sums binary").repartition("block")
    added = parts.mapInArrow(add_blocks, "block bigint, sums binary").toArrow()
    vectors = np.zeros((len(names), DIMENSIONS))
    for i, packed in zip(added["block"].to_pylist(), added["sums"].to_pylist(), strict=True):
        vectors[i * BLOCK : (i + 1) * BLOCK] = np.frombuffer(packed, "<i8").reshape(-1, DIMENSIONS)
    for k in range(NONZERO):  # a token stands in its own context too, so that rare ones differ
        np.add.at(vectors, (np.arange(len(names)), places[:, k]), signs[:, k])
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return {t: i for i, t in enumerate(names)}, (vectors / np.maximum(norms, 1e-9)).astype(np.float32)


@dataclass
class Model:
    numbers: dict[str, int]
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float

    def pooled(self, texts: list[str]) -> np.ndarray:
        numbers = _Numbers(self.numbers)
        rows = np.zeros((len(texts), DIMENSIONS), np.float32)
        for row, text in zip(rows, texts, strict=True):
            if found := tokens_of(text):
                again = sum(map(eq, found[1:], found)) + sum(map(eq, found[2:], found))
                total = self.vectors[np.fromiter(map(numbers.__getitem__, found), np.int64, len(found))].sum(axis=0)
                row[:] = (total + again * self.vectors[numbers[_AGAIN]]) / (len(found) + again)
        return rows

    def scores(self, texts: list[str]) -> np.ndarray:
        logits = _forward((self.pooled(texts) - self.mean) / self.scale, self.weights)[1]
        return 1 / (1 + np.exp(-np.clip(logits / self.temperature, -30, 30)))


def _forward(x: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    first, bias, second, last = weights
    hidden = np.tanh(x @ first + bias)
    return hidden, hidden @ second + last[0]


def _fit_network(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Cross-entropy by Adam in small batches; the order of the batches is fixed."""
    rng = np.random.default_rng(9)
    start = [rng.normal(0, DIMENSIONS**-0.5, (DIMENSIONS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    weights = start
    mean, square, step = [w * 0 for w in start], [w * 0 for w in start], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for first in range(0, len(x), 64):
            rows = order[first : first + 64]
            hidden, logits = _forward(x[rows], weights)
            error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - hidden**2)
            slopes = [x[rows].T @ back + 1e-4 * weights[0], back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for i, slope in enumerate(slopes):
                mean[i] = 0.9 * mean[i] + 0.1 * slope
                square[i] = 0.999 * square[i] + 0.001 * slope**2
                rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[i] = weights[i] - rate * mean[i] / (np.sqrt(square[i]) + 1e-8)
    return weights


def _fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least cross-entropy; 1 without rows."""
    if not len(y):
        return 1.0
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 80))
    scaled = np.clip(logits[None, :] / choices[:, None], -30, 30)
    losses = (np.logaddexp(0, scaled) - y * scaled).mean(axis=1)
    return float(choices[losses.argmin()])


def fit(numbers: dict[str, int], vectors: np.ndarray, pooled: np.ndarray, labels: list[int]) -> Model:
    model = Model(numbers, vectors, np.zeros(DIMENSIONS), np.ones(DIMENSIONS), [], 1.0)
    x, y = pooled.reshape(-1, DIMENSIONS).astype(float), np.array(labels, float)
    seen = np.arange(len(y)) % CALIBRATION != 0
    if len(y):
        model.mean, model.scale = x[seen].mean(axis=0) if seen.any() else x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    x = (x - model.mean) / model.scale
    model.weights = _fit_network(x[seen], y[seen])
    if not seen.any():
        model.weights[2][:] = 0
    model.temperature = _fit_temperature(_forward(x[~seen], model.weights)[1], y[~seen])
    return model


def train_model(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> Model:
    """Word vectors from all texts outside of the held-out fold; a network fitted on SAMPLE_DOCS labelled ones of them.

    The fold of a row is crc32 of its id modulo ``folds``. The labelled rows are drawn by hash, whatever their length;
    those without a label, an id or a text are not drawn. The numbers that they are pooled to are what reaches the
    driver of them. Without labelled rows every score is 1/2.
    """
    texts = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder(folds) != held_out))
    numbers, vectors = word_vectors(texts.select("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(numbers, vectors, np.empty(0), []))

    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).join(texts.select("doc_id"), "doc_id", "left_semi")
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    rows = texts.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.max("text").alias("text"))  # a repeated id stands once

    def convert(batch):
        pooled = shared.value.pooled(strings_of(batch.column("text")))
        return {"id": batch.column("id"), "good": batch.column("good"), "pooled": pooled.tolist()}

    named = rows.select(F.col("doc_id").cast("string").alias("id"), (F.col("quality") > 0).cast("int").alias("good"), "text")
    found = map_batches(named, "id string, good int, pooled array<float>", convert).collect()
    found.sort(key=lambda r: (zlib.crc32(r["id"].encode()), r["id"]))
    return fit(numbers, vectors, np.array([r["pooled"] for r in found], np.float32), [r["good"] for r in found])


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Add score (0 to 1, higher where quality 1 is likelier) and predicted (1 from ``threshold`` on) to ``docs``.

    Every row is scored from its whole text; a null or empty text has the score of a text without tokens. Columns of
    these names give way, all other columns and rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by VOCABULARY

    def convert(batch):
        scores = shared.value.scores(strings_of(batch.column("text")))
        return {"score": scores, "predicted": (scores >= threshold).astype(np.int32)}

    return add_columns(docs, "score double, predicted int", convert)


def digest(scored: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    return scored.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (id_remainder(folds) == held_out).alias("held_out"),
        "score",
        "predicted",
    )
