"""Exact ranked search by sparse ball trees over the documents' term vectors.

A score is an inner product of the query's weights with a document's, in integers. Documents are read block by block; those of a
block go into a binary tree of balls. A ball has a centroid and, for each of SUBSPACES groups of terms, a radius: how far
its documents are from the centroid in the dimensions of that group. By Cauchy and Schwarz no document in the ball
scores above ``q·c + Σ |q_g| r_g``, a number that is rounded up by more than all rounding errors on the way to it. A search opens the
ball with the highest bound first, scores the documents of leaves exactly, and ends where the next bound is below the k-th best
score so far; that score is carried from block to block of a task.

Only terms that occur in queries are dimensions; no other term adds to a score.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewright.llm.decontamination import normal_text
from lakewright.llm.graph import saved
from lakewright.llm.texts import map_batches, portions, utf8_of

TOP_K = 10
BLOCK_BYTES = 8 << 20  # query terms that are searched for at once; one item's terms are never parted
SLICE = 1 << 20  # bytes of a text whose words are counted at a time
TREE_TERMS = 1 << 20  # terms of the documents in one tree
LEAF = 64
SUBSPACES = 64
SIGNS = 16  # dimensions in which documents are compared when a ball is parted
SLACK = 1e-9  # relative; a sum of a million doubles is off by less than 2e-10

VECTORS = "doc_id bigint, n bigint, terms array<int>, times array<int>"


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a slice of it at a time."""
    normal = normal_text(text)
    start = 0
    while start < len(normal):
        end = normal.find(b" ", start + SLICE)
        end = len(normal) if end < 0 else end
        yield normal[start:end].split()
        start = end


def term_counts(text: bytes, numbers: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """How many words a text has; which of the numbered terms are among them, and how often."""
    count, found = 0, []
    for words in word_slices(text):
        count += len(words)
        found += [n for n in map(numbers.get, words) if n is not None]
    terms, times = np.unique(np.array(found, np.int32), return_counts=True)
    return count, terms, times.astype(np.int32)


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, item_key, term, times): how often each item has each term; equal rows of ``items`` (item_id, text) are one."""

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        rows: list[tuple[int, bytes, int]] = []
        for row, text in enumerate(utf8_of(batch.column("text"))):
            counted: dict[bytes, int] = {}
            for words in word_slices(text):
                for word in words:
                    counted[word] = counted.get(word, 0) + 1
            rows += [(row, word, times) for word, times in counted.items()]
        which, terms, times = zip(*rows, strict=True) if rows else ((), (), ())
        at = pa.array(which, pa.int64())
        return {
            "item_id": batch.column("item_id").take(at),
            "item_key": batch.column("item_key").take(at),
            "term": [t.decode() for t in terms],
            "times": times,
        }

    keyed = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.xxhash64("text").alias("item_key"), "text")
    return map_batches(keyed, "item_id bigint, item_key bigint, term string, times bigint", convert).distinct()


def term_vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, times) of every row of ``docs``: its words, and the numbers and counts of ``terms`` among them."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # of at most BLOCK_BYTES, or of one item
    numbers: dict[bytes, int] = {}

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        if not numbers:
            numbers.update((term.encode(), n) for n, term in enumerate(shared.value))
        found = [term_counts(text, numbers) for text in utf8_of(batch.column("text"))]
        return {
            "doc_id": batch.column("doc_id"),
            "n": [n for n, _, _ in found],
            "terms": [terms for _, terms, _ in found],
            "times": [times for _, _, times in found],
        }

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), VECTORS, convert)


@dataclass
class Rows:
    """Sparse rows: the entries of row ``i`` are those from ``bounds[i]`` to ``bounds[i + 1]``."""

    bounds: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def take(self, order: np.ndarray) -> Rows:
        sizes = np.diff(self.bounds)[order]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.bounds[order] - bounds[:-1], sizes) + np.arange(bounds[-1])
        return Rows(bounds, self.terms[at], self.values[at])


def _directions(rows: Rows, scale: np.ndarray) -> np.ndarray:
    """A short dense vector for each row, by signs that a term draws; only for deciding which documents go together."""
    y = rows.values * scale[rows.terms]
    owner = np.repeat(np.arange(len(rows.bounds) - 1), np.diff(rows.bounds))
    mixed = rows.terms.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = np.empty((len(rows.bounds) - 1, SIGNS))
    for k in range(SIGNS):
        sign = ((mixed >> np.uint64(20 + k)) & np.uint64(1)).astype(np.float64) * 2 - 1
        out[:, k] = np.bincount(owner, y * sign, len(out))
    return out / np.maximum(np.sqrt((out**2).sum(axis=1, keepdims=True)), 1e-300)


def _parted(points: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves, along the line between two members far apart."""
    own = points[members]
    one = own[((own - own.mean(axis=0)) ** 2).sum(axis=1).argmax()]
    other = own[((own - one) ** 2).sum(axis=1).argmax()]
    half = len(members) // 2
    order = np.argpartition(own @ (other - one), half)
    return members[order[:half]], members[order[half:]]


class BallTree:
    """The balls of a block of documents. Node 0 has all of them; the children of a node stand side by side."""

    def __init__(self, rows: Rows, weights: np.ndarray, leaf: int = LEAF):
        """``rows`` have at least one entry each, whose terms have weights above 0."""
        self.scale = np.sqrt(weights.astype(np.float64))
        points = _directions(rows, self.scale)
        # Nodes in breadth-first order, each with its range of documents in the order of the leaves.
        levels = [[np.arange(len(rows.bounds) - 1)]]
        self.children: list[int] = []
        held: list[np.ndarray] = []
        while levels[-1]:
            following: list[np.ndarray] = []
            for members in levels[-1]:
                held.append(members)
                if len(members) <= leaf:
                    self.children.append(-1)
                else:
                    self.children.append(sum(map(len, levels)) + len(following))
                    following += _parted(points, members)
            levels.append(following)
        order = np.concatenate([held[n] for n in self._leaves()])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.order, self.rows = order, rows.take(order)
        self.ranges = [(int(place[m].min()), int(place[m].max()) + 1) for m in held]
        self._enclose()

    def _leaves(self) -> Iterator[int]:
        """Leaves from left to right, so that the documents of every node stand together."""
        waiting = [0]
        while waiting:
            node = waiting.pop()
            if self.children[node] < 0:
                yield node
            else:
                waiting += [self.children[node] + 1, self.children[node]]

    def _enclose(self) -> None:
        """Centroids, as sparse rows, and the radius of every node in every subspace."""
        bounds, terms, values = [0], [], []
        self.radii = np.zeros((len(self.ranges), SUBSPACES))
        for node, (a, b) in enumerate(self.ranges):
            entries = slice(self.rows.bounds[a], self.rows.bounds[b])
            y = self.rows.values[entries] * self.scale[self.rows.terms[entries]]
            own, at = np.unique(self.rows.terms[entries], return_inverse=True)
            centre = np.bincount(at, y) / (b - a)
            group = own % SUBSPACES
            norm = np.bincount(group, centre**2, SUBSPACES)
            owner = np.repeat(np.arange(b - a), np.diff(self.rows.bounds[a : b + 1]))
            cell = owner * SUBSPACES + group[at]
            near = np.bincount(cell, (y - centre[at]) ** 2 - centre[at] ** 2, (b - a) * SUBSPACES)
            size = np.bincount(cell, y**2, (b - a) * SUBSPACES)
            # What cancels above is off by a share of what is added here.
            squares = near.reshape(b - a, SUBSPACES) + norm + SLACK * (size.reshape(b - a, SUBSPACES) + norm)
            self.radii[node] = np.sqrt(np.maximum(squares, 0).max(axis=0))
            terms.append(own)
            values.append(centre)
            bounds.append(bounds[-1] + len(own))
        self.centres = Rows(np.array(bounds), np.concatenate(terms), np.concatenate(values))

    def _bounds(self, first: int, last: int, scaled: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """No document of the nodes from ``first`` to before ``last`` scores above these."""
        starts = self.centres.bounds[first:last]
        entries = slice(starts[0], self.centres.bounds[last])
        products = scaled[self.centres.terms[entries]] * self.centres.values[entries]
        centre = np.add.reduceat(products, starts - starts[0])
        return (centre + self.radii[first:last] @ norms) * (1 + SLACK) + 1

    def search(self, query: Query, weights: np.ndarray, best: Best) -> None:
        """Offer ``best`` all documents that may be among its first."""
        weights[query.terms] = query.weights
        scaled = np.zeros(len(weights))
        scaled[query.terms] = query.weights / self.scale[query.terms]
        norms = np.sqrt(np.bincount(query.terms % SUBSPACES, scaled[query.terms] ** 2, SUBSPACES))
        open_balls = [(-float(self._bounds(0, 1, scaled, norms)[0]), 0)]
        while open_balls and -open_balls[0][0] >= best.least:
            _, node = heapq.heappop(open_balls)
            child = self.children[node]
            if child < 0:
                a, b = self.ranges[node]
                first = self.rows.bounds[a]
                entries = slice(first, self.rows.bounds[b])
                products = weights[self.rows.terms[entries]] * self.rows.values[entries]
                best.offer(self.order[a:b], np.add.reduceat(products, self.rows.bounds[a:b] - first))
            else:
                for n, bound in enumerate(self._bounds(child, child + 2, scaled, norms).tolist()):
                    if bound >= best.least:
                        heapq.heappush(open_balls, (-bound, child + n))
        weights[query.terms] = 0


@dataclass
class Query:
    """Terms with their integer weights: the term's, times how often the query has it."""

    terms: np.ndarray
    weights: np.ndarray


class Best:
    """The best ``k`` documents so far: by score, then by id, rows without an id last."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids, self.has_id = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        self.names: tuple[np.ndarray, np.ndarray] = (self.ids, self.has_id)

    def offer(self, docs: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        ids, has_id = self.names
        scores = np.concatenate((self.scores, scores[good]))
        ids, has_id = np.concatenate((self.ids, ids[docs[good]])), np.concatenate((self.has_id, has_id[docs[good]]))
        order = np.lexsort((ids, ~has_id, -scores))[: self.k]
        self.scores, self.ids, self.has_id = scores[order], ids[order], has_id[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def impacts(times: np.ndarray, n: np.ndarray, docs: int, words: int) -> np.ndarray:
    """What a term that a document of ``n`` words has ``times`` times adds to a score for each unit of weight."""
    m = 100 - 75 + (75 * n * docs) // words
    return (1_000_000_000 * times) // (1000 * times + 8 * m)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best rows of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased, of whole texts. With N documents that have
    terms, L terms in all of them, n of one document, df documents with a term: a term weighs floor(1000 ln((2N+2)/(2df+1))), a
    document has m = 25 + 75nN div L, and its score sums weight * ((10^9 tf) div (1000 tf + 8m)) over the terms of the item,
    repeats included. Rows with a score of 0 are no results. Equal scores go by ascending doc_id, rows without an id after
    all others of that score.

    Null and empty texts have no terms: as items they have no results, as documents they are none. Repeated rows of ``docs``
    are results of their own; rows of ``items`` that repeat id and text are one item, and items without an id are found under a null
    id. Further columns are not read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = saved(query_terms(items), "query_terms")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_BYTES)
    results = spark.createDataFrame([], "item_id bigint, item_key bigint, doc_id bigint, score bigint")
    for number in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id", "item_key"), F.lit(blocks)) == number).toArrow()
        if block.num_rows:
            results = results.unionByName(saved(_search_block(docs, block, k), "ranked"))
    order = Window.partitionBy("item_id", "item_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, asked: pa.Table, k: int) -> DataFrame:
    """(item_id, item_key, doc_id, score): the best ``k`` that each task found for each item; ``asked`` has at most a block of terms."""
    spark = docs.sparkSession
    asked = asked.sort_by([(name, "ascending") for name in ("item_id", "item_key", "term")])
    terms, numbers = np.unique(np.array(asked["term"].to_pylist(), object), return_inverse=True)
    vectors = saved(term_vectors(docs, terms.tolist()), "term_vectors")
    count, words = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    weights = np.zeros(len(terms), np.int64)  # of terms in no document: they add nothing
    weights[counted["term"].to_numpy()] = [math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1))) for df in counted["df"].to_pylist()]

    keys = list(zip(asked["item_id"].to_pylist(), asked["item_key"].to_pylist(), strict=True))
    starts = [n for n, key in enumerate(keys) if not n or key != keys[n - 1]]
    times = asked["times"].to_numpy()
    queries = []
    for first, last in zip(starts, [*starts[1:], len(keys)], strict=True):
        used = np.flatnonzero(weights[numbers[first:last]] > 0) + first
        queries.append(Query(numbers[used], weights[numbers[used]] * times[used]))
    named = ([keys[n][0] for n in starts], [keys[n][1] for n in starts])
    shared = spark.sparkContext.broadcast((weights, queries, named))  # in proportion to the block of terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries, (item_ids, item_keys) = shared.value
        found = [Best(k) for _ in queries]
        dense = np.zeros(len(weights), np.int64)
        for batch in batches:
            for portion in portions(batch, "terms", TREE_TERMS):
                tree, names = _tree(portion, weights, count, words)
                if tree:
                    for query, best in zip(queries, found, strict=True):
                        if len(query.terms):
                            best.names = names
                            tree.search(query, dense, best)
        which = np.repeat(np.arange(len(found)), [len(best.scores) for best in found])
        ids = np.concatenate([best.ids for best in found])
        has_id = np.concatenate([best.has_id for best in found])
        at = pa.array(which, pa.int64())
        columns = [
            pa.array(item_ids, pa.int64()).take(at),
            pa.array(item_keys, pa.int64()).take(at),
            pa.array(ids, pa.int64(), mask=~has_id),
            pa.array(np.concatenate([best.scores for best in found]), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "item_key", "doc_id", "score"])

    return vectors.mapInArrow(run, "item_id bigint, item_key bigint, doc_id bigint, score bigint")


def _tree(batch: pa.RecordBatch, weights: np.ndarray, count: int, words: int) -> tuple[BallTree | None, tuple[np.ndarray, np.ndarray]]:
    """The tree of the documents of a batch that have terms with weights, and their ids."""
    lists = batch.column("terms")
    sizes = np.diff(lists.offsets.to_numpy())
    terms, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    used = weights[terms] > 0
    owner, terms, times = owner[used], terms[used], times[used]
    kept, sizes = np.unique(owner, return_counts=True)
    ids = batch.column("doc_id")
    names = (ids.fill_null(0).to_numpy()[kept], ids.is_valid().to_numpy(zero_copy_only=False)[kept])
    if not len(kept):
        return None, names
    values = impacts(times, batch.column("n").to_numpy()[owner], count, words)
    return BallTree(Rows(np.concatenate(([0], np.cumsum(sizes))), terms, values), weights), names
