"""Context-tree weighting over bytes, with trees that lie in tables and are weighted where they lie.

A text is lower-cased UTF-8 with an end mark. Each byte is eight binary decisions; the contexts of each are the last
0 to DEPTH bytes as they stand. Every context that occurs has Krichevsky-Trofimov counts for every decision met in it,
and the weighting recursion mixes the estimates of all depths.

A gram is a symbol behind its DEPTH bytes of context, the nearest byte first: contexts of every depth are prefixes.
Grams are dealt out by their ROOT nearest bytes, so a task has whole subtrees; what is above them is folded by groupBy,
one depth at a time. Neither the grams nor the trees come to the driver: it has the contexts of fewer than ROOT bytes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.graph import saved
from lakewright.llm.texts import portions, utf8_of

DEPTH = 6  # bytes of context; with the symbol they fill seven bytes of a gram
ROOT = 3  # bytes of context that deal out the subtrees
SLICE_BYTES = 32 << 20  # how much text asks for a gram once
HELD_GRAMS = 2_000_000  # how many distinct grams a task holds before it hands them on
WEIGHED_GRAMS = 250_000  # about how many a task weighs or answers at a time

_LOW = 8 * (DEPTH + 1 - ROOT)  # bits of a gram below its root
_END = 0xFF  # in no UTF-8


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(the gram of each byte and end mark; bounds of the texts). Before a text stand DEPTH end marks."""
    gap = bytes([_END]) * DEPTH
    data = np.frombuffer(gap + gap.join(t.lower() for t in texts) + gap, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(bounds[-1]) + np.repeat(np.arange(1, len(texts) + 1) * DEPTH - np.arange(len(texts)), sizes)
    # Every byte's gram, gaps included, from slices of the bytes; then those of the texts.
    grams = np.zeros(len(data) - DEPTH, np.int64)
    for back in (*range(1, DEPTH + 1), 0):
        grams <<= 8
        grams |= data[DEPTH - back : len(data) - back]
    return grams[at - DEPTH], bounds


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 1/2, to about 1e-10."""
    shift = np.where(x < 8, 8, 0)
    y = x + shift
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = np.ones_like(x)
    for k in range(8):
        product *= np.where(shift > 0, x + k, 1)
    return series - np.log(product)


def _log_gamma_column(x: Column) -> Column:
    y = F.when(x < 8, x + 8).otherwise(x)
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    product = x
    for k in range(1, 8):
        product = product * (x + k)
    return series - F.when(x < 8, F.log(product)).otherwise(0.0)


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct numbers, ascending. Sorting takes less than a tenth of the time of ``np.unique``, which hashes them first."""
    keys = np.sort(keys)
    return keys[np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))]


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys`` and the sums of their counts. A stable sort only merges runs that are sorted already."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else np.empty(0, np.int64)


def _distinct_runs(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first of each run of equal ``keys``, its place); a run ends at each of ``bounds`` too."""
    fresh = np.diff(keys, prepend=keys[:1] - 1) != 0
    fresh[bounds[:-1][bounds[:-1] < len(keys)]] = True
    first = np.flatnonzero(fresh)
    return keys[first], first


def _by_root(grams: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The roots of sorted ``grams``, and the places where one ends and another begins."""
    roots, first = np.unique(grams >> _LOW, return_index=True)
    return roots, np.append(first, len(grams))


def _low(grams: np.ndarray) -> np.ndarray:
    return (grams & ((1 << _LOW) - 1)).astype("<u4")


# Packed columns: ascending numbers as their differences; counts in the fewest bytes. All first bytes of a part's numbers stand
# before all second ones and so on, so the high bytes, which are zero or much alike, make long runs that compress away.


def _cut(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)
    return [raw[a:b].T.tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _joined(packed: list[bytes], kind: str) -> np.ndarray:
    """The numbers of all parts that ``_cut`` made."""
    width = np.dtype(kind).itemsize
    parts = [np.frombuffer(part, np.uint8).reshape(width, -1).T for part in packed]
    return np.ascontiguousarray(np.concatenate([np.empty((0, width), np.uint8), *parts])).view(kind).ravel()


def _squeezed(packed: list[bytes]) -> list[bytes]:
    """Large parts as they go through a shuffle: their sizes, then they in a codec that needs fewer bytes than the shuffle's."""
    return [len(part).to_bytes(8, "little") + pa.compress(part, "zstd", asbytes=True) for part in packed]


def _restored(squeezed: list[bytes]) -> list[bytes]:
    return [pa.decompress(part[8:], int.from_bytes(part[:8], "little"), "zstd", asbytes=True) for part in squeezed]


def _cut_ascending(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Numbers that ascend from one bound to the next: the first, then the differences."""
    steps = np.diff(values, prepend=values[:1])
    starts = bounds[:-1][np.diff(bounds) > 0]
    steps[starts] = values[starts]
    return _cut(steps, bounds)


def _ascending(packed: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers that ``_cut_ascending`` packed, how many each has)."""
    sizes = np.fromiter((len(p) for p in packed), np.int64, len(packed)) // np.dtype(kind).itemsize
    steps = _joined(packed, kind).astype(np.int64)
    sums = np.concatenate(([0], np.cumsum(steps)))
    return sums[1:] - np.repeat(sums[np.cumsum(sizes) - sizes], sizes), sizes


_WIDTHS = ("<u1", "<u2", "<u4", "<i8")


def _cut_counts(counts: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Each part in as many bytes a number as its largest one needs; readers tell from the length."""
    most = np.maximum.reduceat(counts, bounds[:-1]) if len(bounds) > 1 else counts[:0]
    width = np.searchsorted([1 << 8, 1 << 16, 1 << 32], most, side="right")
    return [counts[a:b].astype(_WIDTHS[w]).tobytes() for a, b, w in zip(bounds[:-1], bounds[1:], width, strict=True)]


def _counts(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(packed, {1: "<u1", 2: "<u2", 4: "<u4", 8: "<i8"}[len(packed) // size])


def gram_counts(docs: DataFrame) -> DataFrame:
    """(root, grams, counts) of ``docs`` (text): packed, several rows a root, to be added up."""
    schema = pa.schema([("root", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary())])

    def rows(grams, counts):
        roots, bounds = _by_root(grams)
        columns = [pa.array(roots), pa.array(_cut_ascending(_low(grams), bounds)), pa.array(_cut_counts(counts, bounds))]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0  # distinct grams of the portions since they were last put together
        for batch in batches:
            for portion in portions(batch):
                held.append(np.unique(grams_of(utf8_of(portion.column("text")))[0], return_counts=True))
                size += len(held[-1][0])
                if size > HELD_GRAMS * 3 // 2:
                    held = [_merged(*map(np.concatenate, zip(*held, strict=True)))]
                    size = len(held[0][0])
                    if size > HELD_GRAMS:
                        yield rows(*held[0])
                        held, size = [], 0
        if held:
            grams, counts = _merged(*map(np.concatenate, zip(*held, strict=True)))
            yield rows(grams, counts)

    return docs.select("text").mapInArrow(run, "root bigint, grams binary, counts binary")


def _parents(ids: np.ndarray) -> np.ndarray:
    """An id is a context and then a node of the tree of decisions; its parent's context lacks the farthest byte."""
    return (ids >> 16 << 8) | (ids & 255)


@dataclass
class Level:
    """All decisions in contexts of one length: weighted log probability, share of the own estimate, its P of a 1."""

    ids: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray
    share: np.ndarray
    own: np.ndarray


def subtrees(grams: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels ROOT to DEPTH of the subtrees that ``grams`` (distinct, roots whole) make, weighted from below."""
    symbol, context = grams & 255, grams >> 8 << 8
    bits = [(symbol >> (7 - j)) & 1 for j in range(8)]
    ids, at = np.unique(np.concatenate([context | (1 << j) | (symbol >> (8 - j)) for j in range(8)]), return_inverse=True)
    every = np.bincount(at, np.tile(counts, 8), len(ids))
    ones = np.bincount(at, np.concatenate([b * counts for b in bits]), len(ids))
    zeros = every - ones
    levels: list[Level] = []
    for depth in range(DEPTH, ROOT - 1, -1):
        if levels:
            below = levels[-1]
            ids, at = np.unique(_parents(below.ids), return_inverse=True)
            zeros, ones, children = (np.bincount(at, x, len(ids)) for x in (below.zeros, below.ones, below.weighted))
        coded = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)
        weighted = coded if depth == DEPTH else np.logaddexp(coded, children) - math.log(2)
        share = np.ones_like(coded) if depth == DEPTH else np.exp(coded - math.log(2) - weighted)
        levels.append(Level(ids, zeros, ones, weighted, share, (ones + 0.5) / (zeros + ones + 1)))
    return levels[::-1]


def _root_by_root(df: DataFrame, answer: Callable[[list[dict]], pa.RecordBatch], schema: str) -> DataFrame:
    """Call ``answer`` with portions of the rows (root, slice, grams, counts), all counts of a root before its questions.

    Counts of a root come again in a later portion if more of its questions do, never in part. Questions of one slice about one root
    stay together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if size > WEIGHED_GRAMS and (row["root"], row["slice"]) != (held[-1]["root"], held[-1]["slice"]):
                    yield answer(held)
                    held, size = [r for r in held if r["counts"] is not None and r["root"] == row["root"]], 0
                held.append(row)
                size += len(row["grams"]) // 4
        if held:
            yield answer(held)

    dealt = df.repartition("root").sortWithinPartitions("root", F.col("counts").isNull(), "slice")
    return dealt.mapInArrow(run, schema)


def _unpacked(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    low, sizes = _ascending([r["grams"] for r in rows], "<u4")
    return low | np.repeat(np.array([r["root"] for r in rows], np.int64) << _LOW, sizes), sizes


def _counted(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    rows = [r for r in rows if r["counts"] is not None]
    grams, sizes = _unpacked(rows)
    return _merged(grams, np.concatenate([_counts(r["counts"], n) for r, n in zip(rows, sizes.tolist(), strict=True)]))


# Above the subtrees: rows of (id, zeros, ones, weighted), one frame a depth.


def _roots(counts: DataFrame) -> DataFrame:
    """Level ROOT, from whole subtrees."""

    def answer(rows):
        level = subtrees(*_counted(rows))[0]
        arrays = [pa.array(level.ids), *(pa.array(x, pa.float64()) for x in (level.zeros, level.ones, level.weighted))]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "zeros", "ones", "weighted"])

    return _root_by_root(counts, answer, "id bigint, zeros double, ones double, weighted double")


def _parent(id: str = "id") -> Column:
    return F.shiftleft(F.shiftright(id, 16), 8).bitwiseOR(F.col(id).bitwiseAND(255))


def _folded(level: DataFrame) -> DataFrame:
    """The level above: counts of all children, mixed with what the children make of them."""
    merged = level.groupBy(_parent().alias("id")).agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("children")
    )
    zeros, ones = F.col("zeros"), F.col("ones")
    coded = _log_gamma_column(zeros + 0.5) + _log_gamma_column(ones + 0.5) - _log_gamma_column(zeros + ones + 1) - math.log(math.pi)
    merged = merged.withColumn("coded", coded)
    more = F.log1p(F.exp(-F.abs(F.col("coded") - F.col("children"))))
    weighted = F.greatest("coded", "children") + more - math.log(2)
    share = F.exp(F.col("coded") - math.log(2) - F.col("weighted"))
    own = (ones + 0.5) / (zeros + ones + 1)
    return merged.withColumn("weighted", weighted).select("id", "zeros", "ones", "weighted", share.alias("share"), own.alias("own"))


@dataclass
class Trees:
    counts: DataFrame  # (root, slice, grams, counts), the slice being null
    above: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # by depth below ROOT: ids, P of a 1 so far, weight that is left


def train(docs: DataFrame) -> Trees:
    """The trees of ``docs`` (text); a null text is empty."""
    counts = saved(gram_counts(docs), "grams", "zstd").select("root", F.lit(None).cast("bigint").alias("slice"), "grams", "counts")
    levels = [saved(_roots(counts), "level")]
    for _ in range(ROOT):
        levels.append(saved(_folded(levels[-1]), "level"))
    above, upper = [], None
    for level in levels[:0:-1]:
        if upper is None:
            level = level.withColumns({"p": F.col("share") * F.col("own"), "left": 1 - F.col("share")})
        else:
            before = upper.select(F.col("id").alias("up"), F.col("p").alias("_p"), F.col("left").alias("_left"))
            level = level.join(before, _parent() == F.col("up")).withColumns(
                {"p": F.col("_p") + F.col("_left") * F.col("share") * F.col("own"), "left": F.col("_left") * (1 - F.col("share"))}
            )
        upper = level.select("id", "p", "left")
        rows = upper.orderBy("id").toArrow()  # at most 255 decisions in each context of fewer than ROOT bytes
        above.append(tuple(rows[n].to_numpy() for n in ("id", "p", "left")))
    return Trees(counts, above)


def _down(above: list, levels: list[Level]) -> list[tuple[np.ndarray, np.ndarray]]:
    """By depth: ids, and P of a 1 in each if no deeper context is known."""
    found = [(ids, p + left * 0.5) for ids, p, left in above]
    ids, p, left = above[-1]
    for level in levels:
        up = np.searchsorted(ids, _parents(level.ids))
        p, left = p[up] + left[up] * level.share * level.own, left[up] * (1 - level.share)
        ids = level.ids
        found.append((ids, p + left * 0.5))
    return found


def gram_logs(grams: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 P of each gram's symbol: every decision by the longest context that it was met in."""
    total = np.zeros(len(grams))
    symbol = grams & 255
    for j in range(8):
        node, up = (1 << j) | (symbol >> (8 - j)), (symbol >> (7 - j)) & 1
        one, still = np.full(len(grams), 0.5), np.arange(len(grams))
        for depth in range(len(tables) - 1, -1, -1):
            ids, p = tables[depth]
            if not len(ids) or not len(still):
                continue
            wanted = (grams[still] >> 8 * (DEPTH - depth + 1) << 8) | node[still]
            at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
            met = ids[at] == wanted
            one[still[met]] = p[at[met]]
            still = still[~met]
        total += np.log10(np.clip(np.where(up, one, 1 - one), 1e-12, 1))
    return total


def _questions(docs: DataFrame) -> DataFrame:
    """(root, slice, grams, counts) of ``docs`` (slice, text): the distinct grams of each slice, and no counts."""
    schema = pa.schema([("root", pa.int64()), ("slice", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary())])

    def rows(number, grams):
        roots, bounds = _by_root(grams)
        n = len(roots)
        columns = [pa.array(roots), pa.array([number] * n, pa.int64()), pa.array(_cut_ascending(_low(grams), bounds)), pa.nulls(n, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches):
        now, grams = None, np.empty(0, np.int64)
        for batch in batches:
            for portion in portions(batch):
                slices = portion.column("slice").to_numpy()
                texts = np.array(utf8_of(portion.column("text")), object)
                for number in np.unique(slices):
                    if len(grams) and (number != now or len(grams) > HELD_GRAMS):
                        yield rows(now, grams)
                        grams = grams[:0]
                    now = int(number)
                    grams = _distinct(np.concatenate((grams, _distinct(grams_of(list(texts[slices == number]))[0]))))
        if len(grams):
            yield rows(now, grams)

    return docs.mapInArrow(run, "root bigint, slice bigint, grams binary, counts binary")


def _bundled(texts: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(texts)
    return sink.getvalue().to_pybytes()


def _unbundled(bundle: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(bundle).read_next_batch()


def _bundles(docs: DataFrame) -> DataFrame:
    """(slice, bundle) of ``docs`` (row, slice, text): rows and texts as they go through a shuffle, a portion at a time and compressed."""
    schema = pa.schema([("slice", pa.int64()), ("bundle", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion in portions(batch):
                for number in pc.unique(portion.column("slice")):
                    own = portion.filter(pc.equal(portion.column("slice"), number)).select(["row", "text"])
                    yield pa.RecordBatch.from_arrays([pa.array([number.as_py()], pa.int64()), pa.array([_bundled(own)])], schema=schema)

    return docs.select("row", "slice", "text").mapInArrow(run, "slice bigint, bundle binary")


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """(row, score) of ``docs`` (row, slice, text): log10 P of each lower-cased text with its end.

    The rows of a slice are looked up together, so a slice should have about SLICE_BYTES of text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees.above)
    answers = pa.schema([("slice", pa.int64()), ("roots", pa.binary()), ("logs", pa.binary())])

    def answer(rows):
        tables = _down(shared.value, subtrees(*_counted(rows)) if any(r["counts"] is not None for r in rows) else [])
        asked = [r for r in rows if r["counts"] is None]
        grams, sizes = _unpacked(asked)
        # Distinct by slice and gram: a number for each slice, and one for each gram, side by side.
        numbers, which = np.unique(np.array([r["slice"] for r in asked], np.int64), return_inverse=True)
        distinct, at = np.unique(grams, return_inverse=True)
        pairs = _distinct(np.repeat(which, sizes) * len(distinct) + at)
        at = pairs % max(len(distinct), 1)
        bounds = np.searchsorted(pairs, np.arange(len(numbers) + 1) * len(distinct))
        logs = gram_logs(distinct, tables).astype("<f4")[at]
        roots, first = _distinct_runs(distinct[at] >> _LOW, bounds)
        packed = _cut_ascending(roots, np.searchsorted(first, bounds)), _cut(logs, bounds)
        columns = [pa.array(numbers), *(pa.array(_squeezed(parts), pa.binary()) for parts in packed)]
        return pa.RecordBatch.from_arrays(columns, schema=answers)

    asked = trees.counts.unionByName(_questions(docs.select("slice", "text")))
    told = _root_by_root(asked, answer, "slice bigint, roots binary, logs binary")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        grams, held = np.empty(0, np.int64), []  # four bytes a byte of the slice's texts, and its portions' distinct grams
        for bundle in left["bundle"].to_pylist():
            texts = _unbundled(bundle)
            found, bounds = grams_of(utf8_of(texts["text"]))
            distinct, at = np.unique(found, return_inverse=True)
            held.append((texts["row"].to_numpy(), bounds, distinct, at.astype(np.int32)))
            grams = _distinct(np.concatenate((grams, distinct)))
        # The answers of a root are in the order of its grams, and no root's come in two parts.
        roots, bounds = _by_root(grams)
        told = np.searchsorted(roots, _ascending(_restored(right["roots"].to_pylist()), "<i8")[0])
        sizes = np.diff(bounds)[told]
        ends = np.cumsum(sizes)
        logs = np.empty(len(grams))
        logs[np.repeat(bounds[told] - (ends - sizes), sizes) + np.arange(len(grams))] = _joined(_restored(right["logs"].to_pylist()), "<f4")
        rows, scores = [np.empty(0, np.int64)], [np.empty(0)]
        for row, bounds, distinct, at in held:
            rows.append(row)
            scores.append(np.add.reduceat(logs[np.searchsorted(grams, distinct)][at], bounds[:-1]))
        return pa.table({"row": np.concatenate(rows), "score": np.concatenate(scores)})

    return _bundles(docs).groupBy("slice").cogroup(told.groupBy("slice")).applyInArrow(summed, "row bigint, score double")
