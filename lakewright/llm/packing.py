"""Best-fit packing of token sequences by linear grouping.

What has to be decided depends on the lengths alone, and there are no more distinct lengths than the capacity.
So the lengths are counted over all documents, one plan is made from the counts, and every piece finds its
place in the plan by its length and its number among the pieces of that length. Only the counts
(at most ``capacity`` rows) reach the driver and only the plan goes back; both follow the capacity, not the data.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewright.llm.encoder import worker_encoder
from lakewright.llm.graph import small_batches
from lakewright.llm.texts import portions, release, strings_of
from lakewright.session import scratch_path

CAPACITY = 4096
SMALL_SHARE = 1 / 8  # lengths up to this share of the capacity are small
GROUPS = 1000  # into how many groups of equal cardinality the large lengths are rounded
REMEMBERED = 450_000  # chunks that a worker keeps the ids of
_RANK_BITS = 48

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, _task int, _row bigint"


@dataclass
class Plan:
    """Which places the pieces of each length take.

    An entry says: of the pieces of ``length``, those numbered ``rank`` and following fill the sequences from
    ``sequence`` on, ``per_sequence`` in each, from ``offset`` on.
    """

    sequences: int = 0
    entries: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def place(self, length: int, rank: int, sequence: int, per_sequence: int, offset: int) -> None:
        self.entries.append((length, rank, sequence, per_sequence, offset))

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys of length and rank, the entries in that order)."""
        table = np.array(sorted(self.entries), np.int64).reshape(-1, 5)
        return (table[:, 0] << _RANK_BITS) | table[:, 1], table


def _groups(counts: Mapping[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """Linear grouping: (rounded length, runs of [length, rank, n]) in descending order, equally many pieces each.

    Neighbours that round to the same length are one group.
    """
    total = sum(counts.values())
    share = -(-total // groups) if total else 1
    out: list[tuple[int, list[list[int]]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if not room:
                room = share
                if not out or out[-1][0] != length:
                    out.append((length, []))
            taken = min(left, room)
            out[-1][1].append([length, rank, taken])
            rank, left, room = rank + taken, left - taken, room - taken
    return out


def _fullest(sizes: list[int], left: list[int], capacity: int) -> dict[int, int]:
    """The configuration with the largest size that is left and, with it, the fullest sequence: {group: times}."""
    first = next(g for g, n in enumerate(left) if n)
    room = capacity - sizes[first]
    reached = np.zeros(room + 1, bool)
    reached[0] = True
    by = np.full(room + 1, -1, np.int32)
    for g in range(first, len(sizes)):
        size, times = sizes[g], left[g] - (g == first)
        if size > room or times <= 0:
            continue
        edge = reached
        for _ in range(min(times, room // size)):
            new = np.zeros(room + 1, bool)
            new[size:] = edge[:-size]
            new &= ~reached
            if not new.any():
                break
            by[new] = g
            reached = reached | new
            edge = new
        if reached[room]:
            break
    used = Counter({first: 1})
    at = int(np.flatnonzero(reached)[-1])
    while at:
        used[int(by[at])] += 1
        at -= sizes[by[at]]
    return used


def make_plan(
    counts: Mapping[int, int], capacity: int = CAPACITY, small_share: float = SMALL_SHARE, groups: int = GROUPS
) -> Plan:
    """Places for ``counts`` = {length: number of pieces}, lengths from 1 to ``capacity``.

    Large lengths are rounded up within their group. Configurations of rounded lengths are chosen one after the
    other, the fullest with the largest length left, each as often as the groups allow. Then the actual lengths
    take the rounded ones' places, and the small ones go, longest first, where they fit best.
    """
    plan = Plan()
    border = int(capacity * small_share)
    grouped = _groups({n: c for n, c in counts.items() if n > border and c}, groups)
    sizes = [size for size, _ in grouped]
    left = [sum(run[2] for run in runs) for _, runs in grouped]
    free: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, how many)

    def take(group: int, n: int) -> list[tuple[int, int, int]]:
        runs, taken = grouped[group][1], []
        while n:
            length, rank, has = runs[0]
            part = min(n, has)
            taken.append((length, rank, part))
            if part == has:
                runs.pop(0)
            else:
                runs[0] = [length, rank + part, has - part]
            n -= part
        return taken

    while any(left):
        used = _fullest(sizes, left, capacity)
        times = min(left[g] // k for g, k in used.items())
        segments = [(plan.sequences, times, 0)]
        for g in sorted(Counter(used).elements()):
            cut = []
            runs = take(g, times)
            for sequence, n, fill in segments:
                while n:
                    length, rank, has = runs[0]
                    part = min(n, has)
                    plan.place(length, rank, sequence, 1, fill)
                    cut.append((sequence, part, fill + length))
                    runs[:1] = [(length, rank + part, has - part)] if part < has else []
                    sequence, n = sequence + part, n - part
            segments = cut
        for g, k in used.items():
            left[g] -= k * times
        for sequence, n, fill in segments:
            free.setdefault(capacity - fill, []).append((sequence, n))
        plan.sequences += times

    rooms = sorted(free)
    for length in sorted((n for n, c in counts.items() if n <= border and c), reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                fresh = -(-todo // (capacity // length))
                _add(free, rooms, capacity, (plan.sequences, fresh))
                plan.sequences += fresh
                continue
            room = rooms[at]
            sequence, n = free[room].pop()
            if not free[room]:
                del free[room], rooms[at]
            each = min(room // length, todo)
            full = min(n, todo // each)
            plan.place(length, rank, sequence, each, capacity - room)
            _add(free, rooms, room - each * length, (sequence, full))
            if full < n:
                _add(free, rooms, room, (sequence + full, n - full))
            rank, todo = rank + each * full, todo - each * full
    return plan


def _add(free: dict[int, list[tuple[int, int]]], rooms: list[int], room: int, sequences: tuple[int, int]) -> None:
    if room not in free:
        free[room] = []
        bisect.insort(rooms, room)
    free[room].append(sequences)


def encoded_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keeps_space: bool, with_ids: bool
) -> DataFrame:
    """Pieces of all documents, each with its task and its number among the task's pieces of that length."""
    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")

    def cut(batches):
        encoder, task = worker_encoder(tokenizer, keeps_space, REMEMBERED), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for portion in portions(batch):
                ids, bounds = encoder.encode(strings_of(portion.column("text")), end_id)
                totals = np.diff(bounds)
                pieces = -(-totals // capacity)
                doc = np.repeat(np.arange(len(totals)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(totals[doc] - start, capacity)
                first = bounds[:-1][doc] + start
                crcs = [zlib.crc32(ids[a : a + n]) for a, n in zip(first, length, strict=True)]
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                row = np.empty(len(length), np.int64)
                row[order] = np.arange(len(length)) - np.searchsorted(ordered, ordered) + seen[ordered]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [
                    portion.column("doc_id").take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crcs, pa.int64()),
                    pa.array(np.full(len(doc), task), pa.int32()),
                    pa.array(row, pa.int64()),
                ]
                if with_ids:
                    at = np.concatenate((first, bounds[-1:])).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(ids.view(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])
        encoder.forget()  # the worker lives on, and other stages need its memory
        release()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    keeps_space: bool = False,
    with_ids: bool = False,
    small_share: float = SMALL_SHARE,
    groups: int = GROUPS,
) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into as few sequences of ``capacity`` tokens as the method finds.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for. A null
    text is empty and gives one piece with the end id; ids may be null or repeated; only documents longer than
    ``capacity`` are cut. An empty table gives no rows. The pieces are written once to the shared folder, so
    that their numbers stay as they are when a task is repeated.
    """
    spark = docs.sparkSession
    written = scratch_path(spark, "pieces")
    with small_batches(spark):
        encoded_pieces(docs, tokenizer, capacity, end_id, keeps_space, with_ids).write.parquet(written)
    pieces = spark.read.parquet(written)

    per_task = pieces.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("_n"))
    lengths = per_task.groupBy("length").agg(F.sum("_n").alias("_n")).collect()  # at most ``capacity`` rows
    plan = make_plan({r["length"]: r["_n"] for r in lengths}, capacity, small_share, groups)
    shared = spark.sparkContext.broadcast(plan.arrays())

    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("_task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    numbered = pieces.join(bases, ["_task", "length"]).withColumn("_rank", F.col("_base") + F.col("_row"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def place(batches):
        keys, table = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            entry = table[np.searchsorted(keys, (length << _RANK_BITS) | rank, side="right") - 1]
            turn = rank - entry[:, 1]
            sequence = pa.array(entry[:, 2] + turn // entry[:, 3], pa.int64())
            offset = pa.array(entry[:, 4] + turn % entry[:, 3] * length, pa.int64())
            columns = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, sequence, offset], names=[*kept, "sequence_id", "offset"])

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += (", ids array<int>" if with_ids else "") + ", sequence_id bigint, offset bigint"
    return numbered.select(*kept, "_rank").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed ``with_ids``; a group holds at most one sequence's tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
