"""States kept up by a stream of changes: late rows, deletes, repeated batches, crashes."""

import random

import pytest
from pyspark.sql import functions as F

from lakewright.operators.changes import latest_snapshot
from lakewright.sinks import swaps
from lakewright.streaming import snapshots
from lakewright.streaming.ingest import new_files
from lakewright.workloads.staging import fresh_table

SCHEMA = "id int, at int, op string, v string"


def made(spark, tmp_path, buckets=4):
    schema = spark.createDataFrame([], SCHEMA).schema
    name = fresh_table(spark, str(tmp_path), "state")
    return snapshots.create_snapshot(spark, "lakewright", name, schema, str(tmp_path / "state"), ["id"], ["at"], "op", "delete", buckets)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def state(spark, snapshot):
    return sorted((tuple(r) for r in snapshot.rows(spark).collect()), key=str)


def test_late_changes_and_deletes(spark, tmp_path):
    snapshot = made(spark, tmp_path)
    assert state(spark, snapshot) == []
    assert snapshots.merge_changes(snapshot, changes(spark, (1, 5, "put", "a"), (2, 5, "put", "b"), (2, 7, "delete", None)), "b0")
    assert state(spark, snapshot) == [(1, 5, "put", "a")]
    snapshots.merge_changes(snapshot, changes(spark, (1, 3, "put", "late"), (2, 6, "put", "late"), (3, 1, "put", "c")), "b1")
    assert state(spark, snapshot) == [(1, 5, "put", "a"), (3, 1, "put", "c")]
    snapshots.merge_changes(snapshot, changes(spark, (2, 8, "put", "back"), (1, 9, "delete", None)), "b2")
    assert state(spark, snapshot) == [(2, 8, "put", "back"), (3, 1, "put", "c")]
    assert not snapshots.merge_changes(snapshot, changes(spark, (3, 99, "put", "never")), "b2")
    assert state(spark, snapshot) == [(2, 8, "put", "back"), (3, 1, "put", "c")]
    assert snapshots.forget_deleted(spark, snapshot, 9) == 0 and snapshots.forget_deleted(spark, snapshot, 10) == 1
    assert spark.table(snapshot.table).count() == 2


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    snapshot = made(spark, tmp_path, buckets=8)
    snapshots.merge_changes(snapshot, spark.range(100).selectExpr("CAST(id AS INT) AS id", "1 AS at", "'put' AS op", "'x' AS v"), "b0")
    before = swaps.partition_locations(spark, snapshot.table, ["_bucket"])
    snapshots.merge_changes(snapshot, changes(spark, (17, 2, "put", "y")), "b1")
    after = swaps.partition_locations(spark, snapshot.table, ["_bucket"])
    assert len(before) == 8 and sum(before[k] != after[k] for k in before) == 1
    snapshots.merge_changes(snapshot, changes(spark), "b2")
    assert swaps.partition_locations(spark, snapshot.table, ["_bucket"]) == after


def test_any_order_and_repeats_give_one_state(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.randint(0, 20) or None, rng.randint(0, 9), rng.choice(["put", "put", "delete", None]), rng.choice(["a", "b", None])) for _ in range(200)]
    states = []
    for turn in range(2):
        snapshot = made(spark, tmp_path / str(turn))
        rng.shuffle(rows)
        for number in range(4):
            snapshots.merge_changes(snapshot, changes(spark, *rows[number * 50 : number * 50 + 50 + turn * 20]), f"b{number}")
        states.append(sorted(map(str, state(spark, snapshot))))
    assert states[0] == states[1]
    newest = latest_snapshot(changes(spark, *rows), ["id"], ["at"], "op").select("id").collect()
    assert len(newest) == pytest.approx(len(states[0]), abs=3)  # rows with the same order are settled otherwise there


def test_a_crash_in_the_swap_is_mended_by_the_repeated_batch(spark, tmp_path, monkeypatch):
    snapshot = made(spark, tmp_path)
    rows = [(i, 1, "put", "a") for i in range(40)]
    snapshots.merge_changes(snapshot, changes(spark, *rows), "b0")
    relocate, taken = swaps._relocate, []

    def killed(*args):
        if len(taken) == 2:
            raise KeyboardInterrupt
        taken.append(args)
        relocate(*args)

    monkeypatch.setattr(swaps, "_relocate", killed)
    later = changes(spark, *((i, 2, "delete" if i % 2 else "put", "b") for i in range(40)))
    with pytest.raises(KeyboardInterrupt):
        snapshots.merge_changes(snapshot, later, "b1")
    monkeypatch.undo()
    assert snapshots.merge_changes(snapshot, later, "b1")
    assert state(spark, snapshot) == sorted(((i, 2, "put", "b") for i in range(0, 40, 2)), key=str)


def test_a_stream_of_files(spark, tmp_path):
    snapshot, landing = made(spark, tmp_path), str(tmp_path / "in")
    changes(spark, (1, 5, "put", "a"), (2, 5, "put", "b")).write.parquet(f"{landing}/drop=1")
    stream = new_files(spark, f"{landing}/drop=*", SCHEMA, suffix=".parquet")
    snapshots.keep_snapshot(stream, snapshot, str(tmp_path / "check"))
    changes(spark, (1, 4, "put", "late"), (2, 6, "delete", None), (3, 1, "put", "c")).write.parquet(f"{landing}/drop=2")
    snapshots.keep_snapshot(stream, snapshot, str(tmp_path / "check"))
    expected = [(1, 5, "put", "a"), (3, 1, "put", "c")]
    assert state(spark, snapshot) == expected
    snapshots.keep_snapshot(stream, snapshot, str(tmp_path / "check-anew"), "again")
    assert state(spark, snapshot) == expected
    with pytest.raises(ValueError, match="no columns"):
        snapshots.create_snapshot(spark, "lakewright", "t", spark.range(1).schema, str(tmp_path), ["id"], ["at"], "op")
