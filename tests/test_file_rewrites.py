"""Deletes by file: untouched files stay, a crash is finished later, Bloom filters reach the scan."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakewright import storage
from lakewright.sinks import file_rewrites
from lakewright.sinks.file_rewrites import delete_keys_in_files, files_with_keys, finish_rewrites, write_keyed


@pytest.fixture
def tree(spark, tmp_path):
    """Two days with four files each; user n is in file n % 4 of both."""
    path = str(tmp_path / "tree")
    for part in range(4):
        rows = spark.range(100).where(f"id % 4 = {part}").select(F.col("id").alias("user_id"), F.lit(part).alias("part"), F.explode(F.array(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 2)))).alias("day"))
        write_keyed(rows, path, ["user_id"], ["day"], distinct_keys=100, mode="append")
    return path


def stamps(path):
    import os

    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                full = os.path.join(folder, name)
                found[full.removeprefix(f"{path}/")] = os.stat(full).st_mtime_ns
    return found


def test_untouched_files_of_touched_partitions_keep_names_and_times(spark, tree):
    before = stamps(tree)
    keys = spark.createDataFrame([(5,), (9,), (None,), (1000,)], "user_id bigint")
    change = delete_keys_in_files(spark, tree, keys, ["user_id"], ["day"])
    after = stamps(tree)
    assert len(change.replaced) == 2 and set(change.replaced) == set(before) - set(after)
    assert {f: t for f, t in before.items() if f not in change.replaced} == {f: t for f, t in after.items() if f not in change.written}
    rows = spark.read.parquet(tree)
    assert rows.count() == 196 and rows.where("user_id IN (5, 9)").count() == 0 and rows.where("day = DATE'2024-01-01'").count() == 98
    assert storage.entries(spark, f"{tree}/_rewrites") == [] and not [e for e in storage.entries(spark, tree) if e.name.startswith("_rewrite-")]
    nothing = delete_keys_in_files(spark, tree, keys, ["user_id"], ["day"])
    assert (nothing.replaced, nothing.written) == ((), ()) and stamps(tree) == after


def test_keys_of_several_columns_and_whole_files(spark, tree):
    keys = spark.sql("SELECT id AS user_id, DATE'2024-01-02' AS day FROM range(100) WHERE id % 4 = 2")
    change = delete_keys_in_files(spark, tree, keys, ["user_id", "day"], ["day"])
    assert len(change.replaced) == 1 and change.replaced[0].startswith("day=2024-01-02/") and change.written == ()
    assert spark.read.parquet(tree).groupBy("day").count().orderBy("day").collect() == [(dt.date(2024, 1, 1), 100), (dt.date(2024, 1, 2), 75)]


@pytest.mark.parametrize("step", range(7))
def test_a_rewrite_that_is_killed_at_any_step(spark, tree, monkeypatch, step):
    taken, plain = [], {name: getattr(storage, name) for name in ("move", "remove")}

    def counted(name):
        def call(*args):
            if len(taken) == step:
                raise KeyboardInterrupt
            taken.append(name)
            return plain[name](*args)

        return call

    keys = spark.createDataFrame([(5,)], "user_id bigint")
    for name in plain:
        monkeypatch.setattr(storage, name, counted(name))
    with pytest.raises(KeyboardInterrupt):
        delete_keys_in_files(spark, tree, keys, ["user_id"], ["day"])
    monkeypatch.undo()
    # The first step is the note itself: without it nothing has happened, and the delete is still to be done.
    assert finish_rewrites(spark, tree) == (step > 0)
    rows = spark.read.parquet(tree)
    assert rows.count() == (198 if step else 200) and rows.distinct().count() == rows.count()


def test_the_keys_reach_the_scan_and_filters_are_written(spark, tree, monkeypatch):
    rows, plans = spark.read.parquet(tree), []
    plain = file_rewrites.matching_keys
    monkeypatch.setattr(file_rewrites, "matching_keys", lambda df, *a, **k: plans.append(df._jdf.queryExecution().toString()) or plain(df, *a, **k))
    keys = spark.range(12, 40).where("id % 4 = 0").select(F.col("id").alias("user_id"))
    assert len(files_with_keys(rows, keys, ["user_id"])) == 2
    assert "PushedFilters: [In(user_id" in plans[0] or "In(user_id" in plans[0].split("PushedFilters")[1]
    group = pq.ParquetFile(f"{tree}/{next(iter(stamps(tree)))}").metadata.row_group(0)
    names = [group.column(i).path_in_schema for i in range(group.num_columns)]
    assert "user_id" in names
    monkeypatch.setattr(file_rewrites, "PUSHED_KEYS", 2)
    assert len(files_with_keys(rows, keys, ["user_id"])) == 2
