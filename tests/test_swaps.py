"""Swaps of partitions: never a moment without rows, finished or taken back after a crash; versions in use stay."""

import datetime as dt
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakewright import storage
from lakewright.plans import catalog, jobs
from lakewright.sinks import swaps, tables
from lakewright.sources import files
from lakewright.workloads.staging import fresh_table

DATABASE = "lakewright"


@pytest.fixture
def days(spark, tmp_path):
    """An external table of three days of five rows each."""
    rows = spark.range(15).select("id", F.lit(0).alias("v"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("day"))
    name = fresh_table(spark, str(tmp_path), "days")
    tables.write_partitioned(rows, str(tmp_path / "days"), ("day",))
    catalog.register_external(spark, rows, DATABASE, name, str(tmp_path / "days"), partition_by=("day",))
    return f"{DATABASE}.{name}"


def values(spark, name):
    return {(r["day"].isoformat(), r["v"]): r["n"] for r in spark.table(name).groupBy("day", "v").agg(F.count("*").alias("n")).collect()}


OLD = {(f"2024-01-0{d}", 0): 5 for d in (1, 2, 3)}
NEW = {(f"2024-01-0{d}", 1): 5 for d in (1, 2, 3)}


@pytest.mark.parametrize("steps", [0, 1, 2, 3])
@pytest.mark.parametrize("undo", [False, True])
def test_a_swap_that_is_killed_after_any_step(spark, tmp_path, days, monkeypatch, steps, undo):
    relocate, taken = swaps._relocate, []

    def killed(*args):
        if len(taken) == steps:
            raise KeyboardInterrupt
        taken.append(args)
        relocate(*args)

    root = str(tmp_path / "root")
    monkeypatch.setattr(swaps, "_relocate", killed)
    if steps == 3:
        monkeypatch.setattr(storage, "remove", lambda spark, path: killed())  # of the note, at the end
    with pytest.raises(KeyboardInterrupt):
        tables.publish(spark.table(days).withColumn("v", F.lit(1)), root, days)
    monkeypatch.undo()
    spark.catalog.refreshTable(days)
    seen = values(spark, days)
    assert {day for day, _ in seen} == {day for day, _ in OLD} and set(seen.values()) == {5}
    assert sum(v for _, v in seen) == steps
    with pytest.raises(RuntimeError, match="unfinished"):
        tables.remove_old_versions(spark, root, "v99990101T000000-00000000", days)
    assert swaps.finish_swaps(spark, days, ["day"], root, undo) == 1
    assert values(spark, days) == (OLD if undo else NEW)
    assert swaps.finish_swaps(spark, days, ["day"], root) == 0 and not swaps.unfinished_swaps(spark, root)


def test_the_next_swap_finishes_the_last(spark, tmp_path, days, monkeypatch):
    def killed(*_):
        raise KeyboardInterrupt

    root, one = str(tmp_path / "root"), spark.createDataFrame([(dt.date(2024, 1, 1),)], "day date")
    monkeypatch.setattr(swaps, "_relocate", killed)
    with pytest.raises(KeyboardInterrupt):
        tables.replace_partitions(days, spark.table(days).where("day = '2024-01-01'").withColumn("v", F.lit(7)), one, root)
    monkeypatch.undo()
    two = spark.createDataFrame([(dt.date(2024, 1, 2),)], "day date")
    tables.replace_partitions(days, spark.table(days).where("day = '2024-01-02'").withColumn("v", F.lit(8)), two, root)
    assert values(spark, days) == {("2024-01-01", 7): 5, ("2024-01-02", 8): 5, ("2024-01-03", 0): 5}


def test_versions_that_partitions_lie_in_stay(spark, tmp_path, days):
    root, made = str(tmp_path / "root"), []
    for day in (1, 2, 1):
        one = spark.createDataFrame([(dt.date(2024, 1, day),)], "day date")
        made.append(tables.replace_partitions(days, spark.table(days).where(F.col("day") == dt.date(2024, 1, day)).withColumn("v", F.col("v") + 1), one, root))
        time.sleep(1.1)
    before = values(spark, days)
    with pytest.raises(ValueError, match="name the table"):
        tables.remove_old_versions(spark, root, made[-1])
    assert [p.rsplit("/", 1)[-1] for p in tables.remove_old_versions(spark, root, made[-1], days)] == [made[0].rsplit("/", 1)[-1]]
    assert values(spark, days) == before == {("2024-01-01", 2): 5, ("2024-01-02", 1): 5, ("2024-01-03", 0): 5}


def test_any_partition_value_can_be_replaced(spark, tmp_path):
    texts = ["c/d", "a:b=c", "é ü", "100%", "", None, "plain", "x'y"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, kind string")
    name, root = fresh_table(spark, str(tmp_path), "kinds"), str(tmp_path / "root")
    tables.write_partitioned(rows, str(tmp_path / "kinds"), ("kind",))
    catalog.register_external(spark, rows, DATABASE, name, str(tmp_path / "kinds"), partition_by=("kind",))
    full = f"{DATABASE}.{name}"
    assert all(storage.exists(spark, place) for place in swaps.partition_locations(spark, full, ["kind"]).values())
    for text in texts:
        one = spark.createDataFrame([(text,)], "kind string")
        same = F.col("kind").eqNullSafe(F.lit(text or None))  # an empty text is a NULL once it is a folder
        tables.replace_partitions(full, spark.table(full).where(same).withColumn("id", F.col("id") + 100), one, root)
    found = {(r["id"], r["kind"]) for r in spark.table(full).collect()}
    assert found == {(i + 100 * (2 if not t else 1), t or None) for i, t in enumerate(texts)}
    tables.replace_partitions(full, spark.table(full).where("false"), spark.createDataFrame([("c/d",), ("100%",)], "kind string"), root)
    assert {r["kind"] for r in spark.table(full).collect()} == {t or None for t in texts} - {"c/d", "100%"}


def test_timestamps_as_partitions(spark, tmp_path):
    rows = spark.sql("SELECT id, timestamp_ntz'2024-01-01 10:30:00' + make_dt_interval(0, id) AS at FROM range(3)")
    name, root = fresh_table(spark, str(tmp_path), "hours"), str(tmp_path / "root")
    tables.write_partitioned(rows, str(tmp_path / "hours"), ("at",))
    catalog.register_external(spark, rows, DATABASE, name, str(tmp_path / "hours"), partition_by=("at",))
    full = f"{DATABASE}.{name}"
    tables.replace_partitions(full, spark.table(full).where("id = 1").withColumn("id", F.lit(9).cast("bigint")), rows.where("id = 1").select("at"), root)
    assert sorted(r["id"] for r in spark.table(full).collect()) == [0, 2, 9]


def daily(spark, tmp_path, name, delete):
    rows = spark.table(name)
    return jobs.daily_delete_and_append(rows, str(tmp_path / "root"), str(tmp_path / "none"), dt.date(2024, 1, 16), delete=delete, table=name)


def test_deletes_that_mask_rows_take_effect(spark, tmp_path, days):
    run = daily(spark, tmp_path, days, lambda df: df.withColumn("v", F.when(F.col("id") == 4, 9).otherwise(F.col("v"))))
    assert (run.deleted, run.rewritten) == (True, 1)
    assert values(spark, days) == {("2024-01-01", 0): 5, ("2024-01-02", 0): 4, ("2024-01-02", 9): 1, ("2024-01-03", 0): 5}


def test_deletes_that_change_nothing_write_nothing(spark, tmp_path, days):
    before = sorted(tmp_path.rglob("*.parquet"))
    run = daily(spark, tmp_path, days, lambda df: df.where("id < 99"))
    assert (run.version, run.deleted, run.rewritten) == (None, False, 0)
    plain = spark.range(5).select("id", F.create_map(F.lit("k"), F.col("id")).alias("m"))
    for delete in (lambda df: df.where("id < 99"), lambda df: df.orderBy(F.desc("id"))):
        run = jobs.daily_delete_and_append(plain, str(tmp_path / "root"), str(tmp_path / "none"), dt.date(2024, 1, 16), delete=delete)
        assert (run.version, run.deleted) == (None, False)
    assert sorted(tmp_path.rglob("*.parquet")) == before
    run = jobs.daily_delete_and_append(plain, str(tmp_path / "root"), str(tmp_path / "none"), dt.date(2024, 1, 16), delete=lambda df: df.where("id > 1"))
    assert run.deleted and spark.read.parquet(run.version).count() == 3


def test_rows_that_trade_places_count_as_changed(spark, tmp_path, days):
    """As many rows as before in every partition, but others."""
    run = daily(spark, tmp_path, days, lambda df: df.withColumn("id", F.when(F.col("id") == 0, 3).when(F.col("id") == 3, 33).otherwise(F.col("id"))))
    assert run.rewritten == 1 and Counter(r["id"] for r in spark.table(days).collect()) == Counter([3, 33, *(i for i in range(15) if i not in (0, 3))])


def test_date_paths_are_added_to_or_overwritten(spark, tmp_path):
    root, day = str(tmp_path / "out"), F.lit("2024-03-05").cast("date")
    tables.write_date_paths(spark.range(3), root, day)
    tables.write_date_paths(spark.range(3, 5), root, day)
    assert spark.read.parquet(f"{root}/2024/03/05").count() == 5
    tables.write_date_paths(spark.range(7), root, day, mode="overwrite")
    tables.write_date_paths(spark.range(1), root, F.lit("2024-03-06").cast("date"), mode="overwrite")
    assert (spark.read.parquet(f"{root}/2024/03/05").count(), spark.read.parquet(f"{root}/2024/03/06").count()) == (7, 1)
    with pytest.raises(ValueError, match="mode"):
        tables.write_date_paths(spark.range(1), root, day, mode="ignore")
    assert [e.name for e in storage.entries(spark, root)] == ["2024"]


def test_only_folders_of_the_range_are_listed(spark, tmp_path):
    root = str(tmp_path / "tree")
    spark.sql("SELECT date_add(DATE'2024-01-01', CAST(id AS INT)) AS date, id FROM range(120)").write.partitionBy("date").parquet(root)
    (tmp_path / "tree" / "date=2024-01-11" ).rename(tmp_path / "elsewhere")
    first, last = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
    assert [e.rsplit("date=")[-1] for e in files.day_folders(spark, root, first, last)] == ["2024-01-10", "2024-01-12"]
    assert [r["day"] for r in files.missing_directories(spark, root, first, last).collect()] == [dt.date(2024, 1, 11)]
    assert len(files.day_folders(spark, root, dt.date(2023, 1, 1), dt.date(2025, 1, 1))) == 119
    assert files.missing_directories(spark, root, dt.date(2023, 12, 1), dt.date(2024, 4, 30)).count() == 31 + 1 + 1


def test_an_absent_root_misses_every_day(spark, tmp_path):
    missing = files.missing_directories(spark, str(tmp_path / "absent"), dt.date(2024, 1, 30), dt.date(2024, 2, 2))
    assert [r["day"].isoformat() for r in missing.orderBy("day").collect()] == ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02"]
