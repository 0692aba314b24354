"""Measures by partition: merged they equal those of the whole table; only what changed is read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakewright.operators.sizing import max_text_length
from lakewright.plans import catalog, measures
from lakewright.sinks import tables
from lakewright.workloads.metadata import incremental_sizing
from lakewright.workloads.staging import fresh_table

DATABASE = "lakewright"


@pytest.fixture
def target(spark, tmp_path):
    rows = spark.sql("""
        SELECT id, repeat('x', CAST(id % 50 AS INT)) AS t, CASE WHEN id % 4 = 0 THEN 'é' END AS u, CAST(NULL AS STRING) AS nothing,
               CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'a"b' ELSE concat('k/', id % 4) END AS kind, date_add(DATE'2024-01-01', CAST(id % 2 AS INT)) AS day
        FROM range(400)""")
    name = fresh_table(spark, str(tmp_path), "measured")
    tables.write_partitioned(rows, str(tmp_path / "table"), ("day", "kind"))
    catalog.register_external(spark, rows, DATABASE, name, str(tmp_path / "table"), partition_by=("day", "kind"))
    return f"{DATABASE}.{name}"


def merged(spark, target, store):
    return {r["column_name"]: (r["n_rows"], r["n_values"], r["max_length"]) for r in measures.table_measures(spark, target, store).collect()}


def whole(spark, target):
    rows = spark.table(target).drop("day", "kind")
    longest = {r["column_name"]: r["max_length"] for r in max_text_length(rows).collect()}
    return {c: (rows.count(), rows.where(f"{c} IS NOT NULL").count(), longest[c]) for c in longest}


def test_merged_measures_equal_those_of_the_whole(spark, tmp_path, target):
    store = str(tmp_path / "measures")
    assert len(measures.update_measures(spark, target, store)) == 4 and measures.update_measures(spark, target, store) == []
    assert merged(spark, target, store) == whole(spark, target)
    # A partition is added, one is replaced, one grows, one goes.
    more = spark.sql("SELECT 1L AS id, repeat('y', 99) AS t, 'zz' AS u, CAST(NULL AS STRING) AS nothing, DATE'2024-01-05' AS day, 'k/2' AS kind")
    tables.insert_by_position(more, target)
    tables.insert_by_position(more.withColumn("day", F.lit(dt.date(2024, 1, 1))), target)
    tables.replace_partitions(
        target, spark.table(target).where("day = '2024-01-02' AND kind = 'k/3'").limit(7),
        spark.createDataFrame([(dt.date(2024, 1, 2), "k/3"), (dt.date(2024, 1, 2), 'a"b')], "day date, kind string"), str(tmp_path / "root"),
    )
    spark.catalog.refreshTable(target)
    assert measures.update_measures(spark, target, store) == [("2024-01-01", "k/2"), ("2024-01-02", "k/3"), ("2024-01-05", "k/2")]
    assert merged(spark, target, store) == whole(spark, target)
    lengths = {r["column_name"]: r["lengths"] for r in measures.table_measures(spark, target, store).collect()}
    assert lengths["nothing"] is None and lengths["u"] == [1, 1] or lengths["u"] == [1, 2]
    assert abs(lengths["t"][0] - 25) <= 3


def test_only_changed_partitions_are_read(spark, tmp_path, target, monkeypatch, plan):
    store, seen = str(tmp_path / "measures"), []
    measures.update_measures(spark, target, store)
    extra = spark.sql("SELECT 1L AS id, 'y' AS t, 'zz' AS u, CAST(NULL AS STRING) AS nothing, DATE'2024-01-05' AS day, 'k/2' AS kind")
    tables.insert_by_position(extra, target)
    spark.catalog.refreshTable(target)
    plain = measures._measured
    monkeypatch.setattr(measures, "_measured", lambda rows, *a: seen.append(rows) or plain(rows, *a))
    measures.update_measures(spark, target, store)
    assert len(seen[0].select(F.col("_metadata.file_path")).distinct().collect()) == 1
    assert "PartitionFilters: [isnotnull(day" in plan(seen[0]) and "k/2" in plan(seen[0])


def test_measures_are_joined_and_written_in_one_small_part(spark, tmp_path, target, monkeypatch, plan):
    """Parts that come together only after the join each count the memory of its broadcast table, all in one task."""
    store, seen = str(tmp_path / "measures"), []
    plain = measures._told_and_measured
    monkeypatch.setattr(measures, "_told_and_measured", lambda *a: seen.append(plain(*a)) or seen[-1])
    measures.update_measures(spark, target, store)
    assert "Cartesian" not in plan(seen[0]) and "NestedLoop" not in plan(seen[0])
    assert seen[0].rdd.getNumPartitions() == 1
    # Coalesce, if any, stands below the join.
    text = plan(seen[0])
    assert text.index("BroadcastHashJoin") < text.index("Coalesce 1")


def test_every_event_is_measured(spark, tmp_path):
    """Views too, and clicks without a time, whose day is in neither half of a month."""
    rows = [
        (1, dt.datetime(2024, 1, 2), "click", "a" * 3), (2, dt.datetime(2024, 1, 20), "click", "b" * 4), (3, dt.datetime(2024, 1, 2), "view", "c" * 50),
        (4, dt.datetime(2024, 1, 20), "view", None), (5, None, "click", "d" * 5), (6, None, None, "e"), (7, dt.datetime(2024, 1, 3), "error", "f"),
    ]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, event_type string, props string")
    events.selectExpr("event_id", "ts", "event_id AS user_id", "event_type", "1.5D AS value", "props").write.parquet(str(tmp_path / "events.parquet"))
    found = incremental_sizing(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == [("event_type", 7, 6, 6), ("props", 7, 6, 60)]
