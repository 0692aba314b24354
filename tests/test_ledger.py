"""Loads that happen once, whatever is lost in between."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakewright import storage
from lakewright.plans import catalog
from lakewright.sinks import ledger, tables
from lakewright.workloads.staging import fresh_table

DATABASE = "lakewright"


@pytest.fixture(params=[(), ("day",)])
def target(spark, tmp_path, request):
    rows = spark.sql("SELECT id, date_add(DATE'2024-01-01', CAST(id % 2 AS INT)) AS day FROM range(6)")
    name = fresh_table(spark, str(tmp_path), "ledger")
    if request.param:
        tables.write_partitioned(rows, str(tmp_path / "table"), request.param)
    else:
        tables.write_table(rows, str(tmp_path / "table"))
    catalog.register_external(spark, rows, DATABASE, name, str(tmp_path / "table"), partition_by=request.param)
    return f"{DATABASE}.{name}"


def rows_of(spark, table):
    return sorted((r["id"], r["day"].day) for r in spark.table(table).collect())


OLD = [(i, 1 + i % 2) for i in range(6)]


def test_a_load_happens_once(spark, tmp_path, target):
    new = spark.sql("SELECT CAST(id AS INT) AS other, CAST('2024-01-07' AS DATE) AS name FROM range(10, 13)")
    run = lambda load_id: ledger.append_once(new, target, load_id, str(tmp_path / "ledger"), str(tmp_path / "staging"))
    assert run("a/b 1") == ledger.Load("a/b 1", True, 3) and run("a/b 1") == ledger.Load("a/b 1", False, 3)
    assert rows_of(spark, target) == OLD + [(i, 7) for i in (10, 11, 12)]
    assert run("second").finished_now and rows_of(spark, target) == OLD + sorted([(i, 7) for i in (10, 11, 12)] * 2)
    noted = ledger.load_ledger(spark, str(tmp_path / "ledger")).collect()
    assert {(r["load_id"], r["state"], r["n_rows"]) for r in noted} == {("a/b 1", "done", 3), ("second", "done", 3)}
    assert all(r["staged_at"] <= r["done_at"] and r["table_name"] == target for r in noted)
    wanted = spark.createDataFrame([("a/b 1", target), ("third", target), ("second", "other")], "load_id string, table_name string")
    assert {(r["load_id"]) for r in ledger.pending_loads(spark, str(tmp_path / "ledger"), wanted).collect()} == {"third", "second"}
    assert storage.data_files(spark, str(tmp_path / "staging")) == []


@pytest.mark.parametrize("step", range(8))
def test_a_load_that_is_killed_at_any_step(spark, tmp_path, target, monkeypatch, step):
    new = spark.sql("SELECT id, date_add(DATE'2024-01-02', CAST(id % 2 AS INT)) AS day FROM range(10, 16)").repartition(2)
    places = (str(tmp_path / "ledger"), str(tmp_path / "staging"))
    taken, plain = [], {name: getattr(storage, name) for name in ("move", "write_text", "remove")}

    def counted(name):
        def call(*args):
            if len(taken) == step:
                raise KeyboardInterrupt
            taken.append(name)
            return plain[name](*args)

        return call

    for name in plain:
        monkeypatch.setattr(storage, name, counted(name))
    killed = False
    try:
        ledger.append_once(new, target, "load", *places)
    except KeyboardInterrupt:
        killed = True
    monkeypatch.undo()
    assert killed or step > 6
    other = new.where("false")  # a load that has staged its rows does not look at these
    staged = [r["state"] for r in ledger.load_ledger(spark, places[0]).collect()]
    again = ledger.append_once(other if staged else new, target, "load", *places)
    assert again.n_rows == 6
    assert rows_of(spark, target) == sorted(OLD + [(i, 2 + i % 2) for i in range(10, 16)])
    assert not ledger.append_once(new, target, "load", *places).finished_now


def test_partitions_that_were_replaced_get_their_files(spark, tmp_path):
    rows = spark.sql("SELECT id, DATE'2024-01-01' AS day FROM range(3)")
    name = f"{DATABASE}.{fresh_table(spark, str(tmp_path), 'replaced')}"
    tables.write_partitioned(rows, str(tmp_path / "table"), ("day",))
    catalog.register_external(spark, rows, DATABASE, name.split(".")[1], str(tmp_path / "table"), partition_by=("day",))
    tables.replace_partitions(name, rows.where("id > 0"), spark.createDataFrame([(dt.date(2024, 1, 1),)], "day date"), str(tmp_path / "root"))
    ledger.append_once(rows.withColumn("id", F.col("id") + 10), name, "x", str(tmp_path / "ledger"), str(tmp_path / "staging"))
    assert sorted(r["id"] for r in spark.table(name).collect()) == [1, 2, 10, 11, 12]


def test_wrong_rows_and_no_ledger(spark, tmp_path, target):
    with pytest.raises(ValueError, match="2 columns"):
        ledger.append_once(spark.range(1), target, "x", str(tmp_path / "ledger"), str(tmp_path / "staging"))
    assert ledger.load_ledger(spark, str(tmp_path / "absent")).count() == 0
