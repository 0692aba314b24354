"""Sources, sinks, streams and jobs: what ends up in files and tables."""

import datetime as dt
import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions.dates import in_previous_day, is_previous_day
from lakewright.operators.changes import delete_keys, delete_where
from lakewright.operators.columns import deny
from lakewright.plans import catalog, jobs
from lakewright.session import scratch_path
from lakewright.sinks import tables
from lakewright.sinks.text import write_csv, write_manifest
from lakewright.sources import files, jdbc, lake, loads
from lakewright.streaming.ingest import ingest_available, new_files


@pytest.fixture
def path(spark, tmp_path):
    return str(tmp_path / "data")


@pytest.fixture
def database(spark, tmp_path):
    name = f"f{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def dated(spark, n=10):
    return spark.range(n).withColumn("date", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 3).cast("int")))


def test_read_table_raises(spark, path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.read_table(spark, path)
    with pytest.raises(Exception, match="delta"):
        lake.read_table(spark, path, "delta")


def test_glob_scan_columns(spark, path):
    tables.write_partitioned(dated(spark), path, ("date",))
    assert lake.glob_scan(spark, path).columns == ["id"]
    assert set(lake.glob_scan(spark, path, keep_partition_cols=True).columns) == {"id", "date"}
    assert lake.glob_scan(spark, path + "/", "date=2024-01-02/part-*.parquet").count() == 3


def test_overwrite_modes(spark, path):
    tables.write_partitioned(dated(spark), path, ("date",))
    one_day = dated(spark, 1)
    tables.write_partitioned(one_day, path, ("date",), overwrite="dynamic")
    assert spark.read.parquet(path).count() == 7
    tables.write_partitioned(one_day, path, ("date",))
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        tables.write_partitioned(one_day, path, ("date",), overwrite="some")


def test_rebalanced_partitions_get_few_files(spark, path):
    tables.write_partitioned(dated(spark, 10_000).repartition(16), path, ("date",))
    assert len(glob.glob(f"{path}/date=2024-01-01/*.parquet")) == 1


def test_partition_filters_prune(spark, path, plan):
    tables.write_partitioned(dated(spark), path, ("date",))
    physical = plan(spark.read.parquet(path).where(is_previous_day(F.col("date"), dt.date(2024, 1, 3))))
    assert "PartitionFilters: [isnotnull(date" in physical
    assert "2024-01-02" in physical.split("Physical Plan")[1]


def test_timestamp_bounds_reach_the_scan(events, plan):
    physical = plan(events.where(in_previous_day(F.col("ts"), dt.date(2024, 1, 3))))
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in physical
    assert "LessThan(ts,2024-01-03T00:00)" in physical


def test_csv_header_of_an_empty_frame(spark, path):
    empty = spark.createDataFrame([], "a int, b string")
    write_csv(empty, path)
    text = "".join(open(f).read() for f in glob.glob(f"{path}/part-*.csv"))
    assert text == "a,b\n"
    assert loads.load_csv(spark, path, empty.schema).count() == 0


def test_csv_delimiter_and_awkward_text(spark, path):
    df = spark.createDataFrame([(1, 'say "hi", ok'), (2, ""), (3, None), (4, "back\\slash|")], "n int, t string")
    loads.escaped(df).write.options(**loads.CSV_OPTIONS, sep="|").csv(path)
    got = {r["n"]: r["t"] for r in loads.load_csv(spark, path, df.schema, "|").collect()}
    assert got == {1: 'say "hi", ok', 2: "", 3: None, 4: "back\\slash|"}


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_load_files(spark, path, fmt):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, t string")
    df.write.format(fmt).save(path)
    assert sorted(map(tuple, loads.load_files(spark, path, fmt, schema=df.schema).collect())) == [(1, "a"), (2, "b")]


def test_nested_values_as_json(spark, path):
    df = spark.createDataFrame([(1, [1, None], {"k": 2}, ("x",))], "i int, l array<int>, m map<string,int>, s struct<a:string>")
    df.withColumn("date", F.lit(dt.date(2024, 4, 18))).write.partitionBy("date").parquet(path)
    got = loads.load_parquet_as_json(spark, path, dt.date(2024, 4, 18))
    assert tuple(got.first()) == (1, "[1,null]", '{"k":2}', '{"a":"x"}')


def test_load_by_name(spark, path):
    target = spark.createDataFrame([], "k bigint, v string")
    spark.createDataFrame([("a", 1)], "v string, k int").write.json(path)
    assert tuple(loads.load_by_name(spark, path, target, "json").first()) == (1, "a")


def test_read_lines(spark, path):
    spark.createDataFrame([("a\r\n\nb",), ("",)], "t string").write.text(path)
    assert sorted(r[0] for r in loads.read_lines(spark, path).collect()) == ["", "", "a\r", "b"]


def checked(spark, path, staging):
    schema = T.StructType().add("id", "integer").add("name", "string").add("note", "string").add("at", "date")
    return loads.checked_csv_load(spark, path, schema, "t", 5, dt.datetime(2024, 1, 1), {"name": 3}, staging=staging)


@pytest.mark.parametrize("staged", [False, True])
def test_checked_load(spark, tmp_path, staged):
    lines = ["id,name,note,at", "1,abc,n,2024-01-01", "x,abcd,n,2024-01-01", "2,,,", "3,abc,n", "4,abc,n,2024-01-01,more", "5,abc,n,nodate"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    load = checked(spark, str(tmp_path / "in.csv"), str(tmp_path / "staged") if staged else None)
    assert sorted(map(tuple, load.rows.collect())) == [(1, "abc", "n", dt.date(2024, 1, 1)), (2, None, None, None)]
    errors = [(r["column_name"], r["raw_value"], r["error_message"]) for r in loads.errors_of_load(load.errors, 5).collect()]
    assert sorted(errors) == sorted([
        ("id", "x", "invalid value"), ("name", "abcd", "value too long"), ("at", "nodate", "invalid value"),
        ("", "3,abc,n", "wrong number of fields"), ("", "4,abc,n,2024-01-01,more", "wrong number of fields"),
    ])
    assert load.errors.first()["file_name"].endswith("/in.csv")
    assert loads.errors_of_load(load.errors, 6).count() == 0
    history = load.history.first()
    assert (history["loaded_rows"], history["error_rows"], history["error_count"]) == (2, 4, 5)
    assert history["status"] == "completed with errors"


def test_errors_are_newest_first(spark):
    found = [(i, day, "f", "c", "x") for i, day in ((1, "2024-01-01"), (2, "2024-01-03"), (3, "2024-01-02"))]
    df = spark.createDataFrame(found, "query_id bigint, start_time string, file_name string, column_name string, raw_value string")
    assert [r[0] for r in loads.newest_errors(df).collect()] == [2, 3, 1]


def test_file_listing(spark, path):
    tables.write_partitioned(dated(spark), path, ("date",))
    listed = files.list_files(spark, path, "*.parquet")
    assert listed.columns == ["path", "length", "modificationTime"]
    assert listed.count() == len(glob.glob(f"{path}/*/*.parquet"))
    assert files.existing_directory(spark, path, dt.date(2024, 1, 2)) == f"{path}/date=2024-01-02/"
    assert files.existing_directory(spark, path, dt.date(2025, 1, 2)) is None
    os.makedirs(f"{path}/date=2025-01-02")
    assert files.existing_directory(spark, path, dt.date(2025, 1, 2)) is None


def test_file_listing_reads_no_content(spark, path, plan):
    dated(spark).write.parquet(path)
    scan = plan(files.list_files(spark, path)).split("Physical Plan")[1]
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in scan


def test_manifest_of_files(spark, path, tmp_path):
    dated(spark, 30).repartition(3).write.parquet(path)
    manifest = files.file_manifest(spark.read.parquet(path))
    assert manifest.count() == 3
    assert manifest.agg(F.sum("n_rows")).first()[0] == 30
    write_manifest(manifest, str(tmp_path / "manifest"))
    assert spark.read.text(str(tmp_path / "manifest")).where("value like '%.parquet'").count() == 3


def test_date_paths(spark, path):
    tables.write_date_paths(dated(spark), path, F.col("date"))
    assert os.path.isdir(f"{path}/2024/01/02")


def test_publish_moves_the_catalog_entry(spark, database, tmp_path):
    root = str(tmp_path / "versions")
    first = tables.publish(spark.range(3), root)
    catalog.register_external(spark, spark.range(1), database, "t", first)
    name = f"{database}.t"
    # The new version is computed from the table it replaces.
    second = tables.publish(spark.table(name).union(spark.range(2)), root, name)
    assert second != first
    assert spark.table(name).count() == 5
    assert spark.read.parquet(first).count() == 3


def test_staged_append_keeps_duplicates_then_clears(spark, database, tmp_path):
    catalog.create_table_if_absent(spark, database, "t", "id BIGINT", str(tmp_path / "t"))
    for _ in range(2):
        staged = tables.append_through_staging(spark.range(4), f"{database}.t", str(tmp_path), dt.date(2024, 4, 6))
    assert "/tmp/date=2024-04-06/" in staged
    assert spark.table(f"{database}.t").count() == 8
    assert spark.read.parquet(staged).count() == 4
    tables.clear_staging(spark, staged)
    assert spark.read.parquet(staged).count() == 0
    assert spark.read.parquet(staged).columns == ["id"]


def test_refresh(spark, path):
    spark.range(2).write.parquet(path)
    df = spark.read.parquet(path)
    assert df.count() == 2
    tables.write_table(spark.range(5), path)
    tables.refresh_path(spark, path)
    assert spark.read.parquet(path).count() == 5


def test_warehouse_connection_options(monkeypatch):
    monkeypatch.setenv("WH_USER", "u")
    monkeypatch.setenv("WH_PASSWORD", "p")
    assert jdbc.connection_options("jdbc:x:y", {"driver": "d"}, "WH") == {
        "url": "jdbc:x:y", "user": "u", "password": "p", "driver": "d",
    }
    with pytest.raises(KeyError):
        jdbc.connection_options("jdbc:x:y", credentials_prefix="ABSENT")


def test_partitioned_warehouse_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        jdbc.read_query(spark, {"url": "jdbc:x:y"}, "SELECT 1", "id")


def test_each_file_is_ingested_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / p) for p in ("landing", "target", "checkpoint"))

    def run():
        stream = new_files(spark, landing, "id bigint", suffix=".parquet", max_files_per_batch=2)
        ingest_available(stream, target, checkpoint, transform=lambda df: df.where("id >= 0"))
        return spark.read.parquet(target).count()

    spark.range(20).repartition(5).write.parquet(landing)
    (tmp_path / "landing" / "note.txt").write_text("not data")
    assert run() == 20
    assert run() == 20
    spark.range(-3, 7).write.mode("append").parquet(landing)
    assert run() == 27


def export(spark, root, day, ids, fmt="json"):
    spark.createDataFrame([("masked", i) for i in ids], "v string, id int").write.format(fmt).save(f"{root}/date={day}")


@pytest.fixture
def ddr(spark, tmp_path):
    export(spark, tmp_path / "exports", "2024-04-06", [100, 101])
    export(spark, tmp_path / "exports", "2024-04-05", [90])
    target = spark.range(5).withColumn("v", F.lit("x"))

    def run(as_of=dt.date(2024, 4, 7), **options):
        done = jobs.daily_delete_and_append(
            target, str(tmp_path / "out"), str(tmp_path / "exports"), as_of, append_fmt="json", **options
        )
        # Nothing to do: nothing is written, and the table stands as it is.
        ids = sorted(r[0] for r in (spark.read.parquet(done.version) if done.version else target).collect())
        assert done.appended == any(i > 4 for i in ids)
        return done.deleted, ids

    return run


def test_daily_job(spark, ddr):
    keys = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert ddr(delete=lambda df: delete_keys(df, keys, ["id"])) == (True, [0, 3, 4, 100, 101])
    assert ddr(delete=lambda df: delete_where(df, F.col("id") > 2), scope="prefix") == (True, [0, 1, 2, 90, 100, 101])
    assert ddr(as_of=dt.date(2024, 4, 9)) == (False, [0, 1, 2, 3, 4])


def test_daily_job_with_a_failing_delete(ddr):
    failures = [
        lambda df: df.where("no_such_column = 1"),  # fails when the plan is made
        lambda df: df.where(F.raise_error(F.lit("broken")).isNull()),  # fails while rows are computed
    ]
    for delete in failures:
        assert ddr(delete=delete) == (False, [0, 1, 2, 3, 4, 100, 101])
        with pytest.raises(Exception):
            ddr(delete=delete, on_delete_error="fail")
    with pytest.raises(ValueError):
        ddr(on_delete_error="ignore")


def test_upsert_job_moves_the_table(spark, database, tmp_path):
    root, staging = str(tmp_path / "v"), str(tmp_path / "staging")
    start = spark.range(3).withColumn("v", F.lit("old"))
    catalog.register_external(spark, start, database, "t", tables.publish(start, root))
    target = spark.table(f"{database}.t")
    source = spark.range(2, 5).withColumn("v", F.lit("new"))
    jobs.upsert_through_staging(target, source, ["id"], root, staging, table=f"{database}.t")
    got = sorted(map(tuple, spark.table(f"{database}.t").collect()))
    assert got == [(0, "old"), (1, "old"), (2, "new"), (3, "new"), (4, "new")]
    assert spark.read.parquet(staging).count() == 0


def test_size_and_load_appends_and_checks_lengths(spark, database, tmp_path):
    df = spark.createDataFrame([(1, "abcdefghij", [1, 2])], "id int, t string, l array<int>")
    jobs.size_and_load(df, database, "t", str(tmp_path / "t"))
    loaded = spark.table(f"{database}.t")
    assert tuple(loaded.first()) == (1, "abcdefghij", "[1,2]")
    jobs.size_and_load(df, database, "t", str(tmp_path / "t"))
    assert spark.table(f"{database}.t").count() == 2
    longer = spark.createDataFrame([(1, "x" * 13, [1])], "id int, t string, l array<int>")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        jobs.size_and_load(longer, database, "t", str(tmp_path / "t"))


def test_consumer_extract_writes_csv(spark, path):
    df = spark.range(30).withColumn("secret", F.lit("s")).withColumn("v", F.lit("ok"))
    jobs.consumer_extract(df, deny("secret"), path, order_by=["id"])
    got = loads.load_csv(spark, path, "id bigint, v string")
    assert sorted(r[0] for r in got.collect()) == list(range(10))


def test_rebuild_table(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    rows = dated(spark).withColumn("ingestion_date", F.col("date"))
    tables.write_partitioned(rows, source, ("date",))
    jobs.rebuild_table(spark, source, target)
    assert spark.read.parquet(target).count() == 10
    assert sorted(os.path.basename(d) for d in glob.glob(f"{target}/ingestion_date=*"))[0] == "ingestion_date=2024-01-01"


def test_dummy_copy(spark, tmp_path):
    spark.createDataFrame([("a", 5, 6)], "s string, i int, b bigint").write.parquet(str(tmp_path / "s"))
    jobs.dummy_copy(spark, str(tmp_path / "s"), str(tmp_path / "t"))
    assert tuple(spark.read.parquet(str(tmp_path / "t")).first()) == ("dummy_value", 0, 6)
