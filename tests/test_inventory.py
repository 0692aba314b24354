"""Schema inventory: only new files are read; types widen or conflict."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.plans import inventory


@pytest.mark.parametrize(
    ("one", "two", "joint"),
    [
        ("int", "bigint", "bigint"), ("int", "int", "int"), ("bigint", "decimal(10,2)", "decimal(21,2)"), ("decimal(38,0)", "decimal(10,2)", "double"),
        ("float", "int", "double"), ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("int", "string", "string"), ("date", "int", "string"),
        ("array<int>", "array<bigint>", None), ("array<int>", "string", None), ("boolean", "int", "string"), ("struct<a:int>", "struct<a:int>", "struct<a:int>"),
    ],
)
def test_the_wider_type(one, two, joint):
    assert inventory.wider(one, two) == joint == inventory.wider(two, one)


def test_only_new_files_are_read(spark, tmp_path, monkeypatch):
    root, store = str(tmp_path / "data"), str(tmp_path / "inventory")
    spark.range(3).select(F.col("id").cast("int").alias("ID"), F.lit("x").alias("t"), F.lit(1).alias("n")).coalesce(1).write.parquet(f"{root}/day=1")
    assert inventory.update_inventory(spark, root, store) == 1 and inventory.update_inventory(spark, root, store) == 0
    known = spark.read.parquet(f"{root}/day=1").schema
    assert inventory.schema_changes(inventory.inventory_of(spark, store), known).count() == 0
    later = spark.range(3, 5).select("id", F.lit(2.5).alias("new"), F.array(F.lit(1)).alias("n"))
    later.coalesce(1).write.parquet(f"{root}/day=2")
    monkeypatch.setattr(inventory, "FILES_AT_ONCE", 1)
    assert inventory.update_inventory(spark, root, store) == 1
    held = inventory.inventory_of(spark, store)
    assert held.count() == 6
    changes = inventory.schema_changes(held, known)
    assert {tuple(r) for r in changes.collect()} == {
        ("ID", "widened", "int", "bigint"), ("new", "added", None, "double"), ("n", "conflict", "int", "array<int>, int")
    }
    with pytest.raises(ValueError, match="no common type for n"):
        inventory.changed_schema(known, changes)
    schema = inventory.changed_schema(known, changes.where("change <> 'conflict'"))
    assert schema.simpleString() == "struct<ID:bigint,t:string,n:int,new:double>"
    plain = T.StructType([f for f in schema if f.name != "n"])
    rows = inventory.read_widened(spark, held.where("column_name <> 'n'"), plain, root)
    assert sorted(map(tuple, rows.collect())) == [(0, "x", None), (1, "x", None), (2, "x", None), (3, None, 2.5), (4, None, 2.5)]


def test_files_that_are_written_again(spark, tmp_path):
    root, store = tmp_path / "data", str(tmp_path / "inventory")
    spark.range(1).coalesce(1).write.parquet(str(root))
    assert inventory.update_inventory(spark, str(root), store) == 1
    file = next(root.glob("*.parquet"))
    spark.range(1).withColumn("more", F.lit("m")).coalesce(1).write.parquet(str(tmp_path / "other"))
    file.write_bytes(next((tmp_path / "other").glob("*.parquet")).read_bytes())
    next(root.glob(f".{file.name}.crc"), file.with_suffix(".none")).unlink(missing_ok=True)
    import os

    os.utime(file, (4e9, 4e9))
    spark.catalog.refreshByPath(str(root))
    assert inventory.update_inventory(spark, str(root), store) == 1
    assert {r["column_name"] for r in inventory.inventory_of(spark, store).collect()} == {"id", "more"}
    assert inventory.read_widened(spark, inventory.inventory_of(spark, store).where("false"), spark.range(1).schema, str(root)).count() == 0


def test_a_broken_table_can_be_left_out(spark, tmp_path):
    from lakewright.plans.catalog import catalog_columns, create_database

    database = f"broken_{tmp_path.name[-6:]}".replace("-", "_")
    create_database(spark, database, str(tmp_path / "db"))
    spark.sql(f"CREATE TABLE {database}.good (a INT) USING parquet")
    spark.sql(f"CREATE TABLE {database}.base (b INT) USING parquet")
    spark.sql(f"CREATE VIEW {database}.bad AS SELECT b FROM {database}.base")
    spark.sql(f"DROP TABLE {database}.base")
    with pytest.raises(Exception, match="base"):
        catalog_columns(spark, database)
    assert [tuple(r) for r in catalog_columns(spark, database, skip_broken=True).collect()] == [(database, "good", "a", "int", 0)]
