"""Manifests: exactly the listed files are read; what changed between two lists."""

import pytest
from pyspark.sql import functions as F

from lakewright.sinks.text import write_manifest
from lakewright.sources import manifests
from lakewright.sources.files import file_manifest


@pytest.fixture
def tree(spark, tmp_path):
    path = str(tmp_path / "a tree")
    spark.range(12).select("id", F.concat(F.lit("k/"), F.col("id") % 3).alias("kind")).write.partitionBy("kind").parquet(path)
    return path


def test_only_listed_files_are_read(spark, tmp_path, tree):
    write_manifest(file_manifest(spark.read.parquet(tree)), str(tmp_path / "list"))
    spark.range(100, 105).withColumn("kind", F.lit("k/1")).write.mode("append").partitionBy("kind").parquet(tree)
    assert spark.read.parquet(tree).count() == 17
    listed = manifests.read_manifest(spark, str(tmp_path / "list"))
    scanned = manifests.scan_manifest(spark, listed, tree)
    assert {(r["id"], r["kind"]) for r in scanned.collect()} == {(i, f"k/{i % 3}") for i in range(12)}
    direct = manifests.scan_manifest(spark, manifests.full_manifest(spark, tree).where("file_path LIKE '%252F1/%'"), tree)
    assert direct.count() == 9
    schema = scanned.schema
    assert manifests.scan_manifest(spark, listed.where("false"), tree, schema).collect() == []
    with pytest.raises(ValueError, match="schema"):
        manifests.scan_manifest(spark, listed.where("false"), tree)
    gone = spark.createDataFrame([(f"{tree}/kind=none/part-1.parquet",)], "file_path string")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        manifests.scan_manifest(spark, gone, tree).collect()


def test_differences(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", None, "x")], "file_path string, length int, other string")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 4)], "file_path string, length int")
    assert {tuple(r) for r in manifests.manifest_diff(old, new).collect()} == {("b", "changed"), ("d", "added")}
    assert {tuple(r) for r in manifests.manifest_diff(new, old.where("file_path = 'a'")).collect()} == {("b", "gone"), ("c", "gone"), ("d", "gone")}
    names = old.select("file_path")
    assert {tuple(r) for r in manifests.manifest_diff(names, new.select("file_path")).collect()} == {("d", "added")}
