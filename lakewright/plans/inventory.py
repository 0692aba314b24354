"""An inventory of the columns of data files, kept up file by file, and the table schema that follows from it."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright import storage
from lakewright.sources.files import list_files

INVENTORY = "file_path string, modified timestamp, length bigint, position int, column_name string, column_type string"
READERS = 16  # files whose footers are read at the same time
FILES_AT_ONCE = 1000  # whose columns the driver holds before they are written

# Numbers widen along this chain; a decimal takes the place of the whole numbers that fit into it.
_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
TEXT = "string"


def update_inventory(spark: SparkSession, root: str, inventory: str, fmt: str = "parquet") -> int:
    """Add the columns of the files under ``root`` that the inventory does not know, or knows from another time; how many files.

    Only the footers of those files are read. A file's older rows stay until ``inventory_of`` passes over them.
    """
    pattern = f"*.{fmt}" if fmt == "parquet" else None
    listed = list_files(spark, root, pattern).select(F.col("path").alias("file_path"), F.col("modificationTime").alias("modified"), "length")
    if storage.entries(spark, inventory):
        known = spark.read.schema(INVENTORY).parquet(inventory).select("file_path", "modified", "length").distinct()
        listed = listed.join(known, ["file_path", "modified", "length"], "left_anti")
    count, block = 0, []
    for row in listed.toLocalIterator():  # names of new files, a partition at a time
        block.append(row)
        if len(block) == FILES_AT_ONCE:
            _add(spark, block, inventory, fmt)
            count, block = count + len(block), []
    if block:
        _add(spark, block, inventory, fmt)
    return count + len(block)


def _add(spark: SparkSession, files: list, inventory: str, fmt: str) -> None:
    def columns(file) -> list[tuple]:
        schema = spark.read.format(fmt).option("basePath", file["file_path"].rsplit("/", 1)[0]).load(file["file_path"]).schema
        told = (file["file_path"], file["modified"], file["length"])
        # A file without columns is known too.
        return [(*told, i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema)] or [(*told, -1, None, None)]

    with ThreadPoolExecutor(READERS) as pool:
        rows = [row for found in pool.map(columns, files) for row in found]
    spark.createDataFrame(rows, INVENTORY).coalesce(1).write.mode("append").parquet(inventory)


def inventory_of(spark: SparkSession, inventory: str) -> DataFrame:
    """The newest entry of every file, a row for each of its columns."""
    rows = spark.read.schema(INVENTORY).parquet(inventory)
    newest = rows.groupBy("file_path").agg(F.max("modified").alias("modified"))
    return rows.join(newest, ["file_path", "modified"]).where("column_name IS NOT NULL")


def wider(one: str, two: str) -> str | None:
    """The type that holds the values of both, text where only that does; None for types that have none in common.

    int → bigint → decimal → double, date → timestamp; nested types only widen to themselves.
    """
    if one == two:
        return one
    if any(t.startswith(("array", "map", "struct", "binary", "variant")) for t in (one, two)):
        return None
    ranked = [t for t in _WHOLE if t in (one, two)]
    if len(ranked) == 2:
        return ranked[1]
    decimals = [_digits(t) for t in (one, two)]
    if all(decimals):
        scale = max(s for _, s in decimals)
        whole = max(p - s for p, s in decimals)
        return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else "double"
    numbers = {*_WHOLE, "float", "double"}
    if all(t in numbers or t.startswith("decimal") for t in (one, two)):
        return "double"
    if {one, two} <= {"date", "timestamp_ntz", "timestamp"}:
        return "timestamp" if "timestamp" in (one, two) else "timestamp_ntz"
    return TEXT


def _digits(name: str) -> tuple[int, int] | None:
    if name in _WHOLE:
        return _WHOLE[name], 0
    if name.startswith("decimal("):
        precision, scale = name[8:-1].split(",")
        return int(precision), int(scale)
    return None


def schema_changes(inventory: DataFrame, known: T.StructType) -> DataFrame:
    """(column_name, change, known_type, found_type): what the files of an inventory have that a known schema has not.

    ``added`` columns; ``widened`` ones, whose files need a wider type than is known; ``conflict`` where no type holds all. Names that
    differ only in case are one column, under the known spelling or else the first one in the order of names. Files are counted by
    column and type first, so only distinct pairs reach the driver.
    """
    spark = inventory.sparkSession
    pairs = inventory.groupBy(F.lower("column_name").alias("name"), "column_type").agg(F.min("column_name").alias("spelt")).collect()
    before = {f.name.lower(): f for f in known}
    rows = []
    for name in sorted({p["name"] for p in pairs}):
        found = sorted(p["column_type"] for p in pairs if p["name"] == name)
        spelt = before[name].name if name in before else min(p["spelt"] for p in pairs if p["name"] == name)
        held = before[name].dataType.simpleString() if name in before else None
        types = found if held is None else [held, *found]
        joint = reduce(lambda a, b: None if a is None else wider(a, b), types)
        change = "conflict" if joint is None else "added" if held is None else "widened" if joint != held else None
        if change:
            rows.append((spelt, change, held, joint or ", ".join(found)))
    return spark.createDataFrame(rows, "column_name string, change string, known_type string, found_type string")


def changed_schema(known: T.StructType, changes: DataFrame) -> T.StructType:
    """The known schema with the added and widened columns of ``schema_changes``; a conflict is an error."""
    told = changes.collect()
    if conflicts := [f"{r['column_name']}: {r['known_type']} and {r['found_type']}" for r in told if r["change"] == "conflict"]:
        raise ValueError(f"no common type for {'; '.join(conflicts)}")
    types = {r["column_name"]: r["found_type"] for r in told}
    fields = [T.StructField(f.name, T._parse_datatype_string(types[f.name]) if f.name in types else f.dataType) for f in known]
    names = {f.name for f in known}
    return T.StructType(fields + [T.StructField(n, T._parse_datatype_string(t)) for n, t in sorted(types.items()) if n not in names])


def read_widened(spark: SparkSession, inventory: DataFrame, schema: T.StructType, base_path: str, fmt: str = "parquet") -> DataFrame:
    """The rows of all files of an inventory under one schema: files that store a column alike are read together, and cast.

    Columns that a file lacks are NULL. Each set of files of one layout is one scan.
    """
    layout = F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", F.concat(F.lit("`"), "column_name", F.lit("`")), "column_type"))), ", ")
    layouts = inventory.groupBy("file_path").agg(layout.alias("layout"))
    groups = layouts.groupBy("layout").agg(F.sort_array(F.collect_list("file_path")).alias("files")).orderBy("layout").collect()
    frames = []
    for group in groups:
        rows = spark.read.format(fmt).schema(group["layout"]).option("basePath", base_path).load(group["files"])
        present = {c.lower(): c for c in rows.columns}
        frames.append(
            rows.select(*((F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))
        )
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)
