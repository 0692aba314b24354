"""Sources, and sinks read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.plans import inventory
from lakewright.plans.catalog import discover_table, register_external
from lakewright.plans.jobs import rebuild_table, register_lake_table
from lakewright.session import scratch_path
from lakewright.sinks.tables import (
    append_through_staging,
    clear_staging,
    write_date_paths,
    write_partitioned,
    write_table,
)
from lakewright.sinks.text import write_manifest
from lakewright.sources import files, manifests
from lakewright.sources.files import file_manifest
from lakewright.sources.lake import catalog_table, glob_scan, read_table
from lakewright.sources.loads import read_lines
from lakewright.streaming.ingest import ingest_available, new_files
from lakewright.streaming.snapshots import create_snapshot, keep_snapshot
from lakewright.workloads.registry import query, table, table_path
from lakewright.workloads.staging import DATABASE, dated_events, dated_tree, fresh_table, with_ingestion_date


@query("SELECT * FROM events")
def lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, table_path(sf_dir, "events"))


@query("SELECT *, CAST(ts AS DATE) AS ingestion_date FROM events", name="glob_scan")
def glob_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return glob_scan(spark, dated_events(spark, sf_dir, "glob"))


@query("SELECT * FROM customer")
def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = fresh_table(spark, sf_dir, "catalog_scan"), table_path(sf_dir, "customer")
    register_external(spark, read_table(spark, path), DATABASE, name, path)
    return catalog_table(spark, DATABASE, name)


@query("SELECT * FROM orders")
def external_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_table(spark, sf_dir, "external_table_scan")
    return register_lake_table(spark, table_path(sf_dir, "orders"), DATABASE, name)


@query("""
    SELECT CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines,
           CAST(sum(length(text) - len(string_split(text, chr(10))) + 1) AS BIGINT) AS n_chars
    FROM documents
""")
def text_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.option("lineSep", "\n").text(path)
    lines = read_lines(spark, path)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


@query("SELECT * FROM events")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of files, three runs: each file is taken in once."""
    events = table(spark, sf_dir, "events")
    landing, target, checkpoint = (scratch_path(spark, f"ingest-{part}") for part in ("landing", "target", "checkpoint"))
    early = F.col("event_type").eqNullSafe("view")
    write_table(events.where(early), f"{landing}/drop=1")
    stream = new_files(spark, f"{landing}/drop=*", events.schema, suffix=".parquet")
    ingest_available(stream, target, checkpoint)
    write_table(events.where(~early), f"{landing}/drop=2")
    ingest_available(stream, target, checkpoint)
    ingest_available(stream, target, checkpoint)
    return spark.read.schema(events.schema).parquet(target)


@query("SELECT *, CAST(ts AS DATE) AS ingestion_date FROM events")
def partitioned_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "rebuilt")
    # The source keeps one date per file, so the rebuild needs no shuffle.
    rebuild_table(spark, dated_events(spark, sf_dir, "rebuild"), target, clustered=True)
    return read_table(spark, target)


@query("SELECT CAST(ts AS DATE) AS ingestion_date, count(*) AS n_rows FROM events GROUP BY ALL", name="file_manifest")
def file_manifest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the listed files, per directory: how many files there are is up to the cluster."""
    listed = file_manifest(read_table(spark, dated_events(spark, sf_dir, "manifest")))
    directory = F.regexp_extract("file_path", r"/date=(\d{4}-\d{2}-\d{2})/", 1).cast("date")
    return listed.groupBy(directory.alias("ingestion_date")).agg(F.sum("n_rows").alias("n_rows"))


@query("""
    SELECT event_id, ts, user_id, event_type, value,
           CASE WHEN event_type IN ('click', 'error') THEN NULL ELSE props END AS props,
           CAST(ts AS DATE) AS ingestion_date, CAST(ts AS DATE) AS date
    FROM events
""")
def schema_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path becomes a table; later files bring a column, which the next discovery adds."""
    events = with_ingestion_date(table(spark, sf_dir, "events"))
    early = F.coalesce(F.col("event_type").isin("click", "error"), F.lit(False))
    root = dated_tree(spark, events.where(early).drop("props"), fresh_table(spark, sf_dir, "discovery"))
    name = discover_table(spark, root, DATABASE)
    later = events.where(~early).withColumn("date", F.col("ingestion_date"))
    later.hint("rebalance", "date").write.partitionBy("date").mode("append").parquet(root)
    discover_table(spark, root, DATABASE)
    return spark.table(name)


@query("""
    SELECT * FROM orders
    UNION ALL
    SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders
""")
def staged_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    name, location = fresh_table(spark, sf_dir, "staged_append"), scratch_path(spark, "appended")
    write_table(orders, location)
    register_external(spark, orders, DATABASE, name, location)
    full_name = f"{DATABASE}.{name}"
    doubled = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    day = spark.range(1).select(F.current_date()).first()[0]
    clear_staging(spark, append_through_staging(doubled, full_name, scratch_path(spark, "staging"), day))
    return spark.table(full_name)


@query("SELECT *, CAST(ts AS DATE) AS ingestion_date FROM events")
def rebuild_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rebuild from files that do not keep the dates apart."""
    source, target = scratch_path(spark, "mixed"), scratch_path(spark, "rebuilt")
    with_ingestion_date(table(spark, sf_dir, "events")).repartition(3).write.parquet(f"{source}/date=any")
    rebuild_table(spark, source, target)
    return read_table(spark, target)


@query("SELECT strftime(CAST(ts AS DATE), '%Y/%m/%d') AS folder, count(*) AS n_rows FROM events GROUP BY ALL")
def dated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files under root/YYYY/MM/DD."""
    root = scratch_path(spark, "dated-files")
    write_date_paths(table(spark, sf_dir, "events"), root, F.col("ts"))
    found = spark.read.option("recursiveFileLookup", "true").parquet(root)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}/\d{2}/\d{2})/[^/]+$", 1)
    return found.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
    SELECT day FROM (SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM events)
    WHERE NOT EXISTS (SELECT 1 FROM events WHERE CAST(ts AS DATE) = day AND day(CAST(ts AS DATE)) % 5 <> 0)
""")
def missing_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth day of the month has no directory."""
    events = with_ingestion_date(table(spark, sf_dir, "events"))
    first, last = events.agg(F.min("ingestion_date"), F.max("ingestion_date")).first()
    root = dated_tree(spark, events.where(F.dayofmonth("ingestion_date") % 5 != 0), "directories")
    return files.missing_directories(spark, root, first, last)


@query("SELECT *, CAST(ts AS DATE) AS ingestion_date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def partitioned_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose folders the catalog knows: a filter on their column lists only one."""
    name, path = fresh_table(spark, sf_dir, "partitioned_scan"), scratch_path(spark, "partitioned-scan")
    write_partitioned(with_ingestion_date(table(spark, sf_dir, "events")), path)
    registered = register_lake_table(spark, path, DATABASE, name, partition_by=("ingestion_date",))
    return registered.where("ingestion_date = DATE '2024-01-15'")


@query("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type IS DISTINCT FROM 'error'
""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state kept up by a stream of changes that arrive out of order, some of them again on a second stream."""
    events = table(spark, sf_dir, "events")
    landing = scratch_path(spark, "changes")
    snapshot = create_snapshot(
        spark, DATABASE, fresh_table(spark, sf_dir, "state"), events.schema, scratch_path(spark, "state"),
        ["user_id"], ["ts", "event_id"], "event_type", "error", buckets=16,
    )
    stream = new_files(spark, f"{landing}/drop=*", events.schema, suffix=".parquet")
    checkpoint = scratch_path(spark, "state-checkpoint")
    for drop, part in enumerate((2, 0, 1)):
        write_table(events.where(F.col("event_id") % 3 == part), f"{landing}/drop={drop}")
        keep_snapshot(stream, snapshot, checkpoint)
    write_table(events.where(F.col("event_id") % 3 > 0), f"{landing}-again/drop=0")
    again = new_files(spark, f"{landing}-again/drop=*", events.schema, suffix=".parquet")
    keep_snapshot(again, snapshot, scratch_path(spark, "state-checkpoint"), "again")
    return snapshot.rows(spark)


def _listed_events(spark: SparkSession, sf_dir: str) -> tuple[str, str, DataFrame]:
    """A tree of events that a manifest lists, and to which files were added since: its path, the manifest's, all events."""
    events = with_ingestion_date(table(spark, sf_dir, "events"))
    path, listed = scratch_path(spark, "listed"), scratch_path(spark, "list")
    clicks = F.coalesce(F.col("event_type") == "click", F.lit(False))
    write_partitioned(events.where(~clicks), path)
    write_manifest(manifests.full_manifest(spark, path), listed)
    events.where(clicks).hint("rebalance", "ingestion_date").write.mode("append").partitionBy("ingestion_date").parquet(path)
    return path, listed, events


@query("SELECT *, CAST(ts AS DATE) AS ingestion_date FROM events WHERE event_type IS DISTINCT FROM 'click'")
def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that were listed; those that came into the same folders since are not read."""
    path, listed, events = _listed_events(spark, sf_dir)
    return manifests.scan_manifest(spark, manifests.read_manifest(spark, listed), path, events.schema)


@query("""
    SELECT CAST(ts AS DATE) AS ingestion_date, 'added' AS change, count(*) AS n_rows FROM events WHERE event_type = 'click' GROUP BY ALL
""")
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the files that a second manifest has besides those of the first, per directory."""
    path, listed, _ = _listed_events(spark, sf_dir)
    now = file_manifest(read_table(spark, path))
    changes = manifests.manifest_diff(manifests.read_manifest(spark, listed), now.select("file_path")).join(now, "file_path")
    directory = F.regexp_extract("file_path", r"/ingestion_date=(\d{4}-\d{2}-\d{2})/", 1).cast("date")
    return changes.groupBy(directory.alias("ingestion_date"), "change").agg(F.sum("n_rows").alias("n_rows"))


@query("""
    SELECT * FROM (VALUES ('note', 'added', NULL, 'string'), ('event_id', 'widened', 'int', 'bigint'), ('value', 'widened', 'float', 'double'),
                          ('user_id', 'widened', 'int', 'string'), ('props', 'conflict', 'string', 'array<string>, string'))
        AS t(column_name, change, known_type, found_type)
    WHERE EXISTS (SELECT 1 FROM events WHERE event_type <> 'click')
""")
def schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose columns have other types than those that were known; only their footers are read, and only once."""
    events = table(spark, sf_dir, "events")
    root, store = scratch_path(spark, "inventoried"), scratch_path(spark, "inventory")
    early = events.where("event_type = 'click'").select(
        F.col("event_id").cast("int"), "ts", F.col("user_id").cast("int"), "event_type", F.col("value").cast("float"), "props"
    )
    write_table(early, f"{root}/drop=1")
    inventory.update_inventory(spark, root, store)
    known = early.schema
    later = events.where("event_type <> 'click'").withColumns(
        {"user_id": F.concat(F.lit("u"), "user_id"), "props": F.array("props"), "note": F.lit("late")}
    )
    write_table(later, f"{root}/drop=2")
    inventory.update_inventory(spark, root, store)
    return inventory.schema_changes(inventory.inventory_of(spark, store), known)


@query("""
    SELECT event_id, ts, CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) ELSE 'u' || user_id END AS user_id, event_type,
           CASE WHEN event_type = 'click' THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END AS value,
           CASE WHEN event_type <> 'click' THEN 'late' END AS note
    FROM events
""")
def schema_widened_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files under the schema that holds the values of each of them."""
    events = table(spark, sf_dir, "events")
    root, store = scratch_path(spark, "widened"), scratch_path(spark, "widened-inventory")
    clicks = F.coalesce(F.col("event_type") == "click", F.lit(False))
    early = events.where(clicks).select(
        F.col("event_id").cast("int"), "ts", F.col("user_id").cast("int"), "event_type", F.col("value").cast("float")
    )
    later = events.where(~clicks).withColumns({"user_id": F.concat(F.lit("u"), "user_id"), "note": F.when(F.col("event_type").isNotNull(), "late")})
    write_table(early, f"{root}/drop=1")
    write_table(later.drop("props"), f"{root}/drop=2")
    inventory.update_inventory(spark, root, store)
    held = inventory.inventory_of(spark, store)
    schema = inventory.changed_schema(early.schema, inventory.schema_changes(held, early.schema))
    return inventory.read_widened(spark, held, schema, root)
