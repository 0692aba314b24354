"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows and bytes that a Python task gets at a time; Spark's own 10,000 rows of text are tens of MB in the JVM and again in the worker.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Queries that run in this block hand few rows at a time to their Python tasks. How many they are changes no result."""
    before = {key: spark.conf.get(key) for key in SMALL_BATCHES}
    for key, value in SMALL_BATCHES.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let Spark remove the shuffle files of each query in this block when it ends, not when the driver's heap is next cleaned.

    Only for queries whose rows go to files: nothing reads their shuffles again.
    """
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def saved(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """The rows, written to the shared folder and read from there: lineage ends here, and lost executors do no harm."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): nodes have the same label if links lead from one to the other.

    The label is the least node of the component. Each node's link to its least neighbour comes first: there are no more of those than
    nodes, and they join most of a dense group. Of the other links only those count that lead from one of their components to another,
    each pair of components once.
    """
    ordered = links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return extended(_components(saved(ordered.groupBy("b").agg(F.min("a").alias("a")), "hooks")), ordered)


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) of the components of some links, brought up to date for further ``links`` (a, b)."""
    named = links.join(labels.toDF("a", "label_a"), "a", "left").join(labels.toDF("b", "label_b"), "b", "left")
    one, two = F.coalesce("label_a", "a"), F.coalesce("label_b", "b")
    across = named.where(one != two).select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
    across = saved(across, "across")
    if across.isEmpty():
        return labels
    second = _components(across)
    joined = labels.join(second.toDF("label", "least"), "label", "left").select("node", F.coalesce("least", "label").alias("label"))
    return saved(joined.unionByName(second.join(labels.select("node"), "node", "left_anti")), "components")


def _components(links: DataFrame) -> DataFrame:
    """The same from few links. Each round takes the least label among the neighbours and then that label's own
    label, so a path of n links takes about log2(n) rounds.
    """
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = links.where(F.col("a") != F.col("b")).select(F.inline(ends)).distinct()
    nodes = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("label"))
    labels = saved(nodes.withColumnRenamed("a", "node"), "labels")
    # A node is its own neighbour too, so one grouping gives the least label and the one before.
    near = saved(both.unionByName(nodes.select("a", F.col("a").alias("b"))), "neighbours")
    while True:
        seen = near.join(labels.select(F.col("node").alias("b"), "label"), "b")
        old = F.max(F.when(F.col("a") == F.col("b"), F.col("label")))
        lower = seen.groupBy("a").agg(F.min("label").alias("lower"), old.alias("old"))
        jump = labels.select(F.col("node").alias("lower"), F.col("label").alias("jump"))
        moved = lower.join(jump, "lower").select(F.col("a").alias("node"), "old", F.least("lower", "jump").alias("label"))
        moved = saved(moved, "labels")
        labels = moved.select("node", "label")
        if moved.where(F.col("old") != F.col("label")).isEmpty():
            return labels
