"""Written intermediate tables and connected components, shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebeacon.session import work_dir


BROADCAST_ROWS = 200_000
# While a table is written: shuffle files go when the write has ended, and batches for Python stay small.
WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
}


# For a join of a large table with a filtered one: Spark sieves the large side by a Bloom filter of the
# other's keys (4 MB, whatever their number) before it shuffles.
SIEVED = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1m",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "33554432",
}


def stored(df: DataFrame, label: str, settings: dict[str, str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The frame, written once to the shared folder and read back: cuts lineage, survives lost executors.

    Shuffle files of the write are released when it has ended, so a long chain of steps needs disk
    for one step and its tables only. The frame itself must not be used again. A filter on the
    columns ``by`` reads the files of its values only.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    wanted = WHILE_WRITING | (settings or {})
    before = spark.conf.getAll
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        df.write.parquet(path, partitionBy=list(by) or None)
    finally:
        for name in wanted:
            if name in before:
                spark.conf.set(name, before[name])
            else:
                spark.conf.unset(name)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def unused_name(columns: Sequence[str], name: str) -> str:
    """``name``, with underscores before it as long as one of ``columns`` has that name."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def small_side(table: DataFrame) -> DataFrame:
    """A stored table of two numbers a row, marked for broadcasting if it is counted to have few rows.

    Beyond ``BROADCAST_ROWS`` (a few MB) the join is left to Spark, which then shuffles both sides.
    """
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def discard(*tables: DataFrame) -> None:
    """Removes the files of stored tables that nothing reads any more."""
    for table in tables:
        jvm, spark = table.sparkSession._jvm, table.sparkSession
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (a, b) reaches.

    Every round takes the smallest label among the neighbours and then follows labels one step,
    so paths shrink geometrically. Minima are combined before the shuffle, and a node with
    very many links is the split side of a join whose other side has one row per node.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    last = labels
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = stored(step.join(hop, "label").select("node", "old", F.least("label", "far").alias("label")), "labels")
        discard(last)
        labels, last = step.select("node", "label"), step
        if step.filter("old <> label").isEmpty():
            discard(both)
            return labels
