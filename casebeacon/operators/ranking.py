"""Positions of rows in one order over a whole table, without bringing them to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebeacon.session import work_dir

ROWS_PER_TASK = 1_000_000


def ranked(df: DataFrame, order: Sequence[Column], name: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows with ``name``: their position from 0 by ``order``, which should leave no ties.

    Spark sorts the rows over range partitions and writes them to the shared folder with their number in the
    partition; the sizes of the partitions before are added to it. The driver sees one count per
    partition.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, "ranked")
    tasks = max(1, -(-df.count() // rows_per_task))
    numbered = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id())
    numbered.write.parquet(path)
    kept = spark.read.schema(numbered.schema).parquet(path)
    part = F.shiftright(name, 33)
    before, total = [], 0
    for row in kept.groupBy(part.alias("part")).count().orderBy("part").collect():
        before.append((row["part"], total))
        total += row["count"]
    starts = F.broadcast(spark.createDataFrame(before, "_part bigint, _before bigint"))
    place = F.col("_before") + F.col(name).bitwiseAND((1 << 33) - 1)
    return kept.withColumn("_part", part).join(starts, "_part").withColumn(name, place).drop("_part", "_before")
