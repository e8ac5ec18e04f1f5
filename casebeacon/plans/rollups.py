"""The dashboard document from roll-ups that every batch of changes keeps up to date.

Layout: ``changes/batch_id=N`` holds what batch N adds to the numbers per region, gender and minute, ``summed/upto=N``
their sums up to a batch, ``newest/upto=N`` the newest cases after batch N. A change of a case takes its old
row out (counted -1) and puts the new one in (+1). A poll reads the last sums, the batches after them and one
list of at most ``KEEP`` cases; the case table itself is read again only if deletions have used that list up.
Batches come one after the other and a batch that is run again replaces its own folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebeacon.plans import snapshots
from casebeacon.sources.files import numbered_folders, remove

KEEP = 500  # newest cases at hand
RECENT = 20  # of them shown; with fewer left the list is drawn again


def _order(ts: str) -> Column:
    """Sorts the newest first as `metrics.recent_cases` does, cases without a time last."""
    age = -F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-(2**62)))
    return F.struct(age.alias("age"), F.col("case_id").alias("id"))


def signed_rollup(added: DataFrame, removed: DataFrame | None, ts: str = "timestamp") -> DataFrame:
    """The numbers of `snapshots.counted` per region, gender and minute: added cases count 1, removed ones -1."""
    changes = added.withColumn("_sign", F.lit(1).cast("bigint"))
    if removed is not None:
        changes = changes.unionByName(removed.withColumn("_sign", F.lit(-1).cast("bigint")))
    sums = [F.coalesce(F.sum(F.when(c, F.col("_sign"))), F.lit(0)).alias(name) for name, c in snapshots.counted().items()]
    return changes.groupBy("region_id", "gender", F.date_trunc("minute", F.col(ts).cast("timestamp")).alias("bucket")).agg(*sums)


def _newest(spark: SparkSession, path: str, before: int, like: DataFrame) -> DataFrame:
    known = [n for n in numbered_folders(spark, f"{path}/newest", "upto") if n < before]
    schema = like.withColumn("_floor", F.lit(None).cast("struct<age:bigint,id:string>")).schema
    return spark.read.schema(schema).parquet(f"{path}/newest/upto={known[-1]}") if known else spark.createDataFrame([], schema)


def add_batch(path: str, batch_id: int, added: DataFrame, removed: DataFrame | None, table: DataFrame, ts: str = "timestamp") -> None:
    """Takes in one batch: cases ``added`` and rows ``removed`` from the table (the old form of changed cases).

    ``table`` is the case table after the batch; it is read only when the list of newest cases has run short. The list
    is complete down to its floor: cases below it were left out once, so later ones below stay out too.
    """
    spark, order = added.sparkSession, _order(ts)
    signed_rollup(added, removed, ts).write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
    held = _newest(spark, path, batch_id, added)
    row = held.select("_floor").limit(1).collect()
    floor = row[0][0] if row else None
    rows = held.drop("_floor")
    if removed is not None:
        rows = rows.join(removed.select("case_id"), "case_id", "left_anti").select(*added.columns)
    lowest = F.lit(None) if floor is None else F.struct(F.lit(floor["age"]).alias("age"), F.lit(floor["id"]).alias("id"))
    if floor is not None:
        added = added.where(order <= lowest)
    rows = rows.unionByName(added)
    listed = rows.orderBy(order).limit(KEEP + 1).withColumn("_order", order).collect()
    if floor is not None and len(listed) < RECENT:
        listed, floor = table.select(*rows.columns).orderBy(order).limit(KEEP + 1).withColumn("_order", order).collect(), None
    if len(listed) > KEEP:
        listed = listed[:KEEP]
        floor = listed[-1]["_order"]
    kept = spark.createDataFrame([tuple(r)[:-1] for r in listed], rows.schema) if listed else rows.limit(0)
    last = F.lit(None).cast("struct<age:bigint,id:string>") if floor is None else F.struct(F.lit(floor["age"]).cast("bigint").alias("age"), F.lit(floor["id"]).alias("id"))
    kept.withColumn("_floor", last).coalesce(1).write.mode("overwrite").parquet(f"{path}/newest/upto={batch_id}")
    for old in numbered_folders(spark, f"{path}/newest", "upto"):
        if old < batch_id - 1:
            remove(spark, f"{path}/newest/upto={old}")


def numbers(spark: SparkSession, path: str) -> DataFrame:
    """The roll-up as it stands, from the last sums and the batches after them."""
    done = max(numbered_folders(spark, f"{path}/summed", "upto"), default=-1)
    folders = [f"{path}/changes/batch_id={n}" for n in numbered_folders(spark, f"{path}/changes", "batch_id") if n > done]
    if done >= 0:
        folders.append(f"{path}/summed/upto={done}")
    names = list(snapshots.counted())
    schema = "region_id string, gender string, bucket timestamp, " + ", ".join(f"{n} bigint" for n in names)
    rows = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return rows.groupBy("region_id", "gender", "bucket").agg(*(F.sum(n).alias(n) for n in names)).where("total > 0")


def sum_up(spark: SparkSession, path: str) -> int:
    """Writes the sums up to the last batch, for polls to start from, and removes the batches in them; returns its number.

    The sums and batches of the summing before stay until the next one, for polls under way.
    """
    last = max(numbered_folders(spark, f"{path}/changes", "batch_id"), default=-1)
    done = numbered_folders(spark, f"{path}/summed", "upto")
    if last >= 0 and last not in done:
        numbers(spark, path).write.mode("overwrite").parquet(f"{path}/summed/upto={last}")
        for old in done[:-1]:
            remove(spark, f"{path}/summed/upto={old}")
        for n in numbered_folders(spark, f"{path}/changes", "batch_id"):
            if done and n <= done[-1]:
                remove(spark, f"{path}/changes/batch_id={n}")
    return last


def dashboard(spark: SparkSession, path: str, like: DataFrame, ts: str = "timestamp", buckets: int = 30) -> DataFrame:
    """`snapshots.dashboard_snapshot` of the table as it stands; ``like`` gives the columns of a case."""
    rollup = numbers(spark, path)
    per_minute = rollup.where("bucket is not null").groupBy("bucket").agg(F.sum("total").alias("total"), F.sum("positive").alias("positive"))
    newest = _newest(spark, path, 2**62, like).drop("_floor")
    cube = rollup.groupBy("region_id", "gender").agg(*(F.sum(n).alias(n) for n in snapshots.counted()))
    return snapshots.dashboard_of(snapshots.breakdowns_of(cube), snapshots.recent_list(newest, ts, RECENT), snapshots.timeline_of(per_minute, buckets))
