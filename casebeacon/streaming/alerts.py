"""Outbreak alerts on a stream, equal to the batch operator up to the final watermark.

Spark's streaming aggregation releases moments (region and time) once the watermark has passed them. Each
batch of released moments then goes through the batch operator, sliced by time and spread over all
tasks, however few its regions are. Between batches a small table is carried: the positives of the last
window, the last alert of each region, and the time up to which moments have been released.

State layout: ``owner`` names the checkpoint that writes here, ``upto=N`` is the table after batch N. A batch
that is run again reads the table before it and writes the same alerts to the same place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casebeacon.functions import expressions as X
from casebeacon.operators.alerts import COOLDOWN_SECONDS, THRESHOLD, WINDOW_SECONDS, alert_cooldown, format_alert, rolling_moments
from casebeacon.sources.files import exists, numbered_folders, remove
from casebeacon.streaming.ingest import claim

ALERT = "region_id string, ts timestamp, positives_in_window bigint"
CARRIED = "kind string, region_id string, at bigint, n bigint"

_MICROS = 1_000_000

Sink = Callable[[DataFrame, int], None]


def finished_moments(cases: DataFrame, delay: str, ts: str = "timestamp") -> DataFrame:
    """Cases and positives per region and moment, released once the watermark has passed it.

    This aggregation combines map-side and is spread over (region, moment). What is released is
    complete, later than anything released before, and at most one row per region and microsecond.
    """
    return (
        cases.withWatermark(ts, delay)
        .groupBy("region_id", ts)
        .agg(F.count("*").alias("cases"), F.sum(X.positive_flag()).cast("bigint").alias("positives"))
        .select("region_id", F.unix_micros(ts).alias("at"), "cases", "positives")
    )


def next_alerts(
    moments: DataFrame, carried: DataFrame, window_seconds: int, threshold: int, cooldown_seconds: int
) -> tuple[DataFrame, DataFrame]:
    """Alerts of newly released moments and the table to carry on, both as plans.

    The last alert of a region heads its candidates: being the earliest it is kept and blocks those too
    soon after it, and is left out of the result. Positives older than one window before the newest
    moment can't count again and are dropped.
    """
    of = lambda kind: carried.where(F.col("kind") == kind)
    upto = of("released").agg(F.coalesce(F.max("at"), F.lit(-(2**63))).alias("at"))
    is_new = F.col("at") > upto.scalar()
    before = of("positives").select("region_id", "at", F.col("n").alias("cases"), F.col("n").alias("positives"))
    known = moments.where("region_id IS NOT NULL").select("region_id", "at", "cases", "positives").unionByName(before)
    counts = rolling_moments(known, window_seconds=window_seconds)
    candidates = counts.where((F.col("positives_in_window") >= threshold) & is_new).select("region_id", "at", "positives_in_window")
    last = of("alert").select("region_id", "at", F.col("n").alias("positives_in_window"))
    kept = alert_cooldown(candidates.unionByName(last), cooldown_seconds=cooldown_seconds).where(is_new)

    newest = moments.agg(F.max("at")).scalar()
    tail = known.where((F.col("positives") > 0) & (F.col("at") >= newest - window_seconds * _MICROS))
    latest = kept.unionByName(last).groupBy("region_id").agg(F.max(F.struct("at", "positives_in_window")).alias("a"))
    after = (
        tail.select(F.lit("positives").alias("kind"), "region_id", "at", F.col("positives").alias("n"))
        .union(latest.select(F.lit("alert"), "region_id", "a.at", "a.positives_in_window"))
        .union(moments.agg(F.max("at").alias("at")).select(F.lit("released"), F.lit(None).cast("string"), "at", F.lit(None).cast("bigint")))
    )
    return kept, after


def carried_state(spark: SparkSession, path: str, before: int) -> DataFrame:
    """The newest complete table of the batches before the given one; empty at the start."""
    known = [n for n in numbered_folders(spark, path, "upto") if n < before]
    return spark.read.schema(CARRIED).parquet(f"{path}/upto={known[-1]}") if known else spark.createDataFrame([], CARRIED)


def stream_outbreak_alerts(
    cases: DataFrame,
    sink: Sink,
    state: str,
    checkpoint: str,
    *,
    delay: str,
    window_seconds: int = WINDOW_SECONDS,
    threshold: int = THRESHOLD,
    cooldown_seconds: int = COOLDOWN_SECONDS,
    ts: str = "timestamp",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts the alerts of a case stream; ``sink`` gets those of each batch and its number.

    ``ts`` must be a timestamp; rows later than ``delay`` are lost to the watermark and counted in the query's
    progress. ``state`` is a folder that every executor can reach; one that another checkpoint has
    written to is refused. No task holds more than a batch of rows of a sorted stream.
    """
    claim(cases.sparkSession, state, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        claim(spark, state, checkpoint)
        moments = batch.persist()
        try:
            if moments.isEmpty():
                return
            carried = carried_state(spark, state, batch_id)
            kept, after = next_alerts(moments, carried, window_seconds, threshold, cooldown_seconds)
            kept = kept.persist()
            try:
                sink(kept.select("region_id", F.timestamp_micros("at").alias("ts"), "positives_in_window"), batch_id)
                after.write.mode("overwrite").parquet(f"{state}/upto={batch_id}")
            finally:
                kept.unpersist()
        finally:
            moments.unpersist()
        for old in numbered_folders(spark, state, "upto"):
            if old < batch_id - 1:  # the one before stays for a batch that is run again
                remove(spark, f"{state}/upto={old}")

    return (
        finished_moments(cases, delay, ts)
        .writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )


def parquet_sink(path: str) -> Sink:
    """Alerts of a batch in a folder of its own, replaced if the batch is run again."""
    return lambda alerts, batch_id: alerts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def alert_log_sink(path: str, window_seconds: int = WINDOW_SECONDS, instance: str | None = None) -> Sink:
    """One text line per alert, a folder per batch."""
    return lambda alerts, batch_id: (
        format_alert(alerts, window_seconds, instance).select("line").write.mode("overwrite").text(f"{path}/batch_id={batch_id}")
    )


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All alerts of `parquet_sink`; none if no batch has released a moment yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], ALERT)
    return spark.read.schema(ALERT).option("basePath", path).parquet(path).drop("batch_id")
