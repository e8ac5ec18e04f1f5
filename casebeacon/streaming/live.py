"""Live aggregates for the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casebeacon.operators.metrics import region_totals
from casebeacon.operators.windows import region_window_features
from casebeacon.sources.files import numbered_folders, remove


END = "9999-01-01"  # after any reported time


def stream_region_windows(
    cases: DataFrame, *, delay: str, window: str = "1 minute", ts: str = "timestamp"
) -> DataFrame:
    """Window features of a stream; a window appears once the watermark has passed its end."""
    return region_window_features(cases.withWatermark(ts, delay), window, ts)


def stream_live_totals(
    cases: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps totals per region up to date; each batch leaves one complete snapshot.

    The snapshot before it stays for readers that have just picked it, older ones are removed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        for old in numbered_folders(batch.sparkSession, path, "batch_id"):
            if old < batch_id - 1:
                remove(batch.sparkSession, f"{path}/batch_id={old}")

    return (
        region_totals(cases)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )


def latest_totals(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot, found by its folder's name."""
    return spark.read.parquet(f"{path}/batch_id={numbered_folders(spark, path, 'batch_id')[-1]}")


def with_end(cases: DataFrame, folder: str, ts: str = "timestamp") -> DataFrame:
    """A bounded stream with a last row that lies after everything else.

    It moves the watermark past all windows and waits, so nothing of the input is withheld when the
    run ends. The row itself is never released. The stream's checkpoint is finished by it: later rows would be late.
    """
    spark = cases.sparkSession
    row = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != ts else F.lit(END).cast(f.dataType).alias(ts) for f in cases.schema]
    spark.range(1).select(*row).coalesce(1).write.mode("overwrite").parquet(folder)
    return cases.unionByName(spark.readStream.schema(cases.schema).parquet(folder))


def append_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )
