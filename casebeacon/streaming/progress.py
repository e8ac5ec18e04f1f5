"""How far a query has come, from the progress Spark reports."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "query string, batch_id bigint, source string, positions string, end_offset string, latest_offset string, "
    "input_rows bigint, rows_per_second double, late_rows bigint"
)
POSITIONS = "positions"


def progress_rows(progresses: Iterable) -> list[tuple]:
    """One row per batch and source from progress records (objects or their JSON text)."""
    rows = []
    for progress in progresses:
        report = json.loads(progress) if isinstance(progress, str) else json.loads(progress.json)
        late = sum(s.get("numRowsDroppedByWatermark", 0) for s in report.get("stateOperators", []))
        for source in report["sources"]:
            rows.append(
                (
                    report["id"],
                    report["batchId"],
                    source["description"],
                    _text((report.get("observedMetrics") or {}).get(POSITIONS)),
                    _text(source.get("endOffset")),
                    _text(source.get("latestOffset")),
                    int(source["numInputRows"]),
                    float(source.get("processedRowsPerSecond") or 0.0),
                    int(late),
                )
            )
    return rows


def progress_frame(spark: SparkSession, progresses: Iterable) -> DataFrame:
    return spark.createDataFrame(progress_rows(progresses), PROGRESS)


def lag_report(progress: DataFrame) -> DataFrame:
    """Position, end and lag per topic partition after each batch.

    Kafka offsets read ``{"topic": {"0": 42}}``. Sources without partitions give no rows here;
    their input counts are in `progress_frame`.
    """
    offsets = "map<string, map<string, bigint>>"
    ends = progress.select("query", "batch_id", F.explode(F.from_json("end_offset", offsets)).alias("topic", "positions"), "latest_offset")
    latest = F.from_json("latest_offset", offsets)
    return (
        ends.select("query", "batch_id", "topic", F.explode("positions").alias("partition", "position"), latest.alias("latest"))
        .withColumn("end", F.coalesce(F.try_element_at(F.try_element_at("latest", F.col("topic")), F.col("partition")), F.col("position")))
        .select("query", "batch_id", "topic", F.col("partition").cast("int").alias("partition"), "position", "end", (F.col("end") - F.col("position")).alias("lag"))
    )


def observe_positions(messages: DataFrame, partitions: Iterable[int]) -> DataFrame:
    """The stream, reporting with every batch the highest offset it read of each partition.

    Spark adds this up while the batch runs and hands it out with the progress, for sources that
    report no offsets of their own. One metric a partition: a topic's partitions are few and known.
    """
    highest = [F.max(F.when(F.col("partition") == p, F.col("offset"))).alias(str(p)) for p in partitions]
    return messages.observe(POSITIONS, *highest)


def observed_lag(progress: DataFrame, ends: DataFrame, topic: str) -> DataFrame:
    """Position, end and lag per partition after each batch, from what `observe_positions` reported.

    ``ends`` has the last offset of each partition. A batch without rows of a partition leaves its
    position; before the first row it is -1. The running maximum sees a row per batch.
    """
    seen = progress.where("positions is not null").select("query", "batch_id", F.from_json("positions", "map<string, bigint>").alias("held"))
    listed = ends.agg(F.collect_list(F.struct("partition", "end")).alias("ends")).scalar()
    each = seen.select("query", "batch_id", "held", F.inline(listed))
    upto = Window.partitionBy("query", "partition").orderBy("batch_id")
    found = F.try_element_at("held", F.col("partition").cast("string"))
    position = F.coalesce(F.max(found).over(upto), F.lit(-1).cast("bigint"))
    return (
        each.withColumn("position", position)
        .select("query", "batch_id", F.lit(topic).alias("topic"), F.col("partition").cast("int").alias("partition"), "position", "end")
        .withColumn("lag", F.col("end") - F.col("position"))
    )


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The stored log of `ProgressLog`: every batch, not only the last ones that a query remembers."""
    return spark.read.schema(PROGRESS).json(path)


class ProgressLog(StreamingQueryListener):
    """Appends the progress of every query of a session to a folder, one JSON file per batch."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = path
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Returns when everything that the ended query reported has been written; events arrive a little later."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of {query.runId} was reported within {seconds} s")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress_frame(self._spark, [event.progress]).coalesce(1).write.mode("append").json(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()


def _text(offset) -> str | None:
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset)
