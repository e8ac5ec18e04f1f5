"""Kafka topics of case reports. The connector comes with the cluster's Spark packages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casebeacon.operators.envelope import wrap_envelope

MAX_OFFSETS_PER_TRIGGER = 1_000_000


def read_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets: int = MAX_OFFSETS_PER_TRIGGER
) -> DataFrame:
    """A topic from its beginning; a checkpointed query goes on from where it stopped."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .transform(as_messages)
    )


def as_messages(records: DataFrame) -> DataFrame:
    """Place, key and text of each Kafka record; bytes that are no valid text are replaced."""
    text = lambda c: F.make_valid_utf8(F.col(c).cast("string")).alias(c)
    return records.select("partition", "offset", text("key"), text("value"))


def write_topic(cases: DataFrame, servers: str, topic: str, name: str = "case_report") -> None:
    """Sends each case under its region's key, so that a region stays in order."""
    (
        wrap_envelope(cases, name)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def stream_to_topic(
    cases: DataFrame, servers: str, topic: str, checkpoint: str, name: str = "case_report"
) -> StreamingQuery:
    return (
        wrap_envelope(cases, name)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
