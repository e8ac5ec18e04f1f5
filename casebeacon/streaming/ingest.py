"""Continuous ingestion: decode, split good from bad, write each batch exactly once.

Folder layout: ``owner`` names the one checkpoint that writes here, ``cases/batch_id=N`` and
``dead_letters/batch_id=N`` hold a batch each, ``compacted/upto=N`` the table after batch N.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casebeacon.functions import expressions as X
from casebeacon.operators.envelope import dead_letters, decode_messages, good_records
from casebeacon.operators.merge import last_arrival
from casebeacon.schemas import DEAD_LETTER, WIRE_CASE
from casebeacon.sources.files import exists, numbered_folders

ATTEMPTS = 3
ARRIVAL = ("batch_id", "offset", "partition")
STORED = "".join(f"{f.name} {'timestamp' if f.name == 'timestamp' else f.dataType.simpleString()}, " for f in WIRE_CASE) + "partition int, offset bigint, batch_id bigint"


def with_retries(action: Callable[[], None], attempts: int = ATTEMPTS, pause: Callable[[float], None] = time.sleep) -> None:
    """Repeats a failing write with growing pauses; the last failure stops the query.

    A stopped query keeps its old checkpoint, so the batch is read again after a restart. A plan
    that Spark rejects would fail every time and is not repeated.
    """
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except AnalysisException:
            raise
        except Exception:
            if attempt == attempts:
                raise
            pause(attempt)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The identity Spark gave a checkpoint; none before its first start."""
    path = f"{checkpoint}/metadata"
    return json.loads(spark.read.text(path).first()[0])["id"] if exists(spark, path) else None


def claim(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Binds the folder to one checkpoint. Another one would number its batches from 0 again."""
    owner, own = f"{path}/owner", checkpoint_id(spark, checkpoint)
    if exists(spark, owner):
        if spark.read.text(owner).first()[0] != own:
            raise ValueError(f"{path} belongs to another checkpoint than {checkpoint}")
    elif own is not None:
        spark.range(1).select(F.lit(own)).coalesce(1).write.mode("errorifexists").text(owner)


def batch_writer(
    path: str,
    checkpoint: str,
    attempts: int = ATTEMPTS,
    store: Callable[[Callable[[], None]], None] = lambda write: write(),
    pause: Callable[[float], None] = time.sleep,
) -> Callable[[DataFrame, int], None]:
    """Writes a batch's good rows and dead letters to folders named after the batch.

    Replaying a batch overwrites its own folders, so nothing is doubled. Place in the stream and
    batch number are kept, so the last arrival of a case is the same however batches are cut.
    ``store`` performs each write; it is where a sink can fail. Each write decodes the batch for itself:
    kept parsed, the messages of one split of a compact source are many times its size.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        claim(batch.sparkSession, path, checkpoint)
        decoded = decode_messages(batch)
        records = good_records(decoded, keep=("partition", "offset")).withColumn("timestamp", X.parse_timestamp("timestamp"))
        good = last_arrival(records, arrival=ARRIVAL[1:])
        bad = dead_letters(decoded)
        writes = (
            lambda: good.write.mode("overwrite").parquet(f"{path}/cases/batch_id={batch_id}"),
            lambda: bad.write.mode("overwrite")
            .option("ignoreNullFields", "false")
            .json(f"{path}/dead_letters/batch_id={batch_id}"),
        )
        for action in writes:
            with_retries(lambda action=action: store(action), attempts, pause)

    return write


def stream_ingest(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    """Starts ingestion of a message stream (partition, offset, key, value).

    ``options`` go to `batch_writer`. A folder that another checkpoint has written to is refused.
    """
    claim(messages.sparkSession, path, checkpoint)
    return (
        messages.writeStream.foreachBatch(batch_writer(path, checkpoint, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )


def last_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """Of each case the row that arrived last, with its place of arrival.

    Read are the newest compacted table and the batch folders after it, both picked by name.
    """
    done = max(numbered_folders(spark, f"{path}/compacted", "upto"), default=-1)
    newer = [f"{path}/cases/batch_id={n}" for n in numbered_folders(spark, f"{path}/cases", "batch_id") if n > done]
    changes = spark.createDataFrame([], STORED)
    if newer:
        changes = changes.unionByName(spark.read.schema(STORED).option("basePath", f"{path}/cases").parquet(*newer))
    if done >= 0:
        changes = changes.unionByName(spark.read.schema(STORED).parquet(f"{path}/compacted/upto={done}"))
    return last_arrival(changes, arrival=ARRIVAL)


def current_cases(spark: SparkSession, path: str) -> DataFrame:
    """The case table as it stands."""
    return last_arrivals(spark, path).drop(*ARRIVAL)


def compact_cases(spark: SparkSession, path: str) -> int:
    """Writes the table as it stands, for `current_cases` to start from; returns the last batch in it.

    The number is part of the folder's name, so it holds for a table without rows too. Folders
    count once they are complete; a repeated compaction replaces an incomplete one.
    """
    last = max(numbered_folders(spark, f"{path}/cases", "batch_id"), default=-1)
    if last >= 0 and last not in numbered_folders(spark, f"{path}/compacted", "upto"):
        last_arrivals(spark, path).write.mode("overwrite").parquet(f"{path}/compacted/upto={last}")
    return last


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(DEAD_LETTER)
        .option("basePath", f"{path}/dead_letters")
        .json(f"{path}/dead_letters")
        .select(*DEAD_LETTER.names)
    )
