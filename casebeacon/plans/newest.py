"""The newest rows of a table partitioned by date, found without reading the older days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casebeacon.operators import metrics
from casebeacon.sources.files import read_newest


def recent_stored_cases(spark: SparkSession, path: str, ts: str = "timestamp", n: int = 20, day: str = "event_date") -> DataFrame:
    """`recent_cases` of a table partitioned by the date of ``ts``: reads the newest days that hold ``n`` rows."""
    return metrics.recent_cases(read_newest(spark, path, day, lambda part: part.count() >= n), ts, n)


def last_stored_buckets(spark: SparkSession, path: str, ts: str = "timestamp", n: int = 30, day: str = "event_date") -> DataFrame:
    """`last_buckets` of such a table: reads the newest days that hold ``n`` different minutes."""
    newest = read_newest(spark, path, day, lambda part: metrics.cases_per_minute(part, ts).limit(n).count() >= n)
    return metrics.last_buckets(metrics.cases_per_minute(newest, ts), n)
