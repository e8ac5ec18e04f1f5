"""JDBC tables. Connection settings come from the caller or the environment only."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebeacon.operators.merge import replace_model_rows
from casebeacon.schemas import CASE_PREDICTIONS, FEATURE_IMPORTANCE, OUTBREAK_PREDICTIONS
from casebeacon.session import work_dir


@dataclass(frozen=True)
class JdbcTarget:
    """Where the tables live."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None

    @classmethod
    def from_environment(cls) -> JdbcTarget:
        env = os.environ
        return cls(
            env["CASEBEACON_JDBC_URL"],
            env.get("CASEBEACON_JDBC_USER"),
            env.get("CASEBEACON_JDBC_PASSWORD"),
            env.get("CASEBEACON_JDBC_DRIVER"),
        )

    def properties(self) -> dict[str, str]:
        given = {"user": self.user, "password": self.password, "driver": self.driver}
        return {k: v for k, v in given.items() if v is not None}


@dataclass(frozen=True)
class Ranges:
    """Splits a read into ``partitions`` parallel queries over a numeric or time column."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def read_table(spark: SparkSession, target: JdbcTarget, table: str, ranges: Ranges | None = None) -> DataFrame:
    if ranges is None:
        return spark.read.jdbc(target.url, table, properties=target.properties())
    return spark.read.jdbc(
        target.url,
        table,
        column=ranges.column,
        lowerBound=ranges.lower,
        upperBound=ranges.upper,
        numPartitions=ranges.partitions,
        properties=target.properties(),
    )


def overwrite_table(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Replaces the rows and keeps the table's declared columns, keys and indexes.

    Truncation and insertion are two transactions: readers may see an empty table in between, and a failure
    there leaves it empty until the write is repeated, so keep the source until it has succeeded.
    """
    df.write.option("truncate", True).mode("overwrite").jdbc(
        target.url, table, properties=target.properties()
    )


def append_table(df: DataFrame, target: JdbcTarget, table: str) -> None:
    df.write.mode("append").jdbc(target.url, table, properties=target.properties())


def conform(df: DataFrame, schema: T.StructType, stamp: str) -> DataFrame:
    """The columns the table declares, with its types, and the time of writing in ``stamp``."""
    fields = [
        F.current_timestamp().alias(f.name) if f.name == stamp else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return df.select(*fields)


def sync_predictions(spark: SparkSession, case_path: str, outbreak_path: str, target: JdbcTarget) -> None:
    """Copies both prediction tables from Parquet to their JDBC tables."""
    for path, table, schema in (
        (case_path, "case_predictions", CASE_PREDICTIONS),
        (outbreak_path, "outbreak_predictions", OUTBREAK_PREDICTIONS),
    ):
        overwrite_table(conform(spark.read.parquet(path), schema, "synced_at"), target, table)


def publish_model_rows(
    spark: SparkSession, rows: DataFrame, target: JdbcTarget, table: str = "feature_importance"
) -> None:
    """Replaces one model's rows and keeps those of the others.

    The new content is first written to the shared folder: overwriting a table while the same
    plan still reads it would lose the rows that were to be kept.
    """
    staging = work_dir(spark, "model-rows")
    combined = replace_model_rows(read_table(spark, target, table), rows)
    conform(combined, FEATURE_IMPORTANCE, "trained_at").write.parquet(staging)
    overwrite_table(spark.read.parquet(staging), target, table)
