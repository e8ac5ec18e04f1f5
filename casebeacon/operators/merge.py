"""Merging tables: upserts, replacement by model, unions by name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Columns the target store fills in by itself.
GENERATED_COLUMNS = ("id", "trained_at")


def last_arrival(updates: DataFrame, key: str = "case_id", arrival: Sequence[str] = ("arrival",)) -> DataFrame:
    """One row per key, the one that arrived last, whatever time it reports.

    The other columns only break ties. Spark applies the rank-1 filter before the shuffle as well,
    so a key with very many updates sends at most one row per map task.
    """
    ties = sorted(set(updates.columns) - {key, *arrival})
    order = [F.col(c).desc_nulls_last() for c in (*arrival, *ties)]
    ranked = updates.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def upsert_cases(current: DataFrame, updates: DataFrame, key: str = "case_id", arrival: Sequence[str] = ("arrival",)) -> DataFrame:
    """``current`` with every updated key replaced; of several updates of a key the last to arrive wins.

    ``arrival`` names the columns of the updates that hold their order, the weightiest first. Only the
    keys of the updates meet the current table, so a small batch is broadcast by its
    measured size and the current table is read without a shuffle.
    """
    newest = last_arrival(updates, key, arrival).drop(*(c for c in arrival if c not in current.columns))
    kept = current.join(newest.select(key), key, "left_anti")
    return kept.unionByName(newest)


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_generated_columns(df: DataFrame) -> DataFrame:
    return df.drop(*GENERATED_COLUMNS)


def replace_model_rows(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of other models plus the new rows of this one."""
    others = drop_generated_columns(existing).join(
        rows.select("model_name").distinct(), "model_name", "left_anti"
    )
    return union_by_name(others, drop_generated_columns(rows))
