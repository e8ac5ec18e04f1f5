"""Cleaning of raw case reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebeacon.functions import expressions as X
from casebeacon.schemas import ESSENTIAL_FIELDS


def drop_incomplete(cases: DataFrame, fields: Sequence[str] = ESSENTIAL_FIELDS) -> DataFrame:
    return cases.dropna(subset=list(fields))


def with_parsed_timestamp(cases: DataFrame, ts: str = "timestamp") -> DataFrame:
    return cases.withColumn(ts, X.parse_timestamp(ts))


def with_normalized_result(cases: DataFrame, result: str = "rapid_test_result") -> DataFrame:
    return cases.withColumn(result, X.normalize_result(result))


def with_symptom_count(cases: DataFrame, symptoms: str = "symptoms") -> DataFrame:
    """Adds ``symptom_count``; JSON text is first turned into the array it stands for."""
    if isinstance(cases.schema[symptoms].dataType, T.StringType):
        cases = cases.withColumn(symptoms, X.json_string_list(symptoms))
    return cases.withColumn("symptom_count", F.array_size(symptoms))


def newest_first(columns: Sequence[str], ts: str) -> list:
    """Total order that puts the newest row first; the other columns only break ties."""
    return [F.col(c).desc_nulls_last() for c in [ts, *sorted(set(columns) - {ts})]]


def dedupe_cases(cases: DataFrame, key: str = "case_id", ts: str = "timestamp") -> DataFrame:
    """One row per key, the newest.

    Spark turns the rank-1 filter into a per-key limit before the shuffle, so a key with very
    many copies sends at most one row per map task.
    """
    order = newest_first([c for c in cases.columns if c != key], ts)
    ranked = cases.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def clean_cases(cases: DataFrame, ts: str = "timestamp", symptoms: str = "symptoms") -> DataFrame:
    """Complete rows only, parsed and normalised, one per case.

    Incomplete copies go first so that they cannot displace a good copy of the same case.
    """
    return (
        cases.transform(drop_incomplete)
        .transform(with_parsed_timestamp, ts)
        .transform(with_normalized_result)
        .transform(dedupe_cases, "case_id", ts)
        .transform(with_symptom_count, symptoms)
    )


def row_audit(raw: DataFrame, key: str = "case_id", ts: str = "timestamp") -> DataFrame:
    """Rows before and after each cleaning step, plus what stays in with open questions.

    ``unparsed_time`` counts complete rows whose time is missing or unreadable: they stay in the table
    and are in no time bucket, window or alert.
    """
    complete = F.lit(True)
    for field in ESSENTIAL_FIELDS:
        complete = complete & F.col(field).isNotNull()
    known = X.normalize_result().isin(X.POSITIVE, X.NEGATIVE)
    # First one row per key: a plain aggregate, so hot keys are combined map-side.
    per_key = (
        raw.select(
            key,
            complete.alias("complete"),
            (complete & ~known).alias("unknown"),
            (complete & X.parse_timestamp(ts).isNull()).alias("unparsed"),
        )
        .groupBy(key)
        .agg(
            F.count("*").alias("raw"),
            F.count_if("complete").alias("complete"),
            F.count_if("unknown").alias("unknown"),
            F.count_if("unparsed").alias("unparsed"),
        )
    )
    totals = per_key.agg(
        *(
            F.struct(F.lit(step).alias("step"), F.coalesce(amount, F.lit(0)).cast("bigint").alias("rows")).alias(step)
            for step, amount in (
                ("raw", F.sum("raw")),
                ("complete", F.sum("complete")),
                ("deduplicated", F.count_if(F.col("complete") > 0)),
                ("unknown_result", F.sum("unknown")),
                ("unparsed_time", F.sum("unparsed")),
            )
        )
    )
    return totals.select(F.inline(F.array(*totals.columns)))
