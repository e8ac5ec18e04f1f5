"""Totals, rates and breakdowns over the clean case table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebeacon.functions import expressions as X

CLIMATE_FEATURES = ("rainfall_mm", "humidity", "ambient_temperature")


def total_cases(cases: DataFrame) -> DataFrame:
    return cases.agg(F.count("*").alias("total_cases"))


def total_positive(cases: DataFrame) -> DataFrame:
    """Totals in one pass. Whatever is not positive counts as negative, unknown results too."""
    return cases.agg(
        F.count("*").alias("total_cases"),
        F.count_if(X.is_positive()).alias("total_positive"),
    ).withColumn("total_negative", F.col("total_cases") - F.col("total_positive"))


def positive_only(cases: DataFrame) -> DataFrame:
    return cases.where(F.col("rapid_test_result") == X.POSITIVE)


def region_totals(cases: DataFrame) -> DataFrame:
    return cases.groupBy("region_id").agg(
        F.count("*").alias("total_cases"),
        F.count_if(X.is_positive()).alias("positive_cases"),
    )


def region_summary(cases: DataFrame) -> DataFrame:
    """Cases and positives per region, the busiest region first."""
    return region_totals(cases).orderBy(F.col("total_cases").desc(), "region_id")


def region_count(cases: DataFrame) -> DataFrame:
    """Number of regions, counted over groups; cases without a region form one group."""
    return cases.groupBy("region_id").agg(F.lit(1).alias("one")).agg(F.count("*").alias("region_count"))


def positivity_by_region(cases: DataFrame, decimals: int = 2) -> DataFrame:
    """Positivity rate per region, the highest first."""
    rate = F.round(F.col("positive_cases") / F.col("total_cases") * 100, decimals)
    return (
        region_totals(cases)
        .withColumn("positivity_rate_pct", rate)
        .orderBy(F.col("positivity_rate_pct").desc(), "region_id")
    )


def region_rates(cases: DataFrame) -> DataFrame:
    """The rate at chart precision (one decimal) and at table precision (whole percent)."""
    return (
        region_totals(cases)
        .withColumn("positivity", X.safe_rate("positive_cases", "total_cases", 1))
        .withColumn("rate_whole", X.safe_rate("positive_cases", "total_cases", 0))
        .orderBy(F.col("total_cases").desc(), "region_id")
    )


def climate_correlation(cases: DataFrame, features: Sequence[str] = CLIMATE_FEATURES) -> DataFrame:
    """Correlation of each climate reading with a positive result, all in one pass."""
    flag = X.positive_flag().cast("double")
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("feature"),
                X.pearson(F.col(name).cast("double"), flag).alias("correlation_with_positivity"),
            )
            for name in features
        )
    )
    return cases.agg(rows.alias("rows")).select(F.inline("rows"))


def demographics(cases: DataFrame) -> DataFrame:
    """Positive cases by age group and gender."""
    return (
        positive_only(cases)
        .groupBy(X.age_group().alias("age_group"), "gender")
        .agg(F.count("*").alias("positive_case_count"))
        .orderBy("age_group", "gender")
    )


def avg_symptoms_by_result(cases: DataFrame) -> DataFrame:
    return cases.groupBy("rapid_test_result").agg(
        F.round(F.avg("symptom_count"), 2).alias("avg_symptom_count")
    )


def gender_counts(cases: DataFrame) -> DataFrame:
    return (
        cases.groupBy("gender")
        .agg(F.count("*").alias("cases"))
        .withColumn("gender_label", X.gender_display())
        .orderBy(F.col("cases").desc(), "gender")
    )


def cases_per_minute(cases: DataFrame, ts: str = "timestamp", length: str = "1 minute") -> DataFrame:
    """Cases and positives per time bucket; cases without a time are left out."""
    bucketed = cases.where(F.col(ts).isNotNull()).select(
        F.window(ts, length).alias("window"), X.is_positive().alias("is_positive")
    )
    return bucketed.groupBy(F.col("window.start").alias("bucket")).agg(
        F.count("*").alias("total"), F.count_if("is_positive").alias("positive")
    )


def last_buckets(buckets: DataFrame, n: int = 30) -> DataFrame:
    """The newest buckets, oldest of them first, with a clock label beside the full time."""
    return (
        buckets.orderBy(F.col("bucket").desc())
        .limit(n)
        .withColumn("label", F.date_format("bucket", "HH:mm"))
        .orderBy("bucket")
    )


def recent_cases(cases: DataFrame, ts: str = "timestamp", n: int = 20) -> DataFrame:
    return cases.orderBy(F.col(ts).desc_nulls_last(), "case_id").limit(n)


def view_columns(ts: str = "timestamp", id_length: int | None = None) -> list[Column]:
    """The display columns of a case; pages may cut long ids to ``id_length`` characters."""
    case_id = F.col("case_id") if id_length is None else F.substring("case_id", 1, id_length)
    return [
        case_id.alias("case_id"),
        F.col("region_id"),
        F.col("district"),
        F.col("patient_age"),
        X.gender_display().alias("gender"),
        F.col("rapid_test_result"),
        F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias("timestamp"),
    ]


def recent_case_view(cases: DataFrame, ts: str = "timestamp", id_length: int | None = None) -> DataFrame:
    return cases.select(*view_columns(ts, id_length))


def label_distribution(df: DataFrame, label: str = "is_outbreak") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count"))
