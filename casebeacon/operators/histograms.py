"""Histograms over fixed and data-dependent bins. Empty bins stay in the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebeacon.functions import expressions as X

# Age bins, both ends included; the last one is shown as "60+".
AGE_BINS = ((0, 4), (5, 14), (15, 24), (25, 34), (35, 44), (45, 59), (60, 150))

# Rainfall bins in mm, low end included, high end not; the last one is "20+ mm".
RAIN_BINS = ((0, 2), (2, 5), (5, 10), (10, 20), (20, 10000))


def age_labels(bins: Sequence[tuple[int, int]] = AGE_BINS) -> list[str]:
    return [f"{low}+" if high == bins[-1][1] else f"{low}-{high}" for low, high in bins]


def rain_labels(bins: Sequence[tuple[int, int]] = RAIN_BINS) -> list[str]:
    return [f"{low}+ mm" if high == bins[-1][1] else f"{low}-{high} mm" for low, high in bins]


def bin_counts(labels: Sequence[str], members: Sequence[Column]) -> Column:
    """Array of (bin, label, total, positive), one conditional count pair per bin.

    The bins are few and fixed, so the whole histogram is one aggregate over one scan.
    """
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("bin"),
                F.lit(label).alias("label"),
                F.count_if(member).alias("total"),
                F.count_if(member & X.is_positive()).alias("positive"),
            )
            for i, (label, member) in enumerate(zip(labels, members))
        )
    )


def age_members(bins: Sequence[tuple[int, int]] = AGE_BINS, age: str = "patient_age") -> list[Column]:
    return [F.col(age).between(low, high) for low, high in bins]


def rain_members(bins: Sequence[tuple[int, int]] = RAIN_BINS, rain: str = "rainfall_mm") -> list[Column]:
    return [(F.col(rain) >= low) & (F.col(rain) < high) for low, high in bins]


def age_histogram(cases: DataFrame, bins: Sequence[tuple[int, int]] = AGE_BINS) -> DataFrame:
    counts = bin_counts(age_labels(bins), age_members(bins))
    return cases.agg(counts.alias("bins")).select(F.inline("bins"))


def rain_positivity(cases: DataFrame, bins: Sequence[tuple[int, int]] = RAIN_BINS) -> DataFrame:
    counts = bin_counts(rain_labels(bins), rain_members(bins))
    return (
        cases.agg(counts.alias("bins"))
        .select(F.inline("bins"))
        .withColumn("positivity", X.safe_rate("positive", "total", 1))
    )


def window_histogram(windows: DataFrame, threshold: DataFrame, value: str = "positive_cases") -> DataFrame:
    """Equal-width bins from 0 over the values seen, about ten of them.

    ``threshold`` is a one-row, one-column DataFrame; bins that start above it are marked.
    """
    width = F.greatest(F.lit(1), F.ceil((F.max(value) + 1) / 10)).cast("bigint")
    limits = windows.agg(width.alias("width"), F.max(value).cast("bigint").alias("top"))
    # One row holds both limits, so the scalar subquery is shared by every use.
    low = F.floor(F.col(value) / F.col("_limits.width")) * F.col("_limits.width")
    counts = (
        windows.where(F.col(value).isNotNull())
        .withColumn("_limits", limits.select(F.struct("width", "top")).scalar())
        .groupBy(low.cast("bigint").alias("low"))
        .agg(F.count("*").alias("n"))
    )
    bins = limits.where("top IS NOT NULL").select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), "top", "width")).alias("low"), "width"
    )
    label = F.when(F.col("width") == 1, F.col("low").cast("string")).otherwise(
        F.concat_ws("-", "low", F.col("low") + F.col("width") - 1)
    )
    return (
        bins.join(counts, "low", "left")
        .select(
            "low",
            label.alias("label"),
            F.coalesce("n", F.lit(0)).alias("windows"),
            F.coalesce(F.col("low") > threshold.scalar(), F.lit(False)).alias("above_threshold"),
        )
        .orderBy("low")
    )
