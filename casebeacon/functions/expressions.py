"""Column expressions shared by the operators. All of them are Spark built-ins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE = "positive"
NEGATIVE = "negative"

# Spellings the cleaning step accepts. Other spellings stay as they are.
POSITIVE_SPELLINGS = ("positive", "Positive", "POSITIVE")
NEGATIVE_SPELLINGS = ("negative", "Negative", "NEGATIVE")

# Display names of the gender codes.
GENDER_NAMES = {"M": "Male", "F": "Female"}

# Upper age limits (exclusive) of the demographic groups; the rest is "65+".
AGE_GROUPS = ((5, "0-4"), (15, "5-14"), (45, "15-44"), (65, "45-64"))
OLDEST_GROUP = "65+"


def is_positive(result: str = "rapid_test_result") -> Column:
    """True only for a positive test; null and unknown results are false."""
    return F.col(result).eqNullSafe(POSITIVE)


def positive_flag(result: str = "rapid_test_result") -> Column:
    return F.when(F.col(result) == POSITIVE, 1).otherwise(0)


def case_label(result: str = "rapid_test_result") -> Column:
    return F.when(F.col(result) == POSITIVE, 1.0).otherwise(0.0)


def normalize_result(result: str = "rapid_test_result") -> Column:
    value = F.col(result)
    return (
        F.when(value.isin(*POSITIVE_SPELLINGS), POSITIVE)
        .when(value.isin(*NEGATIVE_SPELLINGS), NEGATIVE)
        .otherwise(value)
    )


def parse_timestamp(text: str = "timestamp") -> Column:
    """ISO text to a timestamp; unreadable text becomes null instead of failing the job."""
    return F.try_to_timestamp(F.col(text))


def json_string_list(text: str = "symptoms") -> Column:
    return F.from_json(F.col(text), "array<string>")


def safe_rate(part: Column | str, whole: Column | str, decimals: int) -> Column:
    """``part / whole`` in percent, 0 where there is nothing to divide by."""
    return F.coalesce(F.round(F.try_divide(_col(part), _col(whole)) * 100, decimals), F.lit(0.0))


def age_group(
    age: str = "patient_age",
    groups: Sequence[tuple[int, str]] = AGE_GROUPS,
    oldest: str = OLDEST_GROUP,
) -> Column:
    """Demographic group; a missing age lands in the oldest group, as no limit matches it."""
    value = F.col(age)
    (limit, label), *rest = groups
    group = F.when(value < limit, label)
    for limit, label in rest:
        group = group.when(value < limit, label)
    return group.otherwise(oldest)


def gender_display(gender: str = "gender") -> Column:
    shown = F.col(gender)
    for code, name in GENDER_NAMES.items():
        shown = F.when(F.col(gender) == code, name).otherwise(shown)
    return shown


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation that skips incomplete pairs and is null for a constant column.

    The masks keep each deviation on the rows the covariance uses.
    """
    deviation_x = F.stddev_pop(F.when(y.isNotNull(), x))
    deviation_y = F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), deviation_x * deviation_y)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
