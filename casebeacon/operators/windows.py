"""Region-by-time-window features and the reads of the window prediction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebeacon.functions import expressions as X

SKETCH_SIZE = 800  # rank error below one hundredth


def region_window_features(
    cases: DataFrame, window: str = "1 minute", ts: str = "timestamp"
) -> DataFrame:
    """Counts and mean readings per region and tumbling window; works on streams too."""
    return (
        cases.groupBy("region_id", F.window(ts, window).alias("window"))
        .agg(
            F.count("*").alias("total_cases"),
            F.sum(X.positive_flag()).alias("positive_cases"),
            F.avg("rainfall_mm").alias("avg_rainfall"),
            F.avg("humidity").alias("avg_humidity"),
            F.avg("ambient_temperature").alias("avg_temperature"),
            F.avg("symptom_count").alias("avg_symptoms"),
        )
        .transform(window_start_as_date)
    )


def window_start_as_date(windows: DataFrame) -> DataFrame:
    return windows.withColumn("date", F.col("window.start")).drop("window")


def outbreak_threshold(windows: DataFrame, q: float = 0.75, accuracy: int = 100) -> DataFrame:
    """Approximate quantile of the positives per window, as one row; null without windows."""
    return windows.agg(F.percentile_approx("positive_cases", q, accuracy).alias("threshold"))


def threshold_sketches(windows: DataFrame, day: str = "date", value: str = "positive_cases", k: int = SKETCH_SIZE) -> DataFrame:
    """One mergeable quantile sketch of a whole-number column per day, for storing: (day, sketch).

    A sketch has a few KB whatever the day holds. Days without a value have none.
    """
    known = windows.where(F.col(value).isNotNull())
    return known.groupBy(F.to_date(day).alias("day")).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias("sketch"))


def threshold_of_days(sketches: DataFrame, q: float = 0.75, by: Sequence[Column] = ()) -> DataFrame:
    """(n, threshold) of all windows behind the sketches, per ``by``; their rank is off by one hundredth at most.

    Sketches are merged map-side, so any range of days costs a read of its sketches and not of its windows.
    """
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.count("sketch").alias("days"))
    size, threshold = F.kll_sketch_get_n_bigint("sketch"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(q))
    some = F.col("days") > 0  # a merge of nothing has no quantile
    return merged.where(some).select(*merged.columns[:-2], size.alias("n"), F.when(some, threshold).alias("threshold"))


def threshold_lower_quantile(windows: DataFrame, q: float = 0.75, value: str = "positive_cases") -> DataFrame:
    """Exact lower quantile: the element at ``floor(q * (n - 1))`` of the sorted values; null without values.

    Radix selection: values are counted first, then the element is narrowed down by 16 bits a round, the
    highest first and with its sign. A round counts the digits among the values that share the digits found
    so far and picks one, so it looks at no more than 65,536 counts whatever the values are. The value column
    must be a whole number.
    """
    if not isinstance(windows.schema[value].dataType, T.IntegralType):
        raise ValueError(f"{value} is not a whole-number column")
    counts = windows.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("bigint").alias("v")).agg(
        F.count("*").alias("n")
    )
    first = counts.select("n", F.shiftright("v", 48).alias("digit"), F.lit(None).cast("bigint").alias("wanted"))
    found = _picked(first, F.floor(F.lit(q) * (F.col("total") - 1)) + 1)
    for shift in (32, 16, 0):
        # ``found`` is one row, so broadcasting it is safe.
        shared = counts.join(F.broadcast(found), F.shiftright("v", shift + 16) == F.col("prefix"))
        found = _picked(shared.select("n", F.shiftright("v", shift).alias("digit"), "wanted"), F.col("wanted"))
    return found.select(F.col("prefix").alias("threshold"))


def _picked(rows: DataFrame, wanted: Column) -> DataFrame:
    """(prefix, wanted): the digit that holds the element of a rank, and the element's rank within it; one row."""
    cells = rows.groupBy("digit").agg(F.sum("n").alias("n"), F.max("wanted").alias("wanted"))
    cells = cells.agg(
        F.array_sort(F.collect_list(F.struct("digit", "n"))).alias("cells"), F.sum("n").alias("total"), F.max("wanted").alias("wanted")
    )
    start = F.struct(F.lit(None).cast("bigint").alias("prefix"), wanted.cast("bigint").alias("wanted"))

    def step(so_far: Column, cell: Column) -> Column:
        here = F.struct(cell["digit"].alias("prefix"), so_far["wanted"].alias("wanted"))
        on = F.struct(F.lit(None).cast("bigint").alias("prefix"), (so_far["wanted"] - cell["n"]).alias("wanted"))
        return F.when(so_far["prefix"].isNotNull(), so_far).when(so_far["wanted"] <= cell["n"], here).otherwise(on)

    return cells.select(F.aggregate("cells", start, step).alias("p")).select("p.*")


def with_threshold(df: DataFrame, threshold: DataFrame) -> DataFrame:
    """Attaches a one-row threshold to every row, as a scalar subquery."""
    return df.withColumn("threshold", threshold.scalar())


def outbreak_label(windows: DataFrame, threshold: DataFrame) -> DataFrame:
    """1.0 where the positives lie strictly above the threshold."""
    label = F.when(F.col("positive_cases") > threshold.scalar(), 1.0).otherwise(0.0)
    return windows.withColumn("is_outbreak", label)


def latest_window_per_region(windows: DataFrame) -> DataFrame:
    """The newest window of each region; larger counts decide between equal dates.

    A maximum over structs combines map-side, so a region with very many windows is no burden.
    """
    rest = [c for c in windows.columns if c not in ("region_id", "date", "total_cases", "positive_cases")]
    order = ["date", "total_cases", "positive_cases", *rest]
    return (
        windows.groupBy("region_id")
        .agg(F.max(F.struct(*order)).alias("w"))
        .select("region_id", "w.*")
        .orderBy("region_id")
    )


def at_risk_regions(windows: DataFrame) -> DataFrame:
    return latest_window_per_region(windows).where("prediction = 1.0")


def flag_points(windows: DataFrame) -> DataFrame:
    return windows.withColumn("flagged", F.col("prediction").eqNullSafe(1.0))


def predicted_status(windows: DataFrame) -> DataFrame:
    """Outbreak windows and all the rest; a missing prediction counts as stable."""
    return windows.agg(
        F.count_if(F.col("prediction") == 1.0).alias("outbreak"), F.count("*").alias("n")
    ).select("outbreak", (F.col("n") - F.col("outbreak")).alias("stable"))


def status_by_region(windows: DataFrame) -> DataFrame:
    """Windows above and not above 0.5 per region; a missing prediction is in neither."""
    return (
        windows.groupBy("region_id")
        .agg(
            F.count_if(F.col("prediction") > 0.5).alias("outbreak"),
            F.count_if(F.col("prediction") <= 0.5).alias("stable"),
        )
        .orderBy("region_id")
    )


def distinct_dates(windows: DataFrame) -> DataFrame:
    return windows.select("date").distinct().orderBy("date")


def distinct_regions(windows: DataFrame) -> DataFrame:
    return windows.select("region_id").distinct().orderBy("region_id")


def last_dates(windows: DataFrame, n: int = 30) -> DataFrame:
    return windows.select("date").distinct().orderBy(F.col("date").desc()).limit(n)


def last_dates_semi(windows: DataFrame, n: int = 30) -> DataFrame:
    """Windows on one of the last ``n`` dates. The date list is bounded by ``n``."""
    return windows.join(F.broadcast(last_dates(windows, n)), "date", "left_semi")


def region_date_grid(windows: DataFrame, n: int = 30) -> DataFrame:
    """Every region on each of the last ``n`` dates, null where a region had no window.

    The dates are one array of at most ``n`` values which each region unfolds.
    """
    dates = last_dates(windows, n).agg(F.array_sort(F.collect_list("date")).alias("dates"))
    grid = (
        windows.select("region_id")
        .distinct()
        .select("region_id", F.explode(dates.scalar()).alias("date"))
    )
    points = last_dates_semi(windows, n).groupBy("region_id", "date").agg(
        F.max(F.struct("total_cases", "positive_cases", "prediction")).alias("w")
    )
    return (
        grid.join(points, ["region_id", "date"], "left")
        .select(
            "region_id",
            "date",
            F.col("w.positive_cases").alias("positive_cases"),
            F.col("w.prediction").eqNullSafe(1.0).alias("flagged"),
        )
        .orderBy("region_id", "date")
    )
