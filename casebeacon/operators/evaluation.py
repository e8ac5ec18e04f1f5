"""Quality of scored rows: counts first, metrics from the few counted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebeacon.functions import expressions as X


def risk_by_region(scored: DataFrame) -> DataFrame:
    """Mean prediction and cases per region, the highest mean first."""
    return (
        scored.groupBy("region_id")
        .agg(F.avg("prediction").alias("avg_risk"), F.count("case_id").alias("total"))
        .orderBy(F.col("avg_risk").desc_nulls_last(), "region_id")
        .withColumn("avg_risk", F.coalesce(F.round("avg_risk", 3), F.lit(0.0)))
    )


def confusion_matrix(scored: DataFrame, label: str = "label", cut: float = 0.5) -> DataFrame:
    """True and false positives and negatives in one pass; rows with a null are in none."""
    actual, predicted = F.col(label), F.col("prediction")
    return scored.agg(
        F.count_if((actual > cut) & (predicted > cut)).alias("tp"),
        F.count_if((actual <= cut) & (predicted <= cut)).alias("tn"),
        F.count_if((actual <= cut) & (predicted > cut)).alias("fp"),
        F.count_if((actual > cut) & (predicted <= cut)).alias("fn"),
    )


def binary_columns(tp: Column, tn: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Percent metrics of the positive class from the four counts, 0 where undefined."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    precision, recall, n = ratio(tp, tp + fp), ratio(tp, tp + fn), tp + tn + fp + fn
    return {
        "accuracy": X.safe_rate(tp + tn, n, 1),
        "precision": F.round(precision * 100, 1),
        "recall": F.round(recall * 100, 1),
        "f1": F.round(ratio(2 * precision * recall, precision + recall) * 100, 1),
        "n": n,
    }


def binary_metrics(matrix: DataFrame) -> DataFrame:
    """The metrics of `binary_columns` from a confusion row."""
    columns = binary_columns(*(F.col(c) for c in ("tp", "tn", "fp", "fn")))
    return matrix.select(*(value.alias(name) for name, value in columns.items()))


def weighted_metrics(scored: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy and class-weighted F1, precision and recall, for any number of classes.

    One pass counts (label, prediction) pairs; the metrics read only those counts.
    """
    return weighted_from_counts(
        scored.where(F.col(label).isNotNull() & F.col("prediction").isNotNull())
        .groupBy(F.col(label).alias("label"), "prediction")
        .agg(F.count("*").alias("n"))
    )


def weighted_from_counts(pairs: DataFrame) -> DataFrame:
    """The same from counted (label, prediction, n) rows."""
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n"))
                    .otherwise(0)
                    .cast("bigint")
                    .alias("correct"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("bigint").alias("actual"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("bigint").alias("correct"),
                ),
            )
        )
    )
    classes = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("correct").alias("correct")
    )
    precision = F.coalesce(F.try_divide("correct", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("correct", "actual"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    weighted = lambda m: F.try_divide(F.sum(m * F.col("actual")), F.sum("actual"))
    return classes.agg(
        weighted(f1).alias("f1"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
        F.try_divide(F.sum("correct"), F.sum("actual")).alias("accuracy"),
    )


def auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve for scores in [0, 1], ties counted half."""
    return auc_from_counts(
        scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(
            F.count_if(F.col(label) > 0.5).alias("pos"),
            F.count_if(F.col(label) <= 0.5).alias("neg"),
        )
    )


def auc_from_counts(counts: DataFrame) -> DataFrame:
    """The area from one (score, pos, neg) row per distinct score.

    The area is the share of (positive, negative) pairs in the right order. Pairs are counted
    where their scores part: within a small cell of the unit interval, between the 65,536 small
    cells of a large one, and between the 65,536 large cells. Each step sums inside one cell of
    the next and leaves one row per cell, so no running sum covers more than its cell.
    """
    cells = 65536
    position = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0)) * cells
    large = F.floor(position)
    rows = counts.select(
        large.alias("large"),
        F.floor((position - large) * cells).alias("small"),
        "score",
        "pos",
        "neg",
        (F.col("pos").cast("double") * F.col("neg") / 2).alias("pairs"),
    )
    for cell, order in ((["large", "small"], "score"), (["large"], "small"), ([], "large")):
        earlier = Window.partitionBy(*cell).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        below = F.coalesce(F.sum("neg").over(earlier), F.lit(0))
        rows = (
            rows.withColumn("pairs", F.col("pairs") + F.col("pos").cast("double") * below)
            .groupBy(*cell)
            .agg(F.sum("pairs").alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        )
    return rows.select(F.try_divide("pairs", F.col("pos").cast("double") * F.col("neg")).alias("auc"))
