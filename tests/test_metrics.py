"""Edge cases of rates, bins, quantiles and model metrics."""

import datetime as dt
import json
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from casebeacon.functions import expressions as X
from casebeacon.operators import evaluation, histograms, metrics, ranking
from casebeacon.operators import windows as W
from casebeacon.plans import models, snapshots, views

CASES = (
    "case_id string, timestamp timestamp, region_id string, district string, patient_age int, gender string, "
    "rapid_test_result string, humidity double, ambient_temperature double, rainfall_mm double, symptom_count int"
)


def cases(spark, *rows):
    """Rows as dictionaries; what is not given is null."""
    names = [f.split()[0] for f in CASES.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], CASES)


def one(df):
    return df.first().asDict()


def test_bins(spark):
    df = cases(
        spark,
        *({"patient_age": a, "rapid_test_result": "positive"} for a in (4, 5, None, 151)),
        *({"rainfall_mm": r, "rapid_test_result": "negative"} for r in (2.0, 20.0, -1.0, 10000.0, None)),
    )
    ages = {r["label"]: (r["total"], r["positive"]) for r in histograms.age_histogram(df).collect()}
    assert ages["0-4"] == (1, 1) and ages["5-14"] == (1, 1) and ages["60+"] == (0, 0) and len(ages) == 7
    rains = {r["label"]: (r["total"], r["positivity"]) for r in histograms.rain_positivity(df).collect()}
    assert rains["0-2 mm"] == (0, 0.0) and rains["2-5 mm"] == (1, 0.0) and rains["20+ mm"] == (1, 0.0)
    assert sum(t for t, _ in rains.values()) == 2


def test_age_groups(spark):
    ages = (0, 4, 5, 14, 15, 44, 45, 64, 65, None)
    df = cases(spark, *({"patient_age": a} for a in ages))
    got = [r["g"] for r in df.select(X.age_group().alias("g")).collect()]
    assert got == ["0-4", "0-4", "5-14", "5-14", "15-44", "15-44", "45-64", "45-64", "65+", "65+"]


def test_ties_round_up(spark):
    df = cases(spark, *({"region_id": "N", "rapid_test_result": "positive" if i == 0 else "x"} for i in range(16)))
    assert one(metrics.region_rates(df))["positivity"] == 6.3
    assert one(metrics.total_positive(df)) == {"total_cases": 16, "total_positive": 1, "total_negative": 15}


def test_correlation_skips_incomplete_pairs(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (None, 1.0), (3.0, 0.0), (4.0, 0.0), (2.0, 1.0)], "x double, y double"
    )
    assert df.agg(X.pearson(F.col("x"), F.col("y"))).first()[0] == pytest.approx(-0.894427, abs=1e-6)
    constant = df.agg(X.pearson(F.lit(1.0), F.col("y"))).first()[0]
    assert constant is None


def test_no_cases(spark):
    empty = cases(spark)
    assert one(metrics.total_cases(empty)) == {"total_cases": 0}
    assert one(metrics.region_count(empty)) == {"region_count": 0}
    assert metrics.positivity_by_region(empty).count() == 0
    assert {r["positivity"] for r in histograms.rain_positivity(empty).collect()} == {0.0}
    assert {r["correlation_with_positivity"] for r in metrics.climate_correlation(empty).collect()} == {None}
    document = json.loads(snapshots.as_json(snapshots.dashboard_snapshot(empty)).first()[0])
    assert document["total_cases"] == 0 and document["recent_cases"] == [] and document["charts"]["pie"] == [0, 0]


WINDOWS = "region_id string, date timestamp, total_cases bigint, positive_cases bigint, prediction double"


def windows(spark, *rows):
    return spark.createDataFrame(
        [(r, dt.datetime(2024, 1, d), t, p, q) for r, d, t, p, q in rows], WINDOWS
    )


def test_no_windows(spark):
    empty = windows(spark)
    assert one(W.outbreak_threshold(empty)) == {"threshold": None}
    threshold = W.threshold_lower_quantile(empty)
    assert one(threshold) == {"threshold": None}
    assert histograms.window_histogram(empty, threshold).count() == 0
    assert W.region_date_grid(empty).count() == 0
    scored = spark.createDataFrame([], "case_id string, region_id string, label double, prediction double")
    assert one(evaluation.binary_metrics(evaluation.confusion_matrix(scored))) == {
        "accuracy": 0.0, "precision": 0.0, "recall": 0.0, "f1": 0.0, "n": 0,
    }
    importances = spark.createDataFrame([], "model_name string, feature_name string, importance double")
    document = json.loads(snapshots.as_json(snapshots.analytics_snapshot(empty, scored, importances)).first()[0])
    assert document["at_risk_count"] == 0 and document["charts"]["threshold"] is None
    assert document["charts"]["hist_labels"] == [] and document["charts"]["status"] == [0, 0]


def test_labels_without_threshold_are_zero(spark):
    w = windows(spark, ("N", 1, 5, 2, None))
    labelled = W.outbreak_label(w, W.outbreak_threshold(w.limit(0)))
    assert labelled.first()["is_outbreak"] == 0.0


@pytest.mark.parametrize("seed", range(6))
def test_lower_quantile_is_the_list_rule(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.randint(0, 9), rng.randint(0, 300_000), 65536, 65535]) for _ in range(rng.randint(1, 60))]
    df = spark.createDataFrame([(v,) for v in values], "positive_cases bigint")
    expected = sorted(values)[int(0.75 * (len(values) - 1))]
    assert W.threshold_lower_quantile(df).first()[0] == expected


def test_lower_quantile_of_two(spark):
    df = spark.createDataFrame([(1,), (2,)], "positive_cases bigint")
    assert W.threshold_lower_quantile(df).first()[0] == 1


def test_approximate_threshold_is_within_its_error(spark, sf_dir):
    w = views.windows(spark, sf_dir)
    values = sorted(r[0] for r in w.select("positive_cases").collect())
    threshold = W.outbreak_threshold(w).first()[0]
    below = sum(v < threshold for v in values) / len(values)
    upto = sum(v <= threshold for v in values) / len(values)
    assert below <= 0.76 and upto >= 0.74


def test_latest_window_ties_and_null_predictions(spark):
    w = windows(
        spark, ("N", 1, 9, 9, 1.0), ("N", 2, 5, 2, 1.0), ("N", 2, 6, 1, None), ("S", 1, 1, 1, 1.0), ("S", 2, 1, 1, 0.0)
    )
    latest = {r["region_id"]: (r["total_cases"], r["prediction"]) for r in W.latest_window_per_region(w).collect()}
    assert latest == {"N": (6, None), "S": (1, 0.0)}
    assert W.at_risk_regions(w).count() == 0
    assert one(W.predicted_status(w)) == {"outbreak": 3, "stable": 2}
    status = {r["region_id"]: (r["outbreak"], r["stable"]) for r in W.status_by_region(w).collect()}
    assert status == {"N": (2, 0), "S": (1, 1)}


def test_grid_has_gaps(spark):
    w = windows(spark, ("N", 1, 3, 1, 1.0), ("N", 2, 3, 2, 0.0), ("S", 2, 3, 0, None))
    grid = {(r["region_id"], r["date"].day): (r["positive_cases"], r["flagged"]) for r in W.region_date_grid(w).collect()}
    assert grid == {("N", 1): (1, True), ("N", 2): (2, False), ("S", 1): (None, False), ("S", 2): (0, False)}
    assert W.region_date_grid(w, 1).count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_auc_and_weighted_metrics_match_spark_evaluators(spark, seed):
    rng = random.Random(seed)
    grid = [0.0, 1.0, 0.5, 0.5 + 2**-20, 0.5 + 2**-33, 0.5 + 2**-40, 1 / 3]
    rows = [
        (float(rng.random() < 0.4), rng.choice(grid) if rng.random() < 0.6 else rng.random()) for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "label double, score double").withColumn(
        "prediction", (F.col("score") > 0.5).cast("double")
    )
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert evaluation.auc(df).first()[0] == pytest.approx(evaluator.evaluate(df), abs=1e-9)
    mine = one(evaluation.weighted_metrics(df))
    for name, theirs in (
        ("f1", "f1"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
        ("accuracy", "accuracy"),
    ):
        expected = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert mine[name] == pytest.approx(expected, abs=1e-9)


def test_auc_of_one_class_is_undefined(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.4)], "label double, score double")
    assert evaluation.auc(df).first()[0] is None


def test_category_index_is_the_indexer_order(spark, sf_dir):
    df = views.cases(spark, sf_dir)
    fitted = models.indexer("district", "idx").fit(df)
    mine = [r["category"] for r in models.category_index(df, "district").orderBy("idx").collect()]
    assert mine == list(fitted.labelsArray[0])
    assert isinstance(models.indexer("a", "b"), StringIndexer)
    unseen = fitted.transform(spark.createDataFrame([("?",), (None,)], "district string")).collect()
    assert {r["idx"] for r in unseen} == {float(len(mine))}


def test_recent_cases_without_time_come_last(spark):
    df = cases(
        spark,
        {"case_id": "0123456789abcdef", "timestamp": dt.datetime(2024, 1, 1), "gender": "M"},
        {"case_id": "b", "gender": "X"},
    )
    shown = metrics.recent_case_view(metrics.recent_cases(df)).collect()
    assert [r["case_id"] for r in shown] == ["0123456789abcdef", "b"]
    assert metrics.recent_case_view(df, id_length=12).first()["case_id"] == "0123456789ab"
    assert [r["gender"] for r in shown] == ["Male", "X"]
    assert [r["timestamp"] for r in shown] == ["2024-01-01 00:00:00", ""]


def test_many_categories_of_equal_count_are_ranked_by_many_tasks(spark):
    """Positions over range partitions equal one sort, ties by text; no partition sees them all."""
    df = spark.range(3000).selectExpr("concat('c', CASE WHEN id < 50 THEN 7 ELSE id END) AS name")
    counts = df.groupBy("name").count()
    got = ranking.ranked(counts, [F.col("count").desc(), F.col("name")], "place", rows_per_task=300).collect()
    want = sorted(got, key=lambda r: (-r["count"], r["name"]))
    assert [r["place"] for r in want] == list(range(2951)) and want[0]["name"] == "c7"
    index = {r["category"]: (r["count"], r["idx"]) for r in models.category_index(df, "name").collect()}
    assert index == {r["name"]: (r["count"], float(r["place"])) for r in got}
    assert models.category_index(df.where("name is null"), "name").collect() == []
