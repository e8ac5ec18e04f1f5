"""The two models: split, features, training, saving, scoring, evaluation."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from casebeacon.plans import models, views
from casebeacon.sources import files


@pytest.fixture(scope="module")
def labelled(spark, sf_dir):
    return models.label_cases(views.cases(spark, sf_dir).where("event_id < 2000")).persist()


@pytest.fixture(scope="module")
def case_model(labelled):
    return models.train(models.case_pipeline(trees=8, depth=4), labelled)


def test_stage_settings(spark):
    forest = models.case_pipeline().getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 8, 42)
    boosting = models.outbreak_pipeline().getStages()[-1]
    assert (boosting.getMaxIter(), boosting.getMaxDepth(), boosting.getMaxBins(), boosting.getSeed()) == (20, 5, 32, 42)


def test_split_does_not_depend_on_partitioning(labelled):
    again = models.with_split(labelled.drop("is_train").repartition(7), F.col("case_id"))
    pick = lambda df: {tuple(r) for r in df.select("case_id", "is_train").collect()}
    assert pick(labelled) == pick(again)
    share = labelled.where("is_train").count() / labelled.count()
    assert 0.75 < share < 0.85


def test_every_case_is_scored_once(case_model, labelled):
    scored = models.score_cases(case_model, labelled)
    assert scored.count() == labelled.count()
    assert scored.where("prediction NOT IN (0.0, 1.0) OR probability NOT BETWEEN 0 AND 1").count() == 0
    assert scored.where("(probability > 0.5) <> (prediction = 1.0) AND probability <> 0.5").count() == 0


def test_scoring_works_after_an_observed_count(spark, case_model, labelled):
    counted = Observation("counted")
    spark.range(3).observe(counted, F.count(F.lit(1)).alias("rows")).collect()
    assert counted.get == {"rows": 3}
    assert not case_model.stages[-1].hasSummary
    assert models.score_cases(case_model, labelled).agg(F.sum("probability")).first()[0] > 0


def test_rows_with_a_missing_feature_are_counted_in_training_and_stay_in_scoring(case_model, labelled):
    holes = labelled.withColumn("humidity", F.when(F.col("event_id") % 10 != 0, F.col("humidity")))
    counts = {}
    models.train(models.case_pipeline(trees=2, depth=2), holes, counts)
    assert counts == {"rows": labelled.where("is_train").count(), "incomplete": holes.where("is_train AND humidity IS NULL").count()}
    scored = models.score_cases(case_model, holes)
    assert scored.count() == labelled.count()
    assert scored.where("prediction IS NULL").count() == scored.where("probability IS NULL").count() == 200
    whole = {r["case_id"]: r["probability"] for r in models.score_cases(case_model, labelled).collect()}
    assert all(r["probability"] in (None, whole[r["case_id"]]) for r in scored.collect())


def test_more_regions_than_the_default_bins(spark):
    rows = [(f"c{i}", f"r{i % 40}", "M", i, 36.0, 20.0, 50.0, 1.0, 2, float(i % 2)) for i in range(400)]
    columns = "case_id string, region_id string, gender string, patient_age int, body_temperature double, ambient_temperature double, humidity double, rainfall_mm double, symptom_count int, label double"
    cases = models.with_split(spark.createDataFrame(rows, columns), F.col("case_id"))
    assert models.score_cases(models.train(models.case_pipeline(trees=2, depth=2, bins=64), cases), cases).count() == 400


def test_the_case_job_leaves_its_results(spark, labelled, run_dir):
    files.write_parquet(labelled.drop("label", "is_train"), f"{run_dir}/clean")
    counts = models.run_case_model(spark, f"{run_dir}/clean", f"{run_dir}/job", 500, trees=4, depth=3)
    assert counts == {"rows": 500, "incomplete": 0, "scored": labelled.count(), "unscored": 0}
    folders = models.ModelFolders.below(f"{run_dir}/job")
    assert spark.read.parquet(folders.importances).count() == len(models.CASE_FEATURES)
    assert {r["metric"] for r in spark.read.parquet(folders.metrics).collect()} >= {"auc", "accuracy"}


def test_importances_sum_to_one(spark, case_model):
    rows = models.importance_rows(spark, case_model, models.CASE_MODEL, models.CASE_FEATURES).collect()
    assert [r["feature_name"] for r in rows] == list(models.CASE_FEATURES)
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)


def test_saved_model_scores_alike(case_model, labelled, run_dir):
    models.save_model(case_model, f"{run_dir}/model")
    models.save_model(case_model, f"{run_dir}/model")
    loaded = models.load_model(f"{run_dir}/model")
    pick = lambda m: {tuple(r) for r in models.score_cases(m, labelled).select("case_id", "probability").collect()}
    assert pick(loaded) == pick(case_model)


def test_evaluation_uses_held_out_rows_only(case_model, labelled):
    scored = models.score_cases(case_model, labelled)
    rows = {r["metric"]: r["value"] for r in models.evaluate_model(scored, models.CASE_MODEL).collect()}
    assert set(rows) == {"auc", "f1", "weighted_precision", "weighted_recall", "accuracy"}
    held_out = scored.where("NOT is_train")
    accuracy = held_out.where("label = prediction").count() / held_out.count()
    assert rows["accuracy"] == pytest.approx(accuracy)


def test_one_class_gives_scores_but_no_auc(spark, sf_dir):
    windows = views.windows(spark, sf_dir).drop("prediction")
    flat = models.with_split(windows.withColumn("is_outbreak", F.lit(0.0)), models.window_key())
    model = models.train(models.outbreak_pipeline(rounds=2, depth=2), flat)
    scored = models.score_windows(model, flat)
    assert scored.where("prediction <> 0").count() == 0
    metrics = {r["metric"] for r in models.evaluate_model(scored, models.OUTBREAK_MODEL, "is_outbreak").collect()}
    assert "auc" not in metrics and "accuracy" in metrics
    importances = models.importance_rows(spark, model, models.OUTBREAK_MODEL, models.OUTBREAK_FEATURES)
    assert importances.count() in (0, len(models.OUTBREAK_FEATURES))
