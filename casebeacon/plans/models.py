"""The two tree models: individual case risk and regional outbreak."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebeacon.functions import expressions as X
from casebeacon.operators.evaluation import auc_from_counts, weighted_from_counts
from casebeacon.operators.ranking import ranked
from casebeacon.operators.windows import outbreak_label, outbreak_threshold, region_window_features
from casebeacon.sources.files import write_parquet

CASE_MODEL = "case_risk"
OUTBREAK_MODEL = "outbreak"

# The features of each model, in vector order.
CASE_FEATURES = (
    "patient_age",
    "region_idx",
    "gender_idx",
    "body_temperature",
    "ambient_temperature",
    "humidity",
    "rainfall_mm",
    "symptom_count",
)
OUTBREAK_FEATURES = (
    "region_idx",
    "total_cases",
    "avg_rainfall",
    "avg_humidity",
    "avg_temperature",
    "avg_symptoms",
)

TRAIN_PERCENT = 80


def category_index(df: DataFrame, column: str) -> DataFrame:
    """Index of each category, the most frequent first, equal counts in text order.

    Categories are range-sorted, so many of equal count are spread over tasks; see `ranking.ranked`.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("category")).agg(F.count("*").alias("count"))
    return ranked(counts, [F.col("count").desc(), F.col("category")], "place").select("category", "count", F.col("place").cast("double").alias("idx"))


def indexer(column: str, output: str) -> StringIndexer:
    """The same as a pipeline stage; unseen and missing categories get the last index."""
    return StringIndexer(
        inputCol=column, outputCol=output, handleInvalid="keep", stringOrderType="frequencyDesc"
    )


def missing_feature(df: DataFrame, features: Sequence[str]) -> Column:
    """True for rows without one of the features that are columns of ``df``."""
    conditions = [F.col(f).isNull() for f in features if f in df.columns]
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def assembler(features: Sequence[str]) -> VectorAssembler:
    """Feature vector for training, which leaves rows with a missing feature out; `train` counts them."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """All rows with their vector in ``features``; null where a feature is missing."""
    whole = assembler(features).setHandleInvalid("keep").transform(df)
    return whole.withColumn("features", F.when(~missing_feature(df, features), F.col("features")))


def train_flag(key: Column, percent: int = TRAIN_PERCENT) -> Column:
    """True for the training share. A hash of the key decides, so the split does not depend on
    how the data is partitioned and stays the same when a lost task runs again."""
    digest = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return digest % 100 < percent


def with_split(df: DataFrame, key: Column, percent: int = TRAIN_PERCENT) -> DataFrame:
    return df.withColumn("is_train", train_flag(key, percent))


def window_key() -> Column:
    return F.concat_ws("|", "region_id", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


def case_pipeline(trees: int = 100, depth: int = 8, bins: int = 32, seed: int = 42) -> Pipeline:
    """``bins`` must exceed the number of regions."""
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, maxBins=bins, seed=seed
    )
    return Pipeline(
        stages=[
            indexer("region_id", "region_idx"),
            indexer("gender", "gender_idx"),
            assembler(CASE_FEATURES),
            forest,
        ]
    )


def outbreak_pipeline(rounds: int = 20, depth: int = 5, bins: int = 32, seed: int = 42) -> Pipeline:
    boosting = GBTClassifier(
        labelCol="is_outbreak",
        featuresCol="features",
        maxIter=rounds,
        maxDepth=depth,
        maxBins=bins,
        seed=seed,
    )
    return Pipeline(stages=[indexer("region_id", "region_idx"), assembler(OUTBREAK_FEATURES), boosting])


def label_cases(cases: DataFrame) -> DataFrame:
    return cases.withColumn("label", X.case_label()).transform(with_split, F.col("case_id"))


def label_windows(windows: DataFrame) -> DataFrame:
    """Outbreak label from the windows' own positives: this model describes the present."""
    return outbreak_label(windows, outbreak_threshold(windows)).transform(with_split, window_key())


def training_rows(labelled: DataFrame, key: Sequence[str], limit: int | None = None) -> DataFrame:
    """The rows to train on: all of the training share, or ``limit`` of them in hash order of the key."""
    rows = labelled.where("is_train")
    return rows if limit is None else rows.orderBy(F.xxhash64(*key), *key).limit(limit)


def train(pipeline: Pipeline, labelled: DataFrame, counts: dict[str, int] | None = None) -> PipelineModel:
    """Fits on the training rows. ``counts`` gets their number and how many lacked a feature.

    A fitted forest holds a training summary, and through it the session, which scoring would
    send along with every task; after a row count was observed in the session that even fails.
    The copy goes without the summary.
    """
    rows = labelled.where("is_train")
    if counts is not None:
        features = next(s for s in pipeline.getStages() if isinstance(s, VectorAssembler)).getInputCols()
        seen = rows.agg(F.count("*").alias("rows"), F.count_if(missing_feature(rows, features)).alias("incomplete"))
        counts.update(seen.first().asDict())
    return pipeline.fit(rows).copy()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def apply_model(model: PipelineModel, labelled: DataFrame) -> DataFrame:
    """All rows, training rows included, with class, probability and `is_train`.

    A row with a missing feature stays, with null as its class and probability.
    """
    whole = [s.copy().setHandleInvalid("keep") if isinstance(s, VectorAssembler) else s for s in model.stages]
    features = next(s for s in whole if isinstance(s, VectorAssembler)).getInputCols()
    known = ~missing_feature(labelled, features)
    scored = PipelineModel(whole).transform(labelled)
    return scored.withColumns(
        {
            "prediction": F.when(known, F.col("prediction")),
            "probability": F.when(known, vector_to_array("probability")[1]),
        }
    )


def score_cases(model: PipelineModel, labelled: DataFrame) -> DataFrame:
    return apply_model(model, labelled).select(*select_case_predictions(), "probability", "is_train")


def score_windows(model: PipelineModel, labelled: DataFrame) -> DataFrame:
    return apply_model(model, labelled).select(*select_window_predictions(), "probability", "is_train")


def select_case_predictions() -> list[str]:
    return ["case_id", "region_id", "patient_age", "gender", "label", "prediction"]


def select_window_predictions() -> list[str]:
    return ["region_id", "date", "total_cases", "positive_cases", "is_outbreak", "prediction"]


def evaluate_model(scored: DataFrame, model_name: str, label: str = "label") -> DataFrame:
    """Metrics on the held-out rows as (model, metric, value); undefined ones are left out.

    Scores are counted once; both metric groups read the counts.
    """
    held_out = scored.where(~F.col("is_train") & F.col(label).isNotNull() & F.col("prediction").isNotNull())
    counts = held_out.groupBy(F.col(label).alias("label"), "prediction", F.col("probability").alias("score")).agg(
        F.count("*").alias("n")
    )
    area = auc_from_counts(
        counts.groupBy("score").agg(
            F.sum(F.when(F.col("label") > 0.5, F.col("n")).otherwise(0)).alias("pos"),
            F.sum(F.when(F.col("label") <= 0.5, F.col("n")).otherwise(0)).alias("neg"),
        )
    )
    pairs = counts.groupBy("label", "prediction").agg(F.sum("n").alias("n"))
    weighted = weighted_from_counts(pairs)
    as_rows = lambda df: df.unpivot([], df.columns, "metric", "value")
    return (
        as_rows(area)
        .unionByName(as_rows(weighted))
        .where("value IS NOT NULL")
        .select(F.lit(model_name).alias("model_name"), "metric", "value")
    )


def importance_rows(spark: SparkSession, model: PipelineModel, model_name: str, features: Sequence[str]) -> DataFrame:
    """Importance of each feature; none when the training rows had one class only."""
    weights = model.stages[-1].featureImportances
    values = weights.toArray() if weights.size == len(features) else []
    return spark.createDataFrame(
        [(model_name, f, float(v)) for f, v in zip(features, values)],
        "model_name string, feature_name string, importance double",
    )


def importance_table(importances: DataFrame) -> DataFrame:
    """Importances for display, the largest first, in percent."""
    return importances.withColumn("importance_pct", F.round(F.col("importance") * 100, 1)).orderBy(
        "model_name", F.col("importance").desc(), "feature_name"
    )


@dataclass(frozen=True)
class ModelFolders:
    """Where a model job leaves its results."""

    model: str
    predictions: str
    metrics: str
    importances: str

    @classmethod
    def below(cls, path: str) -> ModelFolders:
        return cls(*(f"{path}/{name}" for name in ("model", "predictions", "metrics", "importances")))


def _run(spark: SparkSession, name: str, labelled: DataFrame, pipeline: Pipeline, key: Sequence[str], score, features, label: str, folders: ModelFolders, limit: int | None) -> dict[str, int]:
    counts: dict[str, int] = {}
    model = train(pipeline, training_rows(labelled, key, limit), counts)
    save_model(model, folders.model)
    write_parquet(score(load_model(folders.model), labelled), folders.predictions)
    scored = spark.read.parquet(folders.predictions)
    write_parquet(evaluate_model(scored, name, label), folders.metrics)
    write_parquet(importance_rows(spark, model, name, features), folders.importances)
    scores = scored.agg(F.count("*").alias("scored"), F.count_if(F.col("prediction").isNull()).alias("unscored"))
    return counts | scores.first().asDict()


def run_case_model(spark: SparkSession, clean_path: str, target: str, limit: int | None = None, **settings) -> dict[str, int]:
    """The case risk job: trains, saves, scores every case, evaluates, writes importances.

    Reads the clean table and leaves model, predictions, metrics and importances below ``target``.
    ``limit`` bounds the training rows (default: all of the training share). Returns row counts.
    """
    labelled = label_cases(spark.read.parquet(clean_path))
    return _run(spark, CASE_MODEL, labelled, case_pipeline(**settings), ["case_id"], score_cases, CASE_FEATURES, "label", ModelFolders.below(target), limit)


def run_outbreak_model(spark: SparkSession, clean_path: str, target: str, window: str = "1 minute", ts: str = "timestamp", limit: int | None = None, **settings) -> dict[str, int]:
    """The outbreak job on region-by-window features of the clean table, like `run_case_model`."""
    features = f"{target}/windows"
    write_parquet(region_window_features(spark.read.parquet(clean_path), window, ts), features)
    labelled = label_windows(spark.read.parquet(features))
    return _run(spark, OUTBREAK_MODEL, labelled, outbreak_pipeline(**settings), ["region_id", "date"], score_windows, OUTBREAK_FEATURES, "is_outbreak", ModelFolders.below(target), limit)
