"""Every operator as a query over the test tables.

Windows and cooldowns are longer than the library's defaults because the test events are
sparse; doubles are rounded so that both sides of a comparison agree to the last digit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebeacon.functions import expressions as X
from casebeacon.operators import alerts, cleaning, envelope, evaluation, histograms, merge, metrics
from casebeacon.operators import windows as W
from casebeacon.plans import etl, models, newest, rollups, snapshots, views
from casebeacon.schemas import CASE_PREDICTIONS, OUTBREAK_PREDICTIONS
from casebeacon.session import work_dir
from casebeacon.sources import files, jdbc, kafka, keyed
from casebeacon.streaming import alerts as stream_alerts
from casebeacon.streaming import ingest, live, progress

Query = Callable[[SparkSession, str], DataFrame]

ALERT_WINDOW = 12 * 3600
ALERT_COOLDOWN = 6 * 3600
STREAM_DELAY = "1 hour"

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def simple(name: str, view: Query, operator: Callable[[DataFrame], DataFrame]) -> None:
    """Registers an operator that takes one view."""
    QUERIES[name] = lambda spark, sf_dir: operator(view(spark, sf_dir))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def finish(stream) -> None:
    """Waits until a query has read all there is."""
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()


ONCE = {"availableNow": True}


# ------------------------------------------------------------------ sources and sinks


@query
def read_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records written as JSON lines under year, month and day, and read by a glob."""
    path = work_dir(spark, "raw-json")
    columns = ["case_id", "region_id", "rapid_test_result", "humidity", "rainfall_mm"]
    raw = views.cases_raw(spark, sf_dir)
    folders = {"year": (1, 4), "month": (6, 2), "day": (9, 2)}
    dated = raw.withColumns({k: F.substring("timestamp_text", *at) for k, at in folders.items()})
    files.write_json(dated.select(*columns, *folders), path, list(folders))
    read = files.read_raw_json(spark, f"{path}/*/*/*/*.json", raw.select(*columns).schema)
    return rounded(read.select(*columns, F.col(files.UNREADABLE).isNotNull().alias("unreadable")), "humidity", "rainfall_mm")


@query
def read_inferred_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of which some lack a field and hold whole numbers where others hold fractions; the schema comes from all."""
    path = work_dir(spark, "inferred-json")
    raw = views.cases_raw(spark, sf_dir)
    early = F.substring("case_id", 2, 20).cast("bigint") % 2 == 0
    files.write_json(raw.where(early).select("case_id", F.floor("humidity").alias("humidity")), f"{path}/a")
    files.write_json(raw.where(~early).select("case_id", "humidity", "rainfall_mm", "district"), f"{path}/b")
    read = files.read_inferred_json(spark, f"{path}/*/*.json")
    unreadable = F.col(files.UNREADABLE).isNotNull().alias("unreadable")
    return rounded(read.select("case_id", "humidity", "rainfall_mm", "district", unreadable), "humidity", "rainfall_mm")


@query
def read_clean_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_parquet(spark, f"{sf_dir}/events.parquet", views.SCHEMAS["events"]).select(
        "event_id", "ts", "event_type", "value"
    )


@query
def write_parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "clean")
    columns = ["case_id", "ts", "region_id", "rapid_test_result", "event_date"]
    clean = views.cases(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    files.write_parquet(clean.select(*columns), path, ["event_date"], ["region_id", "ts"])
    return files.read_parquet(spark, path).select(
        *columns[:-1], F.date_format("event_date", "yyyy-MM-dd").alias("event_date")
    )


@query
def sync_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows as they go to the tables; the write itself needs a database."""
    case_path, window_path = work_dir(spark, "case-risk"), work_dir(spark, "outbreak-risk")
    files.write_parquet(views.scored(spark, sf_dir), case_path)
    files.write_parquet(_labelled_windows(spark, sf_dir), window_path)
    cases = jdbc.conform(spark.read.parquet(case_path), CASE_PREDICTIONS, "synced_at")
    windows = jdbc.conform(spark.read.parquet(window_path), OUTBREAK_PREDICTIONS, "synced_at")
    stamped = F.col("synced_at").isNotNull().alias("stamped")
    return cases.select(
        F.lit("case_predictions").alias("target"), F.col("case_id").alias("row_key"), "region_id", "label", "prediction", stamped
    ).unionByName(
        windows.select(
            F.lit("outbreak_predictions").alias("target"),
            F.date_format("date", "yyyy-MM-dd").alias("row_key"),
            "region_id",
            F.col("is_outbreak").alias("label"),
            "prediction",
            stamped,
        )
    )


def _kafka_records(messages: DataFrame) -> DataFrame:
    """Messages in the shape the Kafka source delivers."""
    return messages.withColumns({"key": F.col("key").cast("binary"), "value": F.col("value").cast("binary")})


@query
def kafka_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka.as_messages(_kafka_records(views.messages(spark, sf_dir)))


@query
def kafka_keyed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.wrap_envelope(_reports(spark, sf_dir).select(*_WRAPPED))


_WRAPPED = (
    "case_id", "timestamp", "region_id", "district", "gps_lat", "gps_lon", "patient_age", "gender", "symptoms_json",
    "rapid_test_result", "body_temperature", "ambient_temperature", "humidity", "rainfall_mm",
)


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cases with all fields of a report, in wire order."""
    cases = views.cases(spark, sf_dir).withColumns(
        {
            "timestamp": views.iso_text(F.col("ts")),
            "gps_lat": F.col("event_id") % 90,
            "gps_lon": F.col("event_id") % 180,
            # Whole numbers, which both sides write as the same text.
            "body_temperature": F.col("event_id") % 5 + 36,
            "ambient_temperature": F.col("event_id") % 15 + 18,
            "humidity": F.col("event_id") % 56 + 40,
            "rainfall_mm": F.floor("rainfall_mm"),
            "symptoms_json": X.json_string_list("symptoms_json"),
        }
    )
    return cases.select("event_id", *_WRAPPED)


@query
def dead_letter_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "dead-letters")
    decoded = envelope.decode_messages(views.messages(spark, sf_dir))
    files.write_json(envelope.dead_letters(decoded), path)
    return spark.read.schema("partition int, offset bigint, error string, raw string").json(path)


def _case_updates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A table and updates: every positive case comes again, twice; those of one gender are new to the table.

    The second message reports an earlier time than the first and wins, as it arrived last.
    """
    cases = views.cases(spark, sf_dir)
    columns = ["case_id", "ts", "region_id", "district", "patient_age", "gender", "rapid_test_result"]
    positive = X.is_positive()
    current = cases.where(~positive | (F.col("gender") == "M")).select(*columns)
    same = cases.where(positive).select(*columns)
    first = same.withColumns({"ts": F.col("ts") + F.expr("INTERVAL '1' HOUR"), "patient_age": F.col("patient_age") + 2, "arrival": F.lit(1)})
    second = same.withColumns({"patient_age": F.col("patient_age") + 1, "arrival": F.lit(2)})
    return current, first.unionByName(second)


@query
def upsert_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged table as one plan."""
    return merge.upsert_cases(*_case_updates(spark, sf_dir))


@query
def upsert_stored_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stored table, of which the upsert rewrites the touched buckets."""
    current, updates = _case_updates(spark, sf_dir)
    path = work_dir(spark, "keyed")
    keyed.create(current, path, buckets=32)
    keyed.upsert(updates, path)
    return keyed.read(spark, path)


@query
def dashboard_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.as_json(snapshots.dashboard_snapshot(views.cases(spark, sf_dir), "ts"))


@query
def dashboard_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same document after three batches of changes: most cases, some of them wrong; corrections; the rest."""
    path, cases = work_dir(spark, "rollups"), views.cases(spark, sf_dir).drop("event_id")
    number = F.substring("case_id", 2, 20).cast("bigint")
    late, wrong = number % 3 == 2, number % 7 == 0
    early = cases.where(~late)
    spoilt = early.where(wrong).withColumns(
        {"region_id": F.lit("nowhere"), "patient_age": F.col("patient_age") + 40, "ts": F.col("ts") + F.expr("INTERVAL '400' DAY"), "rapid_test_result": F.lit("positive")}
    )
    first = early.where(~wrong).unionByName(spoilt)
    rollups.add_batch(path, 0, first, None, first, "ts")
    rollups.add_batch(path, 1, early.where(wrong), spoilt, early, "ts")
    rollups.sum_up(spark, path)
    rollups.add_batch(path, 2, cases.where(late), None, cases, "ts")
    return snapshots.as_json(rollups.dashboard(spark, path, cases, "ts"))


@query
def analytics_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a stored window table, as the window job leaves it; several sections read it."""
    clean, path = views.cases(spark, sf_dir), work_dir(spark, "windows")
    files.write_parquet(views.windows_from(clean), path)
    return snapshots.as_json(
        snapshots.analytics_snapshot(
            spark.read.parquet(path), views.scored(spark, sf_dir), views.importances_from(clean)
        )
    )


# ------------------------------------------------- projections, filters, validation


@query
def unwrap_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.unwrap_envelope(views.messages(spark, sf_dir))


@query
def wrap_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrapped and unwrapped again: the payload field by field, and all wire types."""
    reports = _reports(spark, sf_dir)
    wrapped = envelope.wrap_envelope(reports)
    payload = ", ".join(f"{f.name}: {'string' if f.dataType.typeName() == 'array' else f.dataType.simpleString()}" for f in reports.schema)
    parts = F.from_json("value", f"schema struct<fields: array<struct<field: string, type: string>>, name: string>, payload struct<{payload}>")
    types = F.array_join(F.transform("v.schema.fields", lambda f: F.concat_ws(":", f["field"], f["type"])), ",")
    return wrapped.select("key", parts.alias("v")).select(
        "key", "v.payload.*", types.alias("types"), F.col("v.schema.name").alias("schema_name")
    )


@query
def validate_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = envelope.validate_required(views.messages(spark, sf_dir))
    return checked.select("offset", "accepted", F.array_join("missing", ",").alias("missing"))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cases_raw(spark, sf_dir)


@query
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth text is spoilt first."""
    text = F.when(F.col("case_id").endswith("7"), F.concat(F.lit("x"), "timestamp_text")).otherwise(F.col("timestamp_text"))
    parsed = _raw(spark, sf_dir).select("case_id", "patient_age", text.alias("timestamp_text"))
    return parsed.select("case_id", "patient_age", X.parse_timestamp("timestamp_text").alias("ts"))


@query
def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_incomplete(_raw(spark, sf_dir)).select("case_id", "region_id", "rapid_test_result", "patient_age")


@query
def normalize_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.with_normalized_result(_raw(spark, sf_dir)).select("case_id", "patient_age", "rapid_test_result")


@query
def symptom_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = cleaning.with_symptom_count(_raw(spark, sf_dir), "symptoms_json")
    return counted.select("case_id", "patient_age", "symptom_count")


@query
def clean_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.clean_cases(_raw(spark, sf_dir), ts="timestamp_text", symptoms="symptoms_json")
    return rounded(
        clean.withColumnRenamed("timestamp_text", "ts").drop("symptoms_json"), "humidity", "rainfall_mm"
    )


@query
def clean_cases_by_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table after three lots of files, late copies among them; equals cleaning all at once."""
    path = work_dir(spark, "clean-increments")
    raw = _raw(spark, sf_dir)
    for lot in range(3):
        part = raw.where(F.crc32(F.col("timestamp_text").cast("binary")) % 3 == lot)
        etl.add_to_clean(part, path, ts="timestamp_text", symptoms="symptoms_json")
    clean = files.read_parquet(spark, path)
    return rounded(
        clean.withColumnRenamed("timestamp_text", "ts").drop("symptoms_json", "event_date"), "humidity", "rainfall_mm"
    )


simple("positive_flag", _raw, lambda df: df.select("case_id", "patient_age", X.positive_flag().alias("is_positive")))
simple("case_label", _raw, lambda df: df.select("case_id", "patient_age", X.case_label().alias("label")))
simple(
    "positive_only",
    views.cases,
    lambda df: metrics.positive_only(df).select("case_id", "region_id", "rapid_test_result"),
)
# A missing age is part of the test: every 13th case loses it.
simple(
    "age_group",
    views.cases,
    lambda df: df.withColumn("patient_age", F.when(F.col("event_id") % 13 != 0, F.col("patient_age"))).select(
        "case_id", X.age_group().alias("age_group")
    ),
)
simple("gender_display", views.cases, lambda df: df.select("case_id", X.gender_display().alias("gender")))
simple("recent_case_view", views.cases, lambda df: metrics.recent_case_view(df, "ts"))


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.windows(spark, sf_dir)


@query
def outbreak_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _windows(spark, sf_dir)
    labelled = W.outbreak_label(windows, W.threshold_lower_quantile(windows))
    return labelled.select("region_id", "date", "positive_cases", "is_outbreak")


@query
def safe_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region and day, with a denominator that is sometimes 0."""
    windows = _windows(spark, sf_dir).withColumn(
        "part", F.when(F.col("total_cases") % 7 == 0, 0).otherwise(F.col("total_cases"))
    )
    rate = lambda d: X.safe_rate("positive_cases", "part", d)
    return windows.select("region_id", "date", rate(0).alias("r0"), rate(1).alias("r1"), rate(2).alias("r2"))


simple("select_predictions", views.scored, lambda df: df.select(*models.select_case_predictions()))


@query
def window_start_as_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = views.cases(spark, sf_dir).groupBy("region_id", F.window("ts", "6 hours").alias("window")).agg(F.count("*").alias("n"))
    return W.window_start_as_date(windows)


@query
def drop_generated_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _importances(spark, sf_dir).withColumns({"id": F.lit(1), "trained_at": F.current_timestamp()})
    return merge.drop_generated_columns(stored)


def _importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.importances_from(views.cases(spark, sf_dir))


simple(
    "at_risk_regions",
    _windows,
    lambda df: W.at_risk_regions(df).select("region_id", "date", "total_cases", "positive_cases"),
)
simple("flag_points", _windows, lambda df: W.flag_points(df).select("region_id", "date", "flagged"))


@query
def format_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.format_alert(outbreak_alerts(spark, sf_dir), ALERT_WINDOW, "A").select("region_id", "line")


# -------------------------------------------------------------------- joins and lookups

simple(
    "last_dates_semi",
    _windows,
    lambda df: W.last_dates_semi(df, 10).select("region_id", "date", "positive_cases"),
)


@query
def region_date_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With gaps: a hash of region and date leaves windows out, at every scale alike."""
    gap = F.substring(F.md5(F.concat_ws("|", "region_id", F.date_format("date", "yyyy-MM-dd")).cast("binary")), 1, 1) < "4"
    return W.region_date_grid(_windows(spark, sf_dir).where(~gap), 30)


@query
def replace_model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = _importances(spark, sf_dir)
    new = existing.where("model_name = 'case_risk'").withColumn("importance", F.round(F.col("importance") / 2, 6))
    return merge.replace_model_rows(existing, new)


@query
def threshold_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _windows(spark, sf_dir)
    return W.with_threshold(windows, W.threshold_lower_quantile(windows)).select(
        "region_id", "date", "positive_cases", "threshold"
    )


# ------------------------------------------------------------------------- aggregations

simple("total_cases", views.cases, metrics.total_cases)
simple("total_positive", views.cases, metrics.total_positive)
simple("region_count", views.cases, metrics.region_count)
simple("region_summary", views.cases, metrics.region_summary)
simple("positivity_by_region", views.cases, metrics.positivity_by_region)
simple("region_rate_1dp", views.cases, metrics.region_rates)
simple(
    "climate_correlation",
    views.cases,
    lambda df: rounded(metrics.climate_correlation(df), "correlation_with_positivity"),
)
simple("demographics", views.cases, metrics.demographics)
simple("avg_symptoms_by_result", views.cases, metrics.avg_symptoms_by_result)
simple("cases_per_minute", views.cases, lambda df: metrics.cases_per_minute(df, "ts"))
simple("age_histogram", views.cases, histograms.age_histogram)
simple("rain_positivity", views.cases, histograms.rain_positivity)
simple("gender_counts", views.cases, metrics.gender_counts)


@query
def region_window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = W.region_window_features(views.cases(spark, sf_dir), "1 day", "ts")
    return rounded(features, "avg_rainfall", "avg_humidity", "avg_temperature", "avg_symptoms")



@query
def outbreak_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the rank of the approximate quantile lies within its error of one hundredth."""
    windows = _windows(spark, sf_dir)
    value = W.outbreak_threshold(windows).scalar()
    counts = windows.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("positive_cases") < value).alias("below"),
        F.count_if(F.col("positive_cases") <= value).alias("upto"),
    )
    wanted, error = F.col("n") * 0.75, F.col("n") * 0.01 + 1
    return counts.select("n", ((F.col("below") <= wanted + error) & (F.col("upto") >= wanted - error)).alias("within_error"))


@query
def stored_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold of every month, merged from one stored sketch per day, and whether its rank is within one hundredth."""
    path = work_dir(spark, "threshold-sketches")
    windows = _windows(spark, sf_dir)
    files.write_parquet(W.threshold_sketches(windows), path)
    month = F.date_format("day", "yyyy-MM").alias("month")
    merged = W.threshold_of_days(files.read_parquet(spark, path), by=[month])
    exact = windows.select(F.date_format("date", "yyyy-MM").alias("month"), "positive_cases").join(merged, "month")
    ranks = exact.groupBy("month", "n").agg(
        F.count_if(F.expr("positive_cases < threshold")).alias("below"), F.count_if(F.expr("positive_cases <= threshold")).alias("upto")
    )
    wanted, error = F.col("n") * 0.75, F.col("n") * 0.01 + 1
    return ranks.select("month", "n", ((F.col("below") <= wanted + error) & (F.col("upto") >= wanted - error)).alias("within_error"))


simple("threshold_lower_q75", _windows, W.threshold_lower_quantile)
simple("window_histogram", _windows, lambda df: histograms.window_histogram(df, W.threshold_lower_quantile(df)))


def _labelled_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _windows(spark, sf_dir)
    return W.outbreak_label(windows, W.threshold_lower_quantile(windows))


simple("label_distribution", _labelled_windows, metrics.label_distribution)
simple("predicted_status", _windows, W.predicted_status)
simple("status_by_region", _windows, W.status_by_region)
simple("risk_by_region", views.scored, evaluation.risk_by_region)
simple("confusion_matrix", views.scored, evaluation.confusion_matrix)
simple("binary_metrics", views.scored, lambda df: evaluation.binary_metrics(evaluation.confusion_matrix(df)))
simple(
    "weighted_metrics",
    views.scored,
    lambda df: rounded(evaluation.weighted_metrics(df), "f1", "weighted_precision", "weighted_recall", "accuracy"),
)


@query
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rainfall, scaled to [0, 1], as the score of a positive result."""
    cases = views.cases(spark, sf_dir).select(
        X.case_label().alias("label"), (F.col("rainfall_mm") / F.lit(1024.0)).alias("score")
    )
    return rounded(evaluation.auc(cases), "auc")


simple("importance_table", _importances, models.importance_table)


@query
def row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some times are spoilt first."""
    spoilt = F.when(F.col("case_id").endswith("7"), F.concat(F.lit("x"), "timestamp_text")).otherwise(F.col("timestamp_text"))
    return cleaning.row_audit(_raw(spark, sf_dir).withColumn("timestamp_text", spoilt), ts="timestamp_text")


# -------------------------------------------------- windows, latest per key, top-k, sets

simple(
    "latest_window_per_region",
    _windows,
    lambda df: W.latest_window_per_region(df).select("region_id", "date", "total_cases", "positive_cases"),
)


@query
def rolling_positive_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = alerts.rolling_positive_count(views.cases(spark, sf_dir), window_seconds=ALERT_WINDOW, ts="ts")
    return counts.select("region_id", "ts", "cases", "positives", "positives_in_window")


@query
def dedupe_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = cleaning.dedupe_cases(_raw(spark, sf_dir), ts="timestamp_text")
    return deduped.select("case_id", "timestamp_text", "patient_age", "rapid_test_result")


simple(
    "recent_cases",
    views.cases,
    lambda df: metrics.recent_cases(df, "ts").select("case_id", "ts", "region_id", "rapid_test_result"),
)
simple("last_30_buckets", views.cases, lambda df: metrics.last_buckets(metrics.cases_per_minute(df, "ts")))


def _cases_by_day(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark, "cases-by-day")
    files.write_parquet(views.cases(spark, sf_dir).withColumn("event_date", F.to_date("ts")), path, ["event_date"])
    return path


@query
def recent_stored_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = newest.recent_stored_cases(spark, _cases_by_day(spark, sf_dir), "ts")
    return recent.select("case_id", "ts", "region_id", "rapid_test_result")


@query
def last_stored_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest.last_stored_buckets(spark, _cases_by_day(spark, sf_dir), "ts")


@query
def ordered_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of each region in the three ranked tables (one row per region each)."""
    cases, scored = views.cases(spark, sf_dir), views.scored(spark, sf_dir)

    def ranked(section: str, df: DataFrame, *order: Column | str) -> DataFrame:
        position = F.row_number().over(Window.orderBy(*order))
        return df.select(F.lit(section).alias("section"), position.alias("position"), "region_id")

    return (
        ranked("region_summary", metrics.region_summary(cases), F.col("total_cases").desc(), "region_id")
        .unionByName(
            ranked("positivity", metrics.positivity_by_region(cases), F.col("positivity_rate_pct").desc(), "region_id")
        )
        .unionByName(ranked("risk", evaluation.risk_by_region(scored), F.col("avg_risk").desc(), "region_id"))
    )


@query
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = views.cases(spark, sf_dir)
    return merge.union_by_name(
        metrics.positive_only(cases).select("case_id", "region_id", "patient_age"),
        cases.where(~X.is_positive()).select("gender", "case_id", "region_id"),
    )


simple("distinct_dates", _windows, W.distinct_dates)
simple("distinct_regions", _windows, W.distinct_regions)


# ------------------------------------------------------------------- alerts and streams


@query
def outbreak_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.outbreak_alerts(
        views.cases(spark, sf_dir), window_seconds=ALERT_WINDOW, cooldown_seconds=ALERT_COOLDOWN, ts="ts"
    )


@query
def alert_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate limit alone, on every moment with at least three positives in the window."""
    counts = alerts.rolling_positive_count(views.cases(spark, sf_dir), window_seconds=ALERT_WINDOW, ts="ts")
    kept = alerts.alert_cooldown(counts.where("positives_in_window >= 3"), cooldown_seconds=2 * 3600)
    return kept.select("region_id", F.timestamp_micros("at").cast("timestamp_ntz").alias("ts"), "positives_in_window")


def _run_ingest(spark: SparkSession, messages: DataFrame, path: str, checkpoint: str, **options) -> str:
    finish(ingest.stream_ingest(messages, path, checkpoint, ONCE, **options))
    return path


def _ingested(spark: SparkSession, path: str) -> DataFrame:
    return ingest.current_cases(spark, path).select(
        "case_id", F.col("timestamp").alias("ts"), "region_id", "patient_age", "rapid_test_result"
    )


def _message_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """All messages and, for every third case, a later one with an earlier time, in four parts.

    A case's first message lies in another part than its second, so batches of one part separate them.
    """
    first = views.messages(spark, sf_dir)
    clean = views.cases(spark, sf_dir).withColumns({"ts": F.col("ts") - F.expr("INTERVAL '1' HOUR"), "patient_age": F.col("patient_age") + 100})
    again = views.messages_from(clean.where("event_id % 3 = 0")).withColumn("offset", F.col("offset") + 10**12)
    return first.where("offset % 2 = 0"), first.where("offset % 2 = 1"), again.where("offset % 2 = 1"), again.where("offset % 2 = 0")


def _append_parts(parts: Iterable[DataFrame], path: str) -> Iterator[None]:
    """Appends each part to the folder and then pauses; the tasks that read a part write a file each.

    A stream that is run in the pause takes the whole part as a batch, however many files hold it.
    """
    for part in parts:
        part.write.mode("append").parquet(path)
        yield


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as one batch and as four; both tables, and compaction on the way, agree."""
    out, parts = [], _message_parts(spark, sf_dir)
    for name in ("one", "four"):
        source, path, checkpoint = work_dir(spark, "messages"), work_dir(spark, f"ingest-{name}"), work_dir(spark, "ingest-checkpoint")
        for n, _ in enumerate(_append_parts(parts, source), 1):
            if name == "four" or n == len(parts):
                _run_ingest(spark, spark.readStream.schema(parts[0].schema).parquet(source), path, checkpoint)
        ingest.compact_cases(spark, path)
        out.append(_ingested(spark, path).select(F.lit(name).alias("batches"), "*"))
    return out[0].unionByName(out[1])


@query
def at_least_once_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commit of the batch is lost after its writes, so a second start reads and writes it again."""
    path, checkpoint = work_dir(spark, "ingest"), work_dir(spark, "ingest-checkpoint")
    writes: list[int] = []

    def counted(write: Callable[[], None]) -> None:
        writes.append(1)
        write()

    _run_ingest(spark, views.messages_stream(spark, sf_dir), path, checkpoint, store=counted)
    files.remove(spark, f"{checkpoint}/commits/0")
    files.remove(spark, f"{checkpoint}/commits/.0.crc")
    _run_ingest(spark, views.messages_stream(spark, sf_dir), path, checkpoint, store=counted)
    return _ingested(spark, path).withColumn("writes", F.lit(len(writes)))


@query
def retry_then_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store refuses the first two writes."""
    calls: list[int] = []

    def flaky(write: Callable[[], None]) -> None:
        calls.append(1)
        if len(calls) <= 2:
            raise OSError("store is away")
        write()

    path = work_dir(spark, "ingest")
    _run_ingest(spark, views.messages_stream(spark, sf_dir), path, work_dir(spark, "ingest-checkpoint"), store=flaky, pause=lambda _: None)
    return ingest.read_dead_letters(spark, path).withColumn("calls", F.lit(len(calls)))


def _bounded_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case stream with its end, so that the whole of it is released."""
    return live.with_end(views.cases_stream(spark, sf_dir), work_dir(spark, "end"), "ts")


def _stream_alerts(spark: SparkSession, sf_dir: str, sink: stream_alerts.Sink) -> None:
    finish(
        stream_alerts.stream_outbreak_alerts(
            _bounded_cases(spark, sf_dir),
            sink,
            work_dir(spark, "alerts-state"),
            work_dir(spark, "alerts-checkpoint"),
            delay=STREAM_DELAY,
            window_seconds=ALERT_WINDOW,
            cooldown_seconds=ALERT_COOLDOWN,
            ts="ts",
            trigger=ONCE,
        )
    )


@query
def stream_outbreak_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "alerts")
    _stream_alerts(spark, sf_dir, stream_alerts.parquet_sink(path))
    return stream_alerts.read_alerts(spark, path)


@query
def alert_log_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "alert-log")
    _stream_alerts(spark, sf_dir, stream_alerts.alert_log_sink(path, ALERT_WINDOW, "A"))
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def stream_region_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = work_dir(spark, "windows"), work_dir(spark, "windows-checkpoint")
    stream = live.stream_region_windows(_bounded_cases(spark, sf_dir), delay=STREAM_DELAY, window="1 day", ts="ts")
    finish(live.append_parquet(stream, path, checkpoint, ONCE))
    return spark.read.parquet(path).select("region_id", "date", "total_cases", "positive_cases", F.round("avg_rainfall", 6).alias("avg_rainfall"))


@query
def stream_live_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = work_dir(spark, "totals"), work_dir(spark, "totals-checkpoint")
    finish(live.stream_live_totals(views.cases_stream(spark, sf_dir), path, checkpoint, ONCE))
    return live.latest_totals(spark, path)


LAG_BATCHES = 4


@query
def lag_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag per partition after each batch of a stream over the messages, as its progress events tell.

    The messages come in quarters of the offsets, and a batch takes one quarter.
    """
    path, log, checkpoint = work_dir(spark, "topic"), work_dir(spark, "progress"), work_dir(spark, "lag-checkpoint")
    messages = views.messages(spark, sf_dir).select("partition", "offset")
    quarter = F.col("offset") * LAG_BATCHES / (messages.agg(F.max("offset")).scalar() + 1)
    listener = progress.ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        for _ in _append_parts((messages.where(F.floor(quarter) == n) for n in range(LAG_BATCHES)), path):
            stream = spark.readStream.schema("partition int, offset bigint").parquet(path)
            sink = progress.observe_positions(stream, range(5)).writeStream.format("noop")
            running = sink.option("checkpointLocation", checkpoint).trigger(**ONCE).start()
            finish(running)
            listener.wait_for(running)
    finally:
        spark.streams.removeListener(listener)
    ends = spark.read.schema("partition int, offset bigint").parquet(path).groupBy("partition").agg(F.max("offset").alias("end"))
    return progress.observed_lag(progress.read_progress(spark, log), ends, "cases").drop("query")


@query
def key_locality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of each case in its region's order within slices of a day, as the operator lays the rows out.

    The number of the row in its partition counts; the first one of a slice gives the start.
    """
    ordered = alerts.in_key_order(views.cases(spark, sf_dir), slice_seconds=86400, ts="ts")
    path = work_dir(spark, "ordered")
    ordered.select("region_id", "slice", "case_id", F.monotonically_increasing_id().alias("place")).write.parquet(path)
    laid = spark.read.parquet(path)
    first = laid.groupBy("region_id", "slice").agg(F.min("place").alias("first"))
    place = (F.col("place") - F.col("first") + 1).cast("int").alias("position")
    return laid.join(first, ["region_id", "slice"]).select("region_id", "case_id", place)


# -------------------------------------------------------------------------------- models


@query
def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.category_index(views.cases(spark, sf_dir), "district")


@query
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vector spread over columns; a row without an age stays and has none."""
    cases = views.cases(spark, sf_dir).withColumn(
        "patient_age", F.when(F.col("event_id") % 13 != 0, F.col("patient_age"))
    )
    stages = [models.indexer("region_id", "region_idx"), models.indexer("gender", "gender_idx")]
    for stage in stages:
        cases = stage.fit(cases).transform(cases)
    values = models.assemble(cases, models.CASE_FEATURES).select("case_id", "features")
    values = values.select("case_id", F.when(F.col("features").isNotNull(), vector_to_array("features")).alias("f"))
    return values.select(
        "case_id", *(F.round(F.col("f")[i], 6).alias(name) for i, name in enumerate(models.CASE_FEATURES))
    )


@query
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.with_split(views.cases(spark, sf_dir), F.col("case_id")).select("case_id", "is_train")


TRAINING_ROWS = 20_000  # of the training share, in hash order; the bound for models fitted by queries


def _training_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 17th case lacks a reading."""
    cases = views.cases(spark, sf_dir)
    return models.label_cases(cases.withColumn("humidity", F.when(F.col("event_id") % 17 != 0, F.col("humidity"))))


def _training_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.label_windows(_windows(spark, sf_dir).drop("prediction"))


def _case_model(spark: SparkSession, sf_dir: str):
    rows = models.training_rows(_training_cases(spark, sf_dir), ["case_id"], TRAINING_ROWS)
    return models.train(models.case_pipeline(), rows)


def _window_model(spark: SparkSession, sf_dir: str):
    rows = models.training_rows(_training_windows(spark, sf_dir), ["region_id", "date"], TRAINING_ROWS)
    return models.train(models.outbreak_pipeline(), rows)


def _importance_facts(rows: DataFrame) -> DataFrame:
    """One row per feature, with the sum over all and whether each is a share."""
    total = F.round(F.sum("importance").over(Window.partitionBy("model_name")), 6)
    return rows.select("model_name", "feature_name", total.alias("total"), F.col("importance").between(0, 1).alias("is_share"))


@query
def case_risk_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _importance_facts(models.importance_rows(spark, _case_model(spark, sf_dir), models.CASE_MODEL, models.CASE_FEATURES))


@query
def outbreak_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _importance_facts(models.importance_rows(spark, _window_model(spark, sf_dir), models.OUTBREAK_MODEL, models.OUTBREAK_FEATURES))


def _agrees() -> Column:
    return F.expr("CASE WHEN probability IS NOT NULL THEN (probability > 0.5) = (prediction = 1.0) END").alias("agrees")


@query
def score_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every case, and whether its class agrees with its probability; null where a feature is missing."""
    scored = models.score_cases(_case_model(spark, sf_dir), _training_cases(spark, sf_dir))
    return scored.select("case_id", "region_id", "patient_age", "gender", "label", "is_train", _agrees())


@query
def score_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = models.score_windows(_window_model(spark, sf_dir), _training_windows(spark, sf_dir))
    return scored.select("region_id", "date", "total_cases", "positive_cases", "is_train", _agrees())


@query
def evaluate_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each metric equals what the learning library's own evaluators give for the same rows."""
    path = work_dir(spark, "scored")
    files.write_parquet(models.score_cases(_case_model(spark, sf_dir), _training_cases(spark, sf_dir)), path)
    scored = spark.read.parquet(path)
    rows = scored.where("NOT is_train AND prediction IS NOT NULL")
    classes = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    names = {"f1": "f1", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "accuracy": "accuracy"}
    expected = [(ours, classes.evaluate(rows.drop("probability"), {classes.metricName: theirs})) for ours, theirs in names.items()]
    ranking = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="raw", numBins=0)
    expected.append(("auc", ranking.evaluate(rows.withColumn("raw", array_to_vector(F.expr("array(1 - probability, probability)"))))))
    other = spark.createDataFrame(expected, "metric string, expected double")  # five values
    metrics_ = models.evaluate_model(scored, models.CASE_MODEL)
    return metrics_.join(other, "metric", "full").select("model_name", "metric", (F.abs(F.col("value") - F.col("expected")) < 1e-9).alias("agrees"))


def _same_scores(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Whether two scorings give each row the same probability."""
    pair = before.select(*key, "probability").join(after.select(*key, F.col("probability").alias("again")), key, "full")
    return pair.select(*key, F.col("probability").eqNullSafe(F.col("again")).alias("same"))


@query
def model_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the window model before saving, and after saving over an older model and loading."""
    path, model, rows = work_dir(spark, "outbreak-model"), _window_model(spark, sf_dir), _training_windows(spark, sf_dir)
    for _ in range(2):
        models.save_model(model, path)
    return _same_scores(models.score_windows(model, rows), models.score_windows(models.load_model(path), rows), ["region_id", "date"])


@query
def model_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the case model, saved and loaded."""
    path, model, rows = work_dir(spark, "case-model"), _case_model(spark, sf_dir), _training_cases(spark, sf_dir)
    models.save_model(model, path)
    return _same_scores(models.score_cases(model, rows), models.score_cases(models.load_model(path), rows), ["case_id"])


@query
def run_case_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, and how many rows it left in each of its tables."""
    clean, target = work_dir(spark, "clean"), work_dir(spark, "case-job")
    files.write_parquet(views.cases(spark, sf_dir), clean)
    models.run_case_model(spark, clean, target, TRAINING_ROWS, trees=20)
    return _row_counts(spark, target)


@query
def run_outbreak_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, target = work_dir(spark, "clean"), work_dir(spark, "outbreak-job")
    files.write_parquet(views.cases(spark, sf_dir), clean)
    models.run_outbreak_model(spark, clean, target, "1 day", "ts", TRAINING_ROWS)
    return _row_counts(spark, target)


def _row_counts(spark: SparkSession, target: str) -> DataFrame:
    counts = [
        spark.read.parquet(f"{target}/{name}").agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name in ("predictions", "metrics", "importances")
    ]
    return merge.union_by_name(*counts)
