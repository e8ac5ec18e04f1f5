"""What Spark makes of the operators: scans, shuffles, joins."""

import re

import pytest
from pyspark.sql import functions as F

from casebeacon.operators import alerts, evaluation, metrics
from casebeacon.operators import windows as W
from casebeacon.plans import catalog, snapshots, views

# Streams, models and file round trips run while their DataFrame is built.
BUILT_EAGERLY = {
    "alert_log_sink", "analytics_snapshot", "assemble_features", "at_least_once_commit", "case_risk_model", "category_index", "dashboard_rollups", "dead_letter_sink",
    "evaluate_model", "key_locality", "lag_report", "model_load", "model_save", "outbreak_model",
    "read_raw_json", "retry_then_dead_letter", "run_case_model", "run_outbreak_model", "score_cases", "score_windows", "stream_ingest",
    "stream_live_totals", "stream_outbreak_alerts", "stream_region_windows", "sync_predictions", "upsert_stored_cases",
    "write_parquet_overwrite",
}


def plan(df):
    """The final adaptive plan after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def scans(text, table="events"):
    return re.findall(rf"FileScan parquet \[([^\]]*)\].*?{table}\.parquet", text)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - BUILT_EAGERLY))
def test_no_cross_joins(spark, sf_dir, name):
    text = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_a_summary_reads_only_its_columns(spark, sf_dir):
    text = plan(metrics.region_summary(views.cases(spark, sf_dir)))
    (columns,) = scans(text)
    assert {c.split("#")[0] for c in columns.split(",")} == {"user_id", "event_type"}


def test_filters_reach_the_scan(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    text = plan(events.where(F.col("event_type") == "error").select("event_id"))
    assert "EqualTo(event_type,error)" in text


def test_the_case_table_is_read_three_times_for_the_dashboard(spark, sf_dir):
    document = snapshots.dashboard_snapshot(views.cases(spark, sf_dir), "ts")
    document.collect()
    # Subqueries print their initial plan too, with the same column numbers.
    text = document._jdf.queryExecution().executedPlan().toString()
    columns = [{c.split("#")[0] for c in s.split(",")} for s in set(scans(text))]
    assert sorted(map(sorted, columns)) == [
        ["event_id", "event_type", "ts", "user_id"],
        ["event_id", "event_type", "user_id", "value"],
        ["event_type", "ts", "user_id"],
    ]
    assert "TakeOrderedAndProject" in text


def test_alerts_read_the_cases_once(spark, sf_dir):
    text = plan(
        alerts.outbreak_alerts(views.cases(spark, sf_dir), window_seconds=43200, cooldown_seconds=21600, ts="ts")
    )
    assert len(scans(text)) == 1
    assert text.count("ReusedExchange") >= 3


def test_climate_correlation_is_one_pass(spark, sf_dir):
    assert len(scans(plan(metrics.climate_correlation(views.cases(spark, sf_dir))))) == 1


def test_windows_without_a_key_see_few_rows(spark, sf_dir):
    """Running sums over everything follow an aggregation to at most 65,536 blocks."""
    text = plan(evaluation.auc(views.scored(spark, sf_dir).withColumn("score", F.col("prediction"))))
    assert len(scans(text)) == 1
    text = plan(W.threshold_lower_quantile(views.windows(spark, sf_dir)))
    assert text.count("FileScan") <= 4
