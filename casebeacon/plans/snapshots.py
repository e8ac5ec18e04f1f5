"""The two dashboard documents, each as one row of nested columns.

Sections that need the same rows are computed from one small shared aggregate, so the case
table is read three times (breakdowns, time line, newest cases) and each read takes only
its own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebeacon.functions import expressions as X
from casebeacon.operators import evaluation, histograms, metrics
from casebeacon.operators import windows as W


def _pick(rows: Column | str, field: str) -> Column:
    return F.transform(rows, lambda r: r[field])


def _ordered(rows: Column) -> Column:
    """Structs whose first field is `rank`, sorted."""
    return F.sort_array(F.collect_list(rows))


def breakdowns(cases: DataFrame) -> DataFrame:
    """Totals and the region, gender, age and rainfall sections from one scan.

    The scan is reduced to one row per region and gender; everything else is added up from
    those rows.
    """
    sums = {name: F.count_if(member) for name, member in counted().items()}
    return breakdowns_of(cases.groupBy("region_id", "gender").agg(*(v.alias(k) for k, v in sums.items())))


def counted() -> dict[str, Column]:
    """What the sections count: the name of each number and the cases that it counts."""
    conditions = {"total": F.lit(True), "positive": X.is_positive()}
    for prefix, members in (("age", histograms.age_members()), ("rain", histograms.rain_members())):
        for i, member in enumerate(members):
            conditions[f"{prefix}{i}_total"] = member
            conditions[f"{prefix}{i}_positive"] = member & X.is_positive()
    return conditions


def breakdowns_of(cube: DataFrame) -> DataFrame:
    """The sections of `breakdowns` from the numbers of `counted` per region and gender."""
    regrouped = cube.groupingSets(
        [["region_id"], ["gender"], []], "region_id", "gender"
    ).agg(F.grouping_id().alias("gid"), *(F.sum(k).alias(k) for k in counted()))
    by_region, by_gender, overall = F.col("gid") == 1, F.col("gid") == 2, F.col("gid") == 3

    def bins(prefix: str, labels: list[str]) -> Column:
        value = lambda name: F.coalesce(F.max(F.when(overall, F.col(name))), F.lit(0))
        return F.array(
            *(
                F.struct(
                    F.lit(label).alias("label"),
                    value(f"{prefix}{i}_total").alias("total"),
                    value(f"{prefix}{i}_positive").alias("positive"),
                )
                for i, label in enumerate(labels)
            )
        )

    region = F.struct(
        (-F.col("total")).alias("rank"),
        "region_id",
        F.col("total").alias("total_cases"),
        F.col("positive").alias("positive_cases"),
        X.safe_rate("positive", "total", 1).alias("positivity"),
    )
    gender = F.struct(
        (-F.col("total")).alias("rank"),
        F.col("gender").alias("code"),
        X.gender_display().alias("label"),
        F.col("total").alias("n"),
    )
    return regrouped.agg(
        F.coalesce(F.max(F.when(overall, F.col("total"))), F.lit(0)).alias("total_cases"),
        F.coalesce(F.max(F.when(overall, F.col("positive"))), F.lit(0)).alias("total_positive"),
        _ordered(F.when(by_region, region)).alias("regions"),
        _ordered(F.when(by_gender, gender)).alias("genders"),
        bins("age", histograms.age_labels()).alias("ages"),
        bins("rain", histograms.rain_labels()).alias("rains"),
    )


def recent_list(cases: DataFrame, ts: str, n: int) -> DataFrame:
    """The newest cases as one array, newest first; at most ``n`` rows are collected."""
    newest = metrics.recent_cases(cases, ts, n)
    age = -F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-(2**62)))
    rows = newest.select(
        F.struct(
            age.alias("rank"),
            F.col("case_id").alias("tie"),
            F.struct(*metrics.view_columns(ts, None)).alias("view"),
        ).alias("row")
    )
    return rows.agg(_pick(F.sort_array(F.collect_list("row")), "view").alias("recent"))


def timeline_list(cases: DataFrame, ts: str, n: int) -> DataFrame:
    """The newest time buckets as one array, oldest first; at most ``n`` rows are collected."""
    return timeline_of(metrics.cases_per_minute(cases, ts), n)


def timeline_of(per_minute: DataFrame, n: int) -> DataFrame:
    buckets = metrics.last_buckets(per_minute, n)
    rows = buckets.select(F.struct("bucket", "label", "total", "positive").alias("row"))
    return rows.agg(F.sort_array(F.collect_list("row")).alias("buckets"))


def dashboard_snapshot(
    cases: DataFrame, ts: str = "timestamp", recent: int = 20, buckets: int = 30
) -> DataFrame:
    """Totals, region table, newest cases and chart arrays in one row."""
    return dashboard_of(breakdowns(cases), recent_list(cases, ts, recent), timeline_list(cases, ts, buckets))


def dashboard_of(sections: DataFrame, recent: DataFrame, timeline: DataFrame) -> DataFrame:
    """The document from its three parts, each of one row."""
    parts = sections.select("*", recent.scalar().alias("recent_cases"), timeline.scalar().alias("timeline"))
    charts = F.struct(
        _pick("regions", "region_id").alias("region_labels"),
        _pick("regions", "total_cases").alias("region_totals"),
        _pick("regions", "positive_cases").alias("region_positives"),
        F.array("total_positive", F.col("total_cases") - F.col("total_positive")).alias("pie"),
        _pick("regions", "positivity").alias("positivity"),
        _pick("timeline", "label").alias("timeline_labels"),
        _pick("timeline", "total").alias("timeline_total"),
        _pick("timeline", "positive").alias("timeline_positive"),
        _pick("ages", "label").alias("age_labels"),
        _pick("ages", "total").alias("age_total"),
        _pick("ages", "positive").alias("age_pos"),
        _pick("rains", "label").alias("rain_labels"),
        F.transform("rains", lambda r: X.safe_rate(r["positive"], r["total"], 1)).alias("rain_rate"),
        _pick("genders", "label").alias("gender_labels"),
        _pick("genders", "n").alias("gender_values"),
    )
    region_table = F.transform(
        "regions",
        lambda r: F.struct(
            r["region_id"].alias("region_id"),
            r["total_cases"].alias("total_cases"),
            r["positive_cases"].alias("positive_cases"),
        ),
    )
    return parts.select(
        "total_cases",
        "total_positive",
        F.size("regions").alias("region_count"),
        region_table.alias("region_summary"),
        "recent_cases",
        charts.alias("charts"),
    )


def _window_sections(windows: DataFrame) -> DataFrame:
    """Per-region status and latest window in one aggregate, then one row."""
    latest = F.max(F.struct("date", "total_cases", "positive_cases", "prediction"))
    per_region = windows.groupBy("region_id").agg(
        latest.alias("latest"),
        F.count("*").alias("n"),
        F.count_if(F.col("prediction") == 1.0).alias("flagged"),
        F.count_if(F.col("prediction") > 0.5).alias("outbreak"),
        F.count_if(F.col("prediction") <= 0.5).alias("stable"),
    )
    row = F.struct(F.col("region_id").alias("rank"), "region_id", "latest", "outbreak", "stable")
    return per_region.agg(
        _ordered(row).alias("regions"),
        F.coalesce(F.sum("flagged"), F.lit(0)).alias("n_outbreak"),
        F.coalesce(F.sum(F.col("n") - F.col("flagged")), F.lit(0)).alias("n_stable"),
    )


def _timeline_datasets(windows: DataFrame, n: int) -> DataFrame:
    """One series per region over the last ``n`` dates, with gaps as nulls."""
    per_region = (
        W.region_date_grid(windows, n)
        .groupBy("region_id")
        .agg(F.sort_array(F.collect_list(F.struct("date", "positive_cases", "flagged"))).alias("points"))
    )
    series = F.struct(
        F.col("region_id").alias("label"),
        _pick("points", "positive_cases").alias("data"),
        _pick("points", "flagged").alias("flagged"),
    )
    return per_region.agg(F.sort_array(F.collect_list(series)).alias("datasets"))


def _histogram_section(windows: DataFrame) -> DataFrame:
    threshold = W.threshold_lower_quantile(windows)
    bins = histograms.window_histogram(windows, threshold)
    return bins.agg(
        F.sort_array(F.collect_list(F.struct("low", "label", "windows", "above_threshold"))).alias("bins")
    )


def _case_sections(scored: DataFrame) -> DataFrame:
    """Risk per region and the confusion counts from one scan of the scored cases."""
    actual, predicted = F.col("label"), F.col("prediction")
    cells = {
        "tp": (actual > 0.5) & (predicted > 0.5),
        "tn": (actual <= 0.5) & (predicted <= 0.5),
        "fp": (actual <= 0.5) & (predicted > 0.5),
        "fn": (actual > 0.5) & (predicted <= 0.5),
    }
    per_region = scored.groupBy("region_id").agg(
        F.avg("prediction").alias("avg_risk"), *(F.count_if(c).alias(k) for k, c in cells.items())
    )
    row = F.struct(
        F.coalesce(-F.col("avg_risk"), F.lit(float("inf"))).alias("rank"), "region_id", "avg_risk"
    )
    return per_region.agg(
        _ordered(row).alias("risks"), *(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in cells)
    )


def _importance_section(importances: DataFrame) -> DataFrame:
    """One row per feature of two small models."""
    row = F.struct((-F.col("importance")).alias("rank"), "feature_name", "importance")
    of = lambda model: F.collect_list(F.when(F.col("model_name") == model, row))
    return importances.agg(
        F.struct(F.sort_array(of("case_risk")).alias("case"), F.sort_array(of("outbreak")).alias("outbreak"))
    )


def analytics_snapshot(
    windows: DataFrame, scored: DataFrame, importances: DataFrame, dates: int = 30, training: DataFrame | None = None
) -> DataFrame:
    """Window status, series, histogram, case risk, model quality and importances in one row.

    ``windows`` is read by several sections and should be a stored table. ``training`` has the metrics
    of the model jobs (model_name, metric, value); with it the document lists them. The
    sections hold one entry per region, so the number of regions is taken to fit one row (tens of thousands at most).
    """
    cases = _case_sections(scored)
    last = W.last_dates(windows, dates).agg(F.sort_array(F.collect_list("date")).alias("dates"))
    parts = _window_sections(windows).select(
        "*",
        last.scalar().alias("dates"),
        _timeline_datasets(windows, dates).scalar().alias("datasets"),
        _histogram_section(windows).scalar().alias("bins"),
        W.threshold_lower_quantile(windows).scalar().alias("threshold"),
        cases.select(F.struct("risks", "tp", "tn", "fp", "fn")).scalar().alias("cases"),
        _importance_section(importances).scalar().alias("importances"),
    )
    quality = evaluation.binary_columns(*(F.col(f"cases.{c}") for c in ("tp", "tn", "fp", "fn")))
    percent = lambda rows: F.transform(rows, lambda r: F.round(r["importance"] * 100, 1))
    charts = F.struct(
        _pick("regions", "region_id").alias("latest_labels"),
        F.transform("regions", lambda r: r["latest"]["total_cases"]).alias("latest_totals"),
        F.transform("regions", lambda r: r["latest"]["positive_cases"]).alias("latest_positives"),
        F.array("n_outbreak", "n_stable").alias("status"),
        _pick("regions", "region_id").alias("stack_labels"),
        _pick("regions", "outbreak").alias("stack_outbreak"),
        _pick("regions", "stable").alias("stack_stable"),
        F.transform("dates", lambda d: F.date_format(d, "HH:mm")).alias("timeline_labels"),
        F.coalesce("datasets", F.array()).alias("timeline_datasets"),
        _pick("bins", "label").alias("hist_labels"),
        _pick("bins", "windows").alias("hist_counts"),
        _pick("bins", "above_threshold").alias("hist_flagged"),
        "threshold",
        _pick("cases.risks", "region_id").alias("risk_labels"),
        F.transform("cases.risks", lambda r: F.coalesce(F.round(r["avg_risk"], 3), F.lit(0.0))).alias("risk_values"),
        _pick("importances.case", "feature_name").alias("fi_case_labels"),
        percent("importances.case").alias("fi_case_values"),
        _pick("importances.outbreak", "feature_name").alias("fi_out_labels"),
        percent("importances.outbreak").alias("fi_out_values"),
    )
    at_risk = F.filter("regions", lambda r: r["latest"]["prediction"].eqNullSafe(1.0))
    return parts.select(
        charts.alias("charts"),
        F.size(at_risk).alias("at_risk_count"),
        F.transform(at_risk, lambda r: r["region_id"]).alias("at_risk_regions"),
        F.struct(*(value.alias(name) for name, value in quality.items())).alias("metrics_case"),
        F.struct("cases.tp", "cases.tn", "cases.fp", "cases.fn").alias("cm"),
        *([] if training is None else [_training_section(training).scalar().alias("training")]),
    )


def _training_section(training: DataFrame) -> DataFrame:
    """A handful of metrics per model, in order."""
    return training.agg(F.sort_array(F.collect_list(F.struct("model_name", "metric", "value"))))


def as_json(snapshot: DataFrame) -> DataFrame:
    """The document as JSON text, nulls included."""
    return snapshot.select(
        F.to_json(F.struct(*snapshot.columns), {"ignoreNullFields": "false"}).alias("document")
    )
