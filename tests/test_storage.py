"""Reads and writes that touch only the part of a stored table that they need."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from casebeacon.operators import windows as W
from casebeacon.plans import etl, newest
from casebeacon.sources import files

CASES = "case_id string, ts timestamp, region_id string, rapid_test_result string"


def days(spark, path, n=40, per_day=3):
    rows = spark.range(n * per_day).selectExpr(
        "concat('C', id) AS case_id", f"timestamp_seconds(1700000000 + (id % {n}) * 86400 + id) AS ts", "'r' AS region_id", "'positive' AS rapid_test_result"
    )
    files.write_parquet(rows.withColumn("event_date", F.to_date("ts")), path, ["event_date"])
    return rows


def test_only_the_newest_days_are_scanned(spark, run_dir):
    rows = days(spark, run_dir)
    for got, want in (
        (newest.recent_stored_cases(spark, run_dir, "ts", 7), rows.orderBy(F.col("ts").desc(), "case_id").limit(7)),
        (newest.recent_stored_cases(spark, run_dir, "ts", 1000), rows),
    ):
        assert sorted(r.case_id for r in got.collect()) == sorted(r.case_id for r in want.collect())
    assert len(newest.recent_stored_cases(spark, run_dir, "ts", 7).inputFiles()) == len(files.read_parquet(spark, run_dir).inputFiles())
    scanned = newest.recent_stored_cases(spark, run_dir, "ts", 7).select(F.input_file_name().alias("f")).distinct().count()
    assert scanned <= 4
    plan = newest.last_stored_buckets(spark, run_dir, "ts", 4)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert newest.last_stored_buckets(spark, run_dir, "ts", 4).count() == 4


def clean(spark, rows):
    whole = {"region_id": "r", "district": "d", "patient_age": 5, "gender": "M", "rapid_test_result": "Positive", "symptoms": ["cough"]}
    shape = "case_id string, timestamp string, region_id string, district string, patient_age int, gender string, rapid_test_result string, symptoms array<string>"
    return spark.createDataFrame([(i, t, *(whole | more).values()) for i, t, more in rows], shape)


def stamps(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("event_date=")}


def test_a_new_day_rewrites_that_day_only(spark, run_dir):
    table = f"{run_dir}/clean"
    first = [(f"a{i}", f"2024-01-0{1 + i % 3}T10:00:0{i}", {}) for i in range(9)]
    etl.add_to_clean(clean(spark, first), table)
    before = stamps(table)
    fresh = [("b1", "2024-01-04T09:00:00", {}), ("b2", "2024-01-04T09:00:01", {}), ("b2", "2024-01-04T08:00:00", {"patient_age": 6})]
    assert etl.add_to_clean(clean(spark, fresh), table) == {"written": 2, "days": 1}
    after = stamps(table)
    assert {d: f for d, f in after.items() if d in before} == before and len(after) == 4
    # A late copy moves its case to another day; an older one changes nothing but is looked at.
    late = [("a0", "2024-01-05T00:00:00", {"rapid_test_result": "negative"}), ("a1", "2023-12-31T00:00:00", {})]
    etl.add_to_clean(clean(spark, late), table)
    assert stamps(table)["event_date=2024-01-03"] == before["event_date=2024-01-03"] and "event_date=2023-12-31" not in stamps(table)
    for _ in range(2):  # the same files again change nothing
        got = files.read_parquet(spark, table).select("case_id", F.col("timestamp").cast("string"), "rapid_test_result", "symptom_count")
        want = etl.cleaning.clean_cases(clean(spark, first + fresh + late)).select(got.columns[0], F.col("timestamp").cast("string"), *got.columns[2:])
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        etl.add_to_clean(clean(spark, late), table)


def test_an_emptied_day_is_removed(spark, run_dir):
    table = f"{run_dir}/clean"
    etl.add_to_clean(clean(spark, [("a", "2024-01-01T00:00:00", {}), ("b", "2024-01-02T00:00:00", {})]), table)
    etl.add_to_clean(clean(spark, [("a", "2024-01-03T00:00:00", {})]), table)
    assert files.partition_values(spark, table, "event_date") == ["2024-01-03", "2024-01-02"]
    etl.add_to_clean(clean(spark, []), table)
    assert files.read_parquet(spark, table).count() == 2


def test_the_schema_comes_from_all_files(spark, run_dir):
    lots = [
        [{"id": "a", "n": 1, "inner": {"x": 1}}, {"id": "b", "n": None}],
        [{"id": "c", "n": 2.5, "late": [1, 2], "inner": {"y": "z"}}, {"id": "d", "odd": 1}],
        [{"id": "e", "odd": "text"}],
    ]
    for i, lot in enumerate(lots):
        with open(f"{run_dir}/{i}.json", "w") as out:
            out.write("\n".join([*map(json.dumps, lot), *(["{broken", "7"] if i == 1 else [])]))
    read = files.read_inferred_json(spark, run_dir)
    types = {f.name: f.dataType.simpleString() for f in read.schema}
    assert types == {"id": "string", "n": "double", "inner": "struct<x:bigint,y:string>", "late": "array<bigint>", "odd": "string", "_unreadable": "string"}
    rows = {r.id: r for r in read.collect()}
    assert (rows["a"].n, rows["c"].n, rows["c"].late, rows["d"].odd, rows["e"].odd) == (1.0, 2.5, [1, 2], "1", "text")
    assert read.cache().where("_unreadable is not null").count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_radix_selection_of_any_whole_numbers(spark, seed):
    rng = random.Random(seed)
    spread = [(-(2**63), 2**63 - 1), (-5, 5), (2**40, 2**40 + 9), (-(2**33), 2**33)][seed]
    values = [rng.randint(*spread) for _ in range(400)] + [None, *spread]
    known = sorted(v for v in values if v is not None)
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    for q in (0.0, 0.25, 0.75, 1.0):
        assert W.threshold_lower_quantile(frame, q, "v").first()[0] == known[int(q * (len(known) - 1))]
    plan = W.threshold_lower_quantile(frame, 0.75, "v")._jdf.queryExecution().toString()
    assert "Window" not in plan
    assert W.threshold_lower_quantile(frame.where("false"), 0.75, "v").collect() == [(None,)]


def test_merged_sketches_keep_their_rank(spark):
    rows = spark.range(300_000).selectExpr("date_add(DATE'2024-01-01', CAST(id % 90 AS INT)) AS date", "CAST(pow(id % 9973, 2) AS BIGINT) AS positive_cases")
    sketches = W.threshold_sketches(rows)
    for since, until in (("2024-01-01", "2024-03-30"), ("2024-02-03", "2024-02-09")):
        part = rows.where(F.col("date").between(since, until))
        n, value = W.threshold_of_days(sketches.where(F.col("day").between(since, until))).first()
        assert n == part.count()
        below, upto = part.where(F.col("positive_cases") < value).count(), part.where(F.col("positive_cases") <= value).count()
        assert below / n <= 0.76 and upto / n >= 0.74
    assert W.threshold_of_days(sketches.where("false")).collect() == []
