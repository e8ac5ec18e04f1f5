"""The incremental dashboard against a full scan, batch by batch."""

import random

from pyspark.sql import functions as F

from casebeacon.plans import rollups, snapshots

SCHEMA = "case_id string, ts timestamp, region_id string, district string, patient_age int, gender string, rapid_test_result string, rainfall_mm double"


def case(rng, name):
    when = None if rng.random() < 0.03 else f"2024-01-{rng.randrange(1, 4):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}"
    return (name, when, rng.choice(["N", "S", None]), "d", rng.randrange(-1, 160), rng.choice("MFX"), rng.choice(["positive", "negative"]), rng.random() * 30)


def frame(spark, rows):
    return spark.createDataFrame([r[:1] + r[2:] + (r[1],) for r in rows], "case_id string, region_id string, district string, patient_age int, gender string, rapid_test_result string, rainfall_mm double, at string").select(
        "case_id", F.to_timestamp("at").alias("ts"), "region_id", "district", "patient_age", "gender", "rapid_test_result", "rainfall_mm"
    )


def document(df):
    return snapshots.as_json(df).first()[0]


def test_every_batch_equals_a_full_scan(spark, run_dir, monkeypatch):
    monkeypatch.setattr(rollups, "KEEP", 30)  # deletions soon use the list up
    rng, table = random.Random(3), {}
    for batch in range(4):
        gone = rng.sample(sorted(table), min(len(table), 60))
        newest = sorted((n for n in table if table[n][1]), key=lambda n: table[n][1])[-25:] if batch == 2 else []
        gone = sorted({*gone, *newest})
        new = [case(rng, n) for n in gone[: len(gone) // 2]] + [case(rng, f"C{batch}-{i}") for i in range(80)]
        removed = [table.pop(n) for n in gone]
        table |= {r[0]: r for r in new}
        now = frame(spark, list(table.values()))
        rollups.add_batch(run_dir, batch, frame(spark, new), frame(spark, removed) if removed else None, now, "ts")
        if batch == 3:  # run again
            rollups.add_batch(run_dir, batch, frame(spark, new), frame(spark, removed), now, "ts")
        got = rollups.dashboard(spark, run_dir, now, "ts")
        assert document(got) == document(snapshots.dashboard_snapshot(now, "ts"))
        if batch in (0, 2):
            assert rollups.sum_up(spark, run_dir) == batch
            assert document(rollups.dashboard(spark, run_dir, now, "ts")) == document(snapshots.dashboard_snapshot(now, "ts"))


def test_a_poll_reads_sums_and_newer_batches_only(spark, run_dir):
    rng = random.Random(4)
    rows = [frame(spark, [case(rng, f"C{b}-{i}") for i in range(30)]) for b in range(4)]
    for b, added in enumerate(rows):
        rollups.add_batch(run_dir, b, added, None, added, "ts")
        if b in (0, 2):
            rollups.sum_up(spark, run_dir)
    files = rollups.numbers(spark, run_dir).inputFiles()
    assert {f.rsplit("/", 2)[1] for f in files} == {"upto=2", "batch_id=3"}
    plan = rollups.dashboard(spark, run_dir, rows[0], "ts")._jdf.queryExecution().optimizedPlan().toString()
    assert "ExistingRDD" not in plan and "LogicalRDD" not in plan


def test_no_batches(spark, run_dir):
    empty = frame(spark, [])
    assert document(rollups.dashboard(spark, run_dir, empty, "ts")) == document(snapshots.dashboard_snapshot(empty, "ts"))
