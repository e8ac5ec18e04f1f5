"""Streams against their batch twins, in several batches, with restarts and late rows."""

import datetime as dt
import json
import pathlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from casebeacon.operators import alerts, metrics
from casebeacon.operators import windows as W
from casebeacon.operators.envelope import dead_letters, decode_messages, good_records
from casebeacon.plans import catalog, views
from casebeacon.sources import files
from casebeacon.streaming import alerts as stream_alerts
from casebeacon.streaming import ingest, live, progress

ONCE = {"availableNow": True}


@pytest.fixture(scope="module", autouse=True)
def few_state_partitions(spark):
    """Each state partition is a task and a store per batch; two are enough here."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


FILES = 4
HOUR = 3600


def in_files(df, path, order):
    """Splits rows into files that are read one after the other, in the given order."""
    numbered = df.withColumn("part", F.ntile(FILES).over(Window.orderBy(order)))
    for part in range(1, FILES + 1):
        numbered.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


@pytest.fixture(scope="module")
def case_files(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cases"))
    df = views.cases(spark, sf_dir).where("event_id < 3000").withColumn("ts", F.col("ts").cast("timestamp"))
    in_files(df, path, "ts")
    return path, spark.read.parquet(path)


@pytest.fixture(scope="module")
def message_files(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("messages"))
    in_files(views.messages(spark, sf_dir).where("offset < 2000"), path, "offset")
    return path, spark.read.parquet(path)


def run(query):
    query.awaitTermination()
    return query


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def batches(query):
    return len([p for p in query.recentProgress if p["numInputRows"] > 0])


def test_alerts_equal_batch_up_to_the_watermark(spark, case_files, run_dir):
    path, df = case_files
    settings = {"window_seconds": 12 * HOUR, "cooldown_seconds": 6 * HOUR, "ts": "ts"}
    sink = stream_alerts.parquet_sink(f"{run_dir}/out")
    query = run(stream_alerts.stream_outbreak_alerts(stream_of(spark, path, df.schema), sink, f"{run_dir}/state", f"{run_dir}/cp", delay="1 hour", trigger=ONCE, **settings))
    assert batches(query) == FILES
    watermark = df.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).first()[0]
    expected = alerts.outbreak_alerts(df, **settings).where(F.col("ts") <= F.lit(watermark))
    got = stream_alerts.read_alerts(spark, f"{run_dir}/out")
    assert rows(got) == rows(expected)
    assert got.count() > 50


def test_alert_state_survives_a_restart(spark, case_files, run_dir):
    """One run over half the files and one over the rest give what a single run gives."""
    path, df = case_files
    settings = {"window_seconds": 12 * HOUR, "cooldown_seconds": 6 * HOUR, "ts": "ts"}
    split = df.agg(F.percentile_approx("ts", 0.5)).first()[0]
    for half in (F.col("ts") <= F.lit(split), F.col("ts") > F.lit(split)):
        df.where(half).coalesce(1).write.mode("append").parquet(f"{run_dir}/in")
        stream, sink = stream_of(spark, f"{run_dir}/in", df.schema), stream_alerts.parquet_sink(f"{run_dir}/out")
        run(stream_alerts.stream_outbreak_alerts(stream, sink, f"{run_dir}/state", f"{run_dir}/cp", delay="1 hour", trigger=ONCE, **settings))
    watermark = df.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).first()[0]
    expected = alerts.outbreak_alerts(df, **settings).where(F.col("ts") <= F.lit(watermark))
    assert rows(stream_alerts.read_alerts(spark, f"{run_dir}/out")) == rows(expected)


def test_a_batch_run_again_gives_the_same(spark, run_dir):
    """State and alerts of a batch depend on the table before it only; cutting moments anywhere changes nothing."""
    moments = spark.range(400_000).selectExpr("'N' AS region_id", "id * 50000 AS at", "1L AS cases", "CAST(id % 3 = 0 AS bigint) AS positives")
    whole, _ = stream_alerts.next_alerts(moments, spark.createDataFrame([], stream_alerts.CARRIED), 60, 200, 30)
    carried, found = spark.createDataFrame([], stream_alerts.CARRIED), []
    for n, (low, high) in enumerate(((0, 7_000_000_000), (7_000_000_000, 7_000_100_000), (7_000_100_000, 10**12))):
        part = moments.where((F.col("at") >= low) & (F.col("at") < high))
        first, _ = stream_alerts.next_alerts(part, carried, 60, 200, 30)
        again, after = stream_alerts.next_alerts(part, carried, 60, 200, 30)
        assert rows(first) == rows(again)
        found += rows(again)
        after.write.parquet(f"{run_dir}/{n}")
        carried = spark.read.schema(stream_alerts.CARRIED).parquet(f"{run_dir}/{n}")
        assert carried.count() <= 60 * 20 // 3 + 3  # a window's positives, an alert, the time released
    assert sorted(found, key=repr) == rows(whole) and len(found) > 600


def test_one_region_is_spread_over_tasks(spark):
    """A backlog of one region: no step before the summaries gives it to one task."""
    moments = spark.range(0, 2_000_000, 1, 8).selectExpr("'N' AS region_id", "id * 50000 AS at", "1L AS cases", "1L AS positives")
    counted = stream_alerts.rolling_moments(moments, window_seconds=60).repartition(4, "region_id", F.expr("at div 600000000"))
    sizes = counted.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1
    kept, _ = stream_alerts.next_alerts(moments, spark.createDataFrame([], stream_alerts.CARRIED), 60, 10, 30)
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in text and "TransformWithState" not in text
    assert kept.count() == -(-(2_000_000 - 9) // 601)


def test_rows_out_of_order_within_the_delay_are_sorted(spark, run_dir):
    start = dt.datetime(2024, 1, 1)
    schema = "region_id string, timestamp timestamp, rapid_test_result string"
    order = [9, 3, 1, 7, 0, 8, 2, 6, 4, 5, 45, 300]
    cases = [("N", start + dt.timedelta(seconds=s), "negative" if s in (45, 300) else "positive") for s in order]
    for i in range(0, len(cases), 4):
        spark.createDataFrame(cases[i : i + 4], schema).coalesce(1).write.mode("append").parquet(f"{run_dir}/in")
    stream = stream_of(spark, f"{run_dir}/in", spark.createDataFrame([], schema).schema)
    sink = stream_alerts.alert_log_sink(f"{run_dir}/log", instance="A")
    run(stream_alerts.stream_outbreak_alerts(stream, sink, f"{run_dir}/state", f"{run_dir}/cp", delay="60 seconds", trigger=ONCE))
    lines = sorted(r["value"] for r in spark.read.text(f"{run_dir}/log").collect())
    assert lines == [
        "2024-01-01 00:00:09 [ALERT] N: 10 positive cases in the last 60s (instance A)",
        "2024-01-01 00:00:45 [ALERT] N: 10 positive cases in the last 60s (instance A)",
    ]


def test_late_rows_are_counted(spark, run_dir):
    schema = "region_id string, timestamp timestamp, rapid_test_result string, rainfall_mm double, humidity double, ambient_temperature double, symptom_count int"
    row = lambda day: ("N", dt.datetime(2024, 1, day), "positive", 1.0, 1.0, 1.0, 1)
    # A batch drops what lies before the watermark of the batch before it.
    for day in (1, 10, 11, 2, 20):
        spark.createDataFrame([row(day)], schema).coalesce(1).write.mode("append").parquet(f"{run_dir}/in")
    stream = stream_of(spark, f"{run_dir}/in", spark.createDataFrame([], schema).schema)
    query = run(
        live.append_parquet(
            live.stream_region_windows(stream, delay="1 hour", window="1 day"), f"{run_dir}/out", f"{run_dir}/cp", ONCE
        )
    )
    days = sorted(r["date"].day for r in spark.read.parquet(f"{run_dir}/out").collect())
    assert days == [1, 10, 11]
    assert sum(r[-1] for r in progress.progress_rows(query.recentProgress)) == 1


def test_region_windows_equal_batch(spark, case_files, run_dir):
    path, df = case_files
    stream = live.stream_region_windows(stream_of(spark, path, df.schema), delay="1 hour", window="1 day", ts="ts")
    run(live.append_parquet(stream, f"{run_dir}/out", f"{run_dir}/cp", ONCE))
    watermark = df.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).first()[0]
    columns = ["region_id", "date", "total_cases", "positive_cases", F.round("avg_rainfall", 6)]
    expected = W.region_window_features(df, "1 day", "ts").where(
        F.col("date") + F.expr("INTERVAL 1 DAY") <= F.lit(watermark)
    )
    assert rows(spark.read.parquet(f"{run_dir}/out").select(*columns)) == rows(expected.select(*columns))


def test_live_totals(spark, case_files, run_dir):
    path, df = case_files
    query = run(live.stream_live_totals(stream_of(spark, path, df.schema), f"{run_dir}/out", f"{run_dir}/cp", ONCE))
    assert batches(query) == FILES
    columns = ["region_id", "total_cases", "positive_cases"]
    latest = live.latest_totals(spark, f"{run_dir}/out")
    assert rows(latest.select(*columns)) == rows(metrics.region_totals(df).select(*columns))
    assert files.numbered_folders(spark, f"{run_dir}/out", "batch_id") == [FILES - 2, FILES - 1]


def test_a_bounded_stream_withholds_nothing(spark, case_files, run_dir):
    path, df = case_files
    cases = live.with_end(stream_of(spark, path, df.schema, 100), f"{run_dir}/end", "ts")
    stream = live.stream_region_windows(cases, delay="1 hour", window="1 day", ts="ts")
    run(live.append_parquet(stream, f"{run_dir}/out", f"{run_dir}/cp", ONCE))
    columns = ["region_id", "date", "total_cases", "positive_cases"]
    assert rows(spark.read.parquet(f"{run_dir}/out").select(*columns)) == rows(W.region_window_features(df, "1 day", "ts").select(*columns))


def expected_ingest(df):
    decoded = decode_messages(df)
    good = good_records(decoded).select("case_id", "region_id", "patient_age")
    return rows(good), rows(dead_letters(decoded))


def ingested(spark, path):
    good = ingest.current_cases(spark, path).select("case_id", "region_id", "patient_age")
    return rows(good), rows(ingest.read_dead_letters(spark, path))


def test_ingest_equals_batch(spark, message_files, run_dir):
    path, df = message_files
    stream = stream_of(spark, path, df.schema)
    query = run(ingest.stream_ingest(stream, f"{run_dir}/out", f"{run_dir}/cp", ONCE))
    assert batches(query) == FILES
    assert ingested(spark, f"{run_dir}/out") == expected_ingest(df)


def test_a_part_of_several_files_is_one_batch_and_is_not_kept_parsed(spark, message_files, run_dir):
    _, df = message_files
    held = []

    def store(write):
        write()
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size())

    parts = [df.where(f"offset % 2 = {n}").repartition(3, "offset") for n in (0, 1)]
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for n, _ in enumerate(catalog._append_parts(parts, f"{run_dir}/in"), 1):
        assert len(list(pathlib.Path(f"{run_dir}/in").glob("*.parquet"))) == 3 * n
        stream = spark.readStream.schema(df.schema).parquet(f"{run_dir}/in")
        run(ingest.stream_ingest(stream, f"{run_dir}/out", f"{run_dir}/cp", ONCE, store=store))
        assert files.numbered_folders(spark, f"{run_dir}/out/cases", "batch_id") == list(range(n))
    assert ingested(spark, f"{run_dir}/out") == expected_ingest(df)
    assert held == [before] * 4


def test_a_compacted_table_and_newer_batches(spark, message_files, run_dir):
    _, df = message_files
    out, columns = f"{run_dir}/out", ["case_id", "region_id", "patient_age"]
    older = df.where("value LIKE '{\"region_id%' OR value LIKE '{\"case_id%'").select(
        "partition", "offset", "key", F.regexp_replace("value", '"patient_age":[0-9]+', '"patient_age":99').alias("value")
    )
    for i, part in enumerate((older, df.where("offset % 2 = 0"), df.where("offset % 2 = 1"))):
        part.coalesce(1).write.mode("append").parquet(f"{run_dir}/in")
        run(ingest.stream_ingest(stream_of(spark, f"{run_dir}/in", df.schema), out, f"{run_dir}/cp", ONCE))
        if i == 1:
            assert ingest.compact_cases(spark, out) == ingest.compact_cases(spark, out) == 1
            files.remove(spark, f"{out}/cases/batch_id=0")  # not needed any more
    assert rows(ingest.current_cases(spark, out).select(*columns)) == expected_ingest(df)[0]


def test_a_compacted_table_without_rows_hides_nothing(spark, message_files, run_dir):
    _, df = message_files
    bad, good = spark.createDataFrame([(0, 1, "k", "{")], df.schema), df.where("offset = 1")
    for part in (bad, good):
        part.coalesce(1).write.mode("append").parquet(f"{run_dir}/in")
        run(ingest.stream_ingest(stream_of(spark, f"{run_dir}/in", df.schema), f"{run_dir}/out", f"{run_dir}/cp", ONCE))
        assert ingest.current_cases(spark, f"{run_dir}/out").count() == (part is good)
        ingest.compact_cases(spark, f"{run_dir}/out")
    assert ingest.current_cases(spark, f"{run_dir}/out").count() == 1


def test_another_checkpoint_is_refused(spark, message_files, run_dir):
    path, df = message_files
    run(ingest.stream_ingest(stream_of(spark, path, df.schema), f"{run_dir}/out", f"{run_dir}/cp", ONCE))
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest.stream_ingest(stream_of(spark, path, df.schema), f"{run_dir}/out", f"{run_dir}/other", ONCE)
    assert ingested(spark, f"{run_dir}/out") == expected_ingest(df)


@pytest.mark.parametrize("per_batch", [1, 2])
def test_batch_cuts_do_not_matter(spark, message_files, run_dir, per_batch):
    """A (10:00, age 11) and then B (09:00, age 22) of one case: B in either way."""
    _, df = message_files
    record = json.loads(df.where("offset = 1").first()["value"])
    for i, (time, age) in enumerate((("2024-01-01T10:00:00", 11), ("2024-01-01T09:00:00", 22))):
        row = [(0, i, "k", json.dumps({**record, "timestamp": time, "patient_age": age}))]
        spark.createDataFrame(row, df.schema).coalesce(1).write.mode("append").parquet(f"{run_dir}/in")
    run(ingest.stream_ingest(stream_of(spark, f"{run_dir}/in", df.schema, per_batch), f"{run_dir}/out", f"{run_dir}/cp", ONCE))
    assert [r["patient_age"] for r in ingest.current_cases(spark, f"{run_dir}/out").collect()] == [22]


def test_a_crash_loses_and_doubles_nothing(spark, message_files, run_dir):
    """The query dies between the two writes of its third batch and is started again."""
    path, df = message_files
    write = ingest.batch_writer(f"{run_dir}/out", f"{run_dir}/cp")

    def dying(batch, batch_id):
        if batch_id == 2:
            good_records(decode_messages(batch)).limit(3).write.mode("overwrite").parquet(
                f"{run_dir}/out/cases/batch_id=2"
            )
            raise RuntimeError("lost")
        write(batch, batch_id)

    query = (
        stream_of(spark, path, df.schema)
        .writeStream.foreachBatch(dying)
        .option("checkpointLocation", f"{run_dir}/cp")
        .trigger(**ONCE)
        .start()
    )
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    run(ingest.stream_ingest(stream_of(spark, path, df.schema), f"{run_dir}/out", f"{run_dir}/cp", ONCE))
    assert ingested(spark, f"{run_dir}/out") == expected_ingest(df)


def test_the_last_arrival_of_a_case_wins(spark, message_files, run_dir):
    _, df = message_files
    first = df.where("offset = 1").first()
    record = json.loads(first["value"])
    for age in (11, 12):
        row = [(0, age, "k", json.dumps({**record, "patient_age": age}))]
        spark.createDataFrame(row, df.schema).coalesce(1).write.mode("append").parquet(f"{run_dir}/in")
    run(ingest.stream_ingest(stream_of(spark, f"{run_dir}/in", df.schema), f"{run_dir}/out", f"{run_dir}/cp", ONCE))
    assert [r["patient_age"] for r in ingest.current_cases(spark, f"{run_dir}/out").collect()] == [12]


def test_retries_pause_longer_and_then_give_up():
    pauses, calls = [], []

    def fails_twice():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")

    ingest.with_retries(fails_twice, 3, pauses.append)
    assert pauses == [1, 2] and len(calls) == 3
    with pytest.raises(AnalysisException):
        ingest.with_retries(lambda: (_ for _ in ()).throw(AnalysisException("no such column")), 3, pauses.append)
    assert pauses == [1, 2]
    with pytest.raises(OSError):
        ingest.with_retries(lambda: (_ for _ in ()).throw(OSError("down")), 3, pauses.append)
    assert pauses == [1, 2, 1, 2]


def test_lag_per_partition(spark):
    report = {
        "id": "q",
        "batchId": 3,
        "stateOperators": [{"numRowsDroppedByWatermark": 2}],
        "sources": [
            {
                "description": "KafkaV2[Subscribe[cases]]",
                "endOffset": {"cases": {"0": 10, "1": 7}},
                "latestOffset": {"cases": {"0": 15, "1": 7}},
                "numInputRows": 17,
                "processedRowsPerSecond": 5.0,
            }
        ],
    }
    frame = progress.progress_frame(spark, [json.dumps(report)])
    assert frame.first()["late_rows"] == 2
    lags = {(r["topic"], r["partition"]): (r["position"], r["end"], r["lag"]) for r in progress.lag_report(frame).collect()}
    assert lags == {("cases", 0): (10, 15, 5), ("cases", 1): (7, 7, 0)}


def test_progress_log(spark, case_files, run_dir):
    path, df = case_files
    log = progress.ProgressLog(spark, f"{run_dir}/progress")
    spark.streams.addListener(log)
    try:
        stream = stream_of(spark, path, df.schema).select("event_id")
        run(live.append_parquet(stream, f"{run_dir}/out", f"{run_dir}/cp", ONCE))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    assert spark.read.json(f"{run_dir}/progress").agg(F.sum("input_rows")).first()[0] == df.count()


def test_observed_positions_of_a_running_stream(spark, run_dir):
    """One event per batch, of a partition without rows in a batch too."""
    for batch in ([(0, 3), (1, 5)], [(1, 9)], [(0, 4), (0, 12)]):
        spark.createDataFrame(batch, "partition int, offset bigint").coalesce(1).write.mode("append").parquet(f"{run_dir}/in")
    log = progress.ProgressLog(spark, f"{run_dir}/log")
    spark.streams.addListener(log)
    stream = progress.observe_positions(stream_of(spark, f"{run_dir}/in", "partition int, offset bigint"), range(3))
    query = run(stream.writeStream.format("noop").option("checkpointLocation", f"{run_dir}/cp").trigger(**ONCE).start())
    log.wait_for(query)
    spark.streams.removeListener(log)
    ends = spark.createDataFrame([(0, 12), (1, 9), (2, 1)], "partition int, end bigint")
    lag = progress.observed_lag(progress.read_progress(spark, f"{run_dir}/log"), ends, "t")
    assert sorted((r.batch_id, r.partition, r.position, r.lag) for r in lag.collect()) == [
        (0, 0, 3, 9), (0, 1, 5, 4), (0, 2, -1, 2), (1, 0, 3, 9), (1, 1, 9, 0), (1, 2, -1, 2), (2, 0, 12, 0), (2, 1, 9, 0), (2, 2, -1, 2),
    ]
