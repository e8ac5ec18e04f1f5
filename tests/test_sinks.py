"""JDBC calls (recorded, as no database may run here), files and working folders."""

import pytest
from pyspark.sql import functions as F

from casebeacon import session
from casebeacon.schemas import CASE_PREDICTIONS, FEATURE_IMPORTANCE, OUTBREAK_PREDICTIONS
from casebeacon.sources import files, jdbc, kafka

TARGET = jdbc.JdbcTarget("jdbc:x:y", "u", "p")


@pytest.fixture
def written(monkeypatch):
    """Keeps what would be written: mode, options and rows by table."""
    from pyspark.sql import DataFrameWriter

    calls = []

    def option(self, key, value):
        self.__dict__.setdefault("seen", {})[key] = value
        return original_option(self, key, value)

    def mode(self, value):
        self.seen_mode = value
        return original_mode(self, value)

    def write(self, url, table, mode=None, properties=None):
        calls.append((self.seen_mode, getattr(self, "seen", {}), url, table, properties, self._df))

    original_option, original_mode = DataFrameWriter.option, DataFrameWriter.mode
    monkeypatch.setattr(DataFrameWriter, "option", option)
    monkeypatch.setattr(DataFrameWriter, "mode", mode)
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    return calls


def test_overwrite_keeps_the_declared_table(spark, written):
    jdbc.overwrite_table(spark.range(3), TARGET, "t")
    mode, options, url, table, properties, df = written[0]
    assert (mode, options, url, table) == ("overwrite", {"truncate": True}, "jdbc:x:y", "t")
    assert properties == {"user": "u", "password": "p"} and df.count() == 3


def test_append(spark, written):
    jdbc.append_table(spark.range(2), TARGET, "t")
    assert written[0][0] == "append" and written[0][3] == "t"


def test_ranges_split_a_read(spark, monkeypatch):
    from pyspark.sql import DataFrameReader

    calls = []
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, *a, **k: calls.append((a, k)))
    jdbc.read_table(spark, TARGET, "t")
    jdbc.read_table(spark, TARGET, "t", jdbc.Ranges("id", 0, 100, 4))
    assert calls[0] == (("jdbc:x:y", "t"), {"properties": TARGET.properties()})
    assert calls[1][1]["numPartitions"] == 4 and calls[1][1]["column"] == "id"


def test_publishing_one_model_keeps_the_others(spark, written, monkeypatch):
    stored = spark.createDataFrame(
        [(1, "case_risk", "a", 0.1), (2, "outbreak", "b", 0.2)],
        "id int, model_name string, feature_name string, importance double",
    )
    monkeypatch.setattr(jdbc, "read_table", lambda *a, **k: stored)
    rows = spark.createDataFrame([("case_risk", "a", 0.9)], "model_name string, feature_name string, importance double")
    jdbc.publish_model_rows(spark, rows, TARGET)
    df = written[0][5]
    assert df.schema.names == FEATURE_IMPORTANCE.names
    assert {(r["model_name"], r["importance"]) for r in df.collect()} == {("outbreak", 0.2), ("case_risk", 0.9)}
    assert all(r["trained_at"] for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "model-rows" in plan, "the write must read the staged copy, not the table it replaces"


def test_sync_declares_types_and_stamps(spark, written, run_dir):
    cases = spark.createDataFrame(
        [("c", "N", 3, "F", 1.0, 0.0, 0.4)],
        "case_id string, region_id string, patient_age bigint, gender string, label double, prediction double, probability double",
    )
    windows = spark.sql(
        "SELECT 'N' region_id, timestamp'2024-01-01' date, 3 total_cases, 1 positive_cases, 0D is_outbreak, 1D prediction"
    )
    cases.write.parquet(f"{run_dir}/c")
    windows.write.parquet(f"{run_dir}/w")
    jdbc.sync_predictions(spark, f"{run_dir}/c", f"{run_dir}/w", TARGET)
    assert [c[3] for c in written] == ["case_predictions", "outbreak_predictions"]
    for call, schema in zip(written, (CASE_PREDICTIONS, OUTBREAK_PREDICTIONS)):
        assert [(f.name, f.dataType) for f in call[5].schema] == [(f.name, f.dataType) for f in schema]
        assert call[5].first()["synced_at"] is not None


def test_settings_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("CASEBEACON_JDBC_URL", "jdbc:z")
    monkeypatch.setenv("CASEBEACON_JDBC_USER", "me")
    assert jdbc.JdbcTarget.from_environment().properties() == {"user": "me"}


def test_kafka_options(spark, monkeypatch):
    from pyspark.sql.streaming import DataStreamReader

    seen = {}
    monkeypatch.setattr(DataStreamReader, "format", lambda self, f: seen.update(format=f) or self)
    monkeypatch.setattr(DataStreamReader, "option", lambda self, k, v: seen.update({k: v}) or self)
    empty = spark.createDataFrame([], "partition int, offset bigint, key binary, value binary")
    monkeypatch.setattr(DataStreamReader, "load", lambda self: empty)
    messages = kafka.read_topic(spark, "host:1", "cases", 100)
    assert messages.columns == ["partition", "offset", "key", "value"]
    assert seen == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "cases",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": 100,
    }


def test_overwrite_replaces(spark, run_dir):
    files.write_parquet(spark.range(5), f"{run_dir}/t")
    files.write_parquet(spark.range(2), f"{run_dir}/t")
    assert files.read_parquet(spark, f"{run_dir}/t").count() == 2


def test_a_bad_line_is_kept(spark, run_dir):
    spark.createDataFrame([('{"case_id":"a","patient_age":3}',), ("{oops",)], "value string").write.text(f"{run_dir}/r")
    rows = files.read_raw_json(spark, f"{run_dir}/r").orderBy("case_id").collect()
    assert [r["_unreadable"] for r in rows] == ["{oops", None]
    assert rows[1]["patient_age"] == 3


def test_json_partitions_come_out_as_one_file_each(spark, run_dir):
    rows = spark.range(4000).select("id", (F.col("id") % 7).alias("day")).repartition(16)
    files.write_json(rows, f"{run_dir}/j", ["day"])
    parts = spark.read.json(f"{run_dir}/j").select(F.input_file_name().alias("f")).distinct().count()
    assert parts == 7


def test_numbered_folders_skip_incomplete_ones(spark, run_dir):
    for n in (2, 10):
        spark.range(1).write.parquet(f"{run_dir}/n={n}")
    spark.range(1).write.parquet(f"{run_dir}/n=11")
    files.remove(spark, f"{run_dir}/n=11/_SUCCESS")
    assert files.numbered_folders(spark, run_dir, "n") == [2, 10]
    assert files.numbered_folders(spark, f"{run_dir}/missing", "n") == []


def test_work_folders_are_below_the_shared_one(spark):
    root = session.shared_root(spark)
    a, b = session.work_dir(spark, "x"), session.work_dir(spark, "x")
    assert a != b and a.startswith(root + "/") and b.startswith(root + "/")
