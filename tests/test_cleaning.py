"""Cleaning, validation and the wire form."""

import json

from pyspark.sql import functions as F

from casebeacon.operators import cleaning, envelope, merge
from casebeacon.plans import etl
from casebeacon.schemas import REQUIRED_FIELDS, WIRE_CASE
from casebeacon.sources import kafka

RECORD = {
    "case_id": "a",
    "timestamp": "2024-03-01T10:00:00+02:00",
    "region_id": "North",
    "district": "D",
    "gps_lat": -1.9,
    "gps_lon": 30,
    "patient_age": 7,
    "gender": "F",
    "symptoms": ["fever", "chills"],
    "rapid_test_result": "Positive",
    "body_temperature": 38.1,
    "ambient_temperature": 20.0,
    "humidity": 60.0,
    "rainfall_mm": 3.5,
}


def wrapped(record):
    payload = {k: json.dumps(v) if isinstance(v, list) else v for k, v in record.items()}
    return json.dumps({"schema": {"type": "struct"}, "payload": payload})


def without(*fields, **changes):
    return {k: v for k, v in {**RECORD, **changes}.items() if k not in fields}


def messages(spark, *values):
    rows = [(0, i, None, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "partition int, offset bigint, key string, value string")


def test_wrapped_and_flat_records_are_read_alike(spark):
    df = messages(spark, wrapped(RECORD), json.dumps(RECORD), "not json", json.dumps(without("region_id")))
    decoded = envelope.decode_messages(df)
    good = envelope.good_records(decoded).collect()
    assert len(good) == 2
    assert [json.loads(r["symptoms"]) for r in good] == [["fever", "chills"]] * 2
    assert [r["gps_lon"] for r in good] == [30.0, 30.0]
    bad = {r["offset"]: (r["error"], r["raw"]) for r in envelope.dead_letters(decoded).collect()}
    assert bad[2] == ("Not a JSON object", "not json")
    assert bad[3][0] == "Missing fields: region_id"
    assert set(bad) == {2, 3}


def test_a_null_is_present_but_a_missing_key_is_not(spark):
    df = messages(spark, json.dumps(without(district=None)), json.dumps(without("district")), "[1]", "")
    checked = envelope.validate_required(df).orderBy("offset").collect()
    assert [r["accepted"] for r in checked] == [True, False, False, False]
    assert checked[1]["missing"] == ["district"]


def test_a_field_of_the_wrong_type_is_a_dead_letter(spark):
    decoded = envelope.decode_messages(messages(spark, json.dumps(without(patient_age="old"))))
    assert envelope.dead_letters(decoded).first()["error"] == "Unreadable field value"


def test_nothing_is_lost_between_good_and_bad(spark):
    values = [wrapped(RECORD), "{", json.dumps({}), json.dumps(without("humidity")), json.dumps(RECORD), "null", "7"]
    decoded = envelope.decode_messages(messages(spark, *values))
    assert envelope.good_records(decoded).count() + envelope.dead_letters(decoded).count() == len(values)


def test_wrapping_round_trip(spark):
    good = envelope.good_records(envelope.decode_messages(messages(spark, json.dumps(RECORD))))
    lists = good.withColumn("symptoms", F.from_json("symptoms", "array<string>"))
    row = envelope.wrap_envelope(lists).first()
    document = json.loads(row["value"])
    assert row["key"] == "North"
    assert [f["field"] for f in document["schema"]["fields"]] == list(WIRE_CASE.names)
    types = {f["field"]: f["type"] for f in document["schema"]["fields"]}
    assert (types["patient_age"], types["gps_lat"], types["symptoms"]) == ("int64", "double", "string")
    assert json.loads(document["payload"]["symptoms"]) == RECORD["symptoms"]
    again = envelope.good_records(envelope.decode_messages(messages(spark, row["value"])))
    assert again.collect() == good.collect()


def test_wrapped_nulls_stay_visible(spark):
    df = spark.createDataFrame([("N", None, True)], "region_id string, patient_age int, flag boolean")
    document = json.loads(envelope.wrap_envelope(df).first()["value"])
    assert document["payload"] == {"region_id": "N", "patient_age": None, "flag": True}
    assert [f["type"] for f in document["schema"]["fields"]] == ["string", "int64", "boolean"]


def test_kafka_records_become_text(spark):
    df = spark.createDataFrame(
        [(0, 5, bytearray(b"N"), bytearray(b"ok")), (1, 6, None, bytearray(b"\xffbad"))],
        "partition int, offset bigint, key binary, value binary",
    )
    rows = kafka.as_messages(df).orderBy("offset").collect()
    assert (rows[0]["key"], rows[0]["value"]) == ("N", "ok")
    assert rows[1]["key"] is None and rows[1]["value"] == "�bad"


def raw(spark, *rows):
    return spark.createDataFrame(
        rows, "case_id string, region_id string, rapid_test_result string, timestamp string, symptoms array<string>"
    )


def test_cleaning_rules(spark):
    df = raw(
        spark,
        ("a", "N", "POSITIVE", "2024-01-01T00:00:00", ["x", "y"]),
        ("a", None, "negative", "2024-01-02T00:00:00", []),
        ("b", "N", "pOSITIVE", "nonsense", None),
        ("c", "N", "Negative", "2024-01-01T00:00:00", ["x"]),
        ("c", "S", "negative", "2024-01-01T00:00:05", []),
        (None, "N", "negative", "2024-01-01T00:00:00", []),
    )
    clean = {r["case_id"]: r for r in cleaning.clean_cases(df).collect()}
    assert set(clean) == {"a", "b", "c"}
    assert clean["a"]["region_id"] == "N", "an incomplete newer copy must not displace a good one"
    assert clean["a"]["rapid_test_result"] == "positive" and clean["a"]["symptom_count"] == 2
    assert clean["b"]["rapid_test_result"] == "pOSITIVE", "only the listed spellings change"
    assert clean["b"]["timestamp"] is None and clean["b"]["symptom_count"] is None
    assert clean["c"]["region_id"] == "S", "the newest copy wins"


def test_audit_counts(spark):
    df = raw(
        spark,
        ("a", "N", "POSITIVE", "t", []),
        ("a", "N", "unclear", "t", []),
        ("b", None, "negative", "t", []),
        (None, "N", "negative", "t", []),
    )
    audit = {r["step"]: r["rows"] for r in cleaning.row_audit(df).collect()}
    assert audit == {"raw": 4, "complete": 2, "deduplicated": 1, "unknown_result": 1, "unparsed_time": 2}
    assert {r["rows"] for r in cleaning.row_audit(df.limit(0)).collect()} == {0}


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    df = raw(spark, ("a", "N", "positive", "t", []))
    plan = cleaning.dedupe_cases(df)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_upsert(spark):
    """The last to arrive wins, also if it reports an earlier time."""
    schema = "case_id string, timestamp string, v int"
    current = spark.createDataFrame([("a", "1", 1), ("b", "1", 2)], schema)
    updates = spark.createDataFrame([("b", "3", 3, 1), ("b", "2", 4, 2), ("c", "1", 5, 3)], schema + ", arrival int")
    got = {tuple(r) for r in merge.upsert_cases(current, updates).collect()}
    assert got == {("a", "1", 1), ("b", "2", 4), ("c", "1", 5)}
    again = merge.upsert_cases(merge.upsert_cases(current, updates), updates)
    assert {tuple(r) for r in again.collect()} == got


def test_etl_files(spark, run_dir):
    lines = [
        "no record",
        wrapped(RECORD),
        json.dumps(RECORD),
        json.dumps(without(case_id="b", rapid_test_result=None)),
        json.dumps(without(case_id="c", timestamp="2024-03-02T00:00:00Z")),
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{run_dir}/raw/2024/03/01")
    counts = etl.run_etl(spark, f"{run_dir}/raw/*/*/*/*.txt", f"{run_dir}/clean", f"{run_dir}/dead")
    assert counts == {"read": 5, "unusable": 1, "written": 2}
    assert [r["raw"] for r in spark.read.json(f"{run_dir}/dead").collect()] == ["no record"]
    clean = spark.read.parquet(f"{run_dir}/clean")
    assert sorted(r["case_id"] for r in clean.collect()) == ["a", "c"]
    assert clean.where("case_id = 'a'").first()["timestamp"].hour == 8
    etl.run_insights(spark, f"{run_dir}/clean", f"{run_dir}/insights")
    rate = spark.read.parquet(f"{run_dir}/insights/positivity_by_region").first()
    assert (rate["total_cases"], rate["positivity_rate_pct"]) == (2, 100.0)


def test_all_required_fields_are_wire_fields():
    assert set(REQUIRED_FIELDS) == set(WIRE_CASE.names)
