"""Fixed schemas of the case records and the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The keys every case report must carry.
REQUIRED_FIELDS = (
    "case_id",
    "timestamp",
    "region_id",
    "district",
    "gps_lat",
    "gps_lon",
    "patient_age",
    "gender",
    "symptoms",
    "rapid_test_result",
    "body_temperature",
    "ambient_temperature",
    "humidity",
    "rainfall_mm",
)

ESSENTIAL_FIELDS = ("case_id", "region_id", "rapid_test_result")

# A report as it comes off the wire. Times and the symptom list stay text until cleaning:
# the list arrives either as an array or as JSON text, and a string field accepts both.
WIRE_CASE = T.StructType(
    [
        T.StructField("case_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("region_id", T.StringType()),
        T.StructField("district", T.StringType()),
        T.StructField("gps_lat", T.DoubleType()),
        T.StructField("gps_lon", T.DoubleType()),
        T.StructField("patient_age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("symptoms", T.StringType()),
        T.StructField("rapid_test_result", T.StringType()),
        T.StructField("body_temperature", T.DoubleType()),
        T.StructField("ambient_temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("rainfall_mm", T.DoubleType()),
    ]
)

CASE_PREDICTIONS = T.StructType(
    [
        T.StructField("case_id", T.StringType()),
        T.StructField("region_id", T.StringType()),
        T.StructField("patient_age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("label", T.DoubleType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("synced_at", T.TimestampType()),
    ]
)

OUTBREAK_PREDICTIONS = T.StructType(
    [
        T.StructField("region_id", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("total_cases", T.LongType()),
        T.StructField("positive_cases", T.LongType()),
        T.StructField("is_outbreak", T.DoubleType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("synced_at", T.TimestampType()),
    ]
)

FEATURE_IMPORTANCE = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("importance", T.DoubleType()),
        T.StructField("trained_at", T.TimestampType()),
    ]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)
