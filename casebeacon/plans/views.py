"""Case-shaped views over the test tables (events, region, nation)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebeacon.functions import expressions as X


# Known columns spare the job that would read them from the files.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


CASE_COLUMNS = (
    "event_id",
    "concat('C', event_id) AS case_id",
    "ts",
    "r_name AS region_id",
    "n_name AS district",
    "CAST((user_id * 7 + event_id) % 90 AS INT) AS patient_age",
    "CASE WHEN event_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
    "to_json(slice(array('cough', 'rash', 'nausea', 'ache'), 1, CAST(1 + event_id % 4 AS INT))) AS symptoms_json",
    "CAST(1 + event_id % 4 AS INT) AS symptom_count",
    "CASE WHEN event_type IN ('error', 'purchase') THEN 'positive' ELSE 'negative' END AS rapid_test_result",
    "36.0D + CAST(event_id % 46 AS DOUBLE) / 10 AS body_temperature",
    "18.0D + CAST((event_id * 13) % 141 AS DOUBLE) / 10 AS ambient_temperature",
    "40.0D + CAST(get_json_object(props, '$.k') AS DOUBLE) * 0.55D AS humidity",
    "value AS rainfall_mm",
)


def cases_from(events: DataFrame, region: DataFrame, nation: DataFrame) -> DataFrame:
    """The clean case table. The two dimension tables are joined by their measured size."""
    return (
        events.join(region, F.expr("user_id % 5 = r_regionkey"))
        .join(nation, F.expr("user_id % 25 = n_nationkey"))
        .selectExpr(*CASE_COLUMNS)
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases_from(*(table(spark, sf_dir, t) for t in ("events", "region", "nation")))


def cases_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream of event files; streams need a zoned timestamp."""
    events = (
        spark.readStream.schema(SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    return cases_from(events, table(spark, sf_dir, "region"), table(spark, sf_dir, "nation"))


def cases_raw_from(clean: DataFrame) -> DataFrame:
    """Dirty input: text times, mixed spellings, missing regions, repeated and unknown cases."""
    e, result = F.col("event_id"), F.col("rapid_test_result")
    spelled = (
        F.when(e % 211 == 0, "unclear")
        .when(e % 3 == 0, F.upper(result))
        .when(e % 3 == 1, F.initcap(result))
        .otherwise(result)
    )
    rest = ("district", "patient_age", "gender", "symptoms_json")
    first = clean.select(
        "case_id",
        iso_text(F.col("ts")).alias("timestamp_text"),
        F.when(e % 97 != 0, F.col("region_id")).alias("region_id"),
        *rest,
        spelled.alias("rapid_test_result"),
        "humidity",
        "rainfall_mm",
    )
    again = clean.where(e % 50 == 0).select(
        "case_id",
        iso_text(F.col("ts") + F.expr("INTERVAL '1' SECOND")).alias("timestamp_text"),
        "region_id",
        "district",
        (F.col("patient_age") + 1).alias("patient_age"),
        "gender",
        "symptoms_json",
        "rapid_test_result",
        "humidity",
        "rainfall_mm",
    )
    return first.unionByName(again)


def cases_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases_raw_from(cases(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-rule stand-in for the case predictions."""
    return cases(spark, sf_dir).select(
        "case_id",
        "region_id",
        "patient_age",
        "gender",
        X.case_label().alias("label"),
        F.when(F.col("rainfall_mm") > 40, 1.0).otherwise(0.0).alias("prediction"),
    )


def windows_from(clean: DataFrame) -> DataFrame:
    """Region-by-day features with a fixed-rule prediction."""
    day = F.date_trunc("day", "ts").cast(clean.schema["ts"].dataType)
    mean = lambda c: F.round(F.avg(c), 6)
    return (
        clean.groupBy("region_id", day.alias("date"))
        .agg(
            F.count("*").alias("total_cases"),
            F.sum(X.positive_flag()).alias("positive_cases"),
            mean("rainfall_mm").alias("avg_rainfall"),
            mean("humidity").alias("avg_humidity"),
            mean("ambient_temperature").alias("avg_temperature"),
            mean("symptom_count").alias("avg_symptoms"),
        )
        .withColumn("prediction", F.when(5 * F.col("positive_cases") > 2 * F.col("total_cases"), 1.0).otherwise(0.0))
    )


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows_from(cases(spark, sf_dir))


def importances_from(clean: DataFrame) -> DataFrame:
    """Stand-in for stored feature importances: the share of each reading in the sum of means."""
    names = ("patient_age", "humidity", "rainfall_mm", "ambient_temperature")
    total = sum((F.avg(n) for n in names[1:]), F.avg(names[0]))
    rows = [
        F.struct(
            F.lit(model).alias("model_name"),
            F.lit(n).alias("feature_name"),
            F.round(F.avg(n) / total, 6).alias("importance"),
        )
        for model, n in (*(("case_risk", n) for n in names), *(("outbreak", n) for n in names[1:]))
    ]
    return clean.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


RECORD = """concat('{',
  CASE WHEN event_id % 103 = 0 THEN '' ELSE concat('"region_id":"', region_id, '",') END,
  '"case_id":"', case_id, '","timestamp":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '",',
  CASE WHEN event_id % 107 = 0 THEN '"district":null' ELSE concat('"district":"', district, '"') END,
  ',"gps_lat":', event_id % 90, ',"gps_lon":', event_id % 180, ',"patient_age":', patient_age,
  ',"gender":"', gender, '","symptoms":', symptoms_json, ',"rapid_test_result":"', rapid_test_result,
  '","body_temperature":', event_id % 5 + 36, ',"ambient_temperature":', event_id % 15 + 18,
  ',"humidity":', event_id % 56 + 40, ',"rainfall_mm":', CAST(floor(rainfall_mm) AS INT), '}')"""


def messages_from(clean: DataFrame) -> DataFrame:
    """Wire messages of the cases, some of them broken.

    A quarter comes wrapped, some are cut short, some lack a key, some hold a null.
    """
    value = """CASE WHEN event_id % 101 = 0 THEN substr(record, 1, 40)
      WHEN event_id % 4 = 0 THEN concat('{"schema":{"type":"struct"},"payload":', record, '}')
      ELSE record END AS value"""
    return clean.selectExpr("event_id", "region_id", f"{RECORD} AS record").selectExpr(
        "CAST(length(region_id) % 5 AS INT) AS partition", "event_id AS offset", "region_id AS key", value
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from(cases(spark, sf_dir))


def messages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from(cases_stream(spark, sf_dir))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
