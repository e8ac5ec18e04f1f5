"""The batch jobs: raw files to the clean table, the clean table to insights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casebeacon.operators import cleaning, metrics
from casebeacon.operators.envelope import dead_letters, decode_messages, good_records
from casebeacon.session import work_dir
from casebeacon.sources.files import exists, read_parquet, remove, write_json, write_parquet

FILE_BYTES = 256_000_000  # of a file of the clean table, as shuffled


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines files as messages; their place is the file and not a stream offset."""
    return spark.read.text(path).select(
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        "value",
    )


def run_etl(
    spark: SparkSession, raw_path: str, clean_path: str, dead_letter_path: str | None = None
) -> dict[str, int]:
    """Reads wrapped or flat records, cleans them and replaces the clean table.

    Files hold what the stream has accepted, so only the fields the analysis needs are
    required here. Row counts are taken while the one write runs. Lines that are no records
    are counted, and written aside if a path is given: then the decoded lines are staged once, parted
    by outcome, and both tables come from their part, so the raw files are parsed once.
    """
    read, written = Observation("read"), Observation("written")
    decoded = decode_messages(read_messages(spark, raw_path), required=())
    if dead_letter_path is not None:
        return _run_staged(spark, decoded, clean_path, dead_letter_path)
    observed = decoded.observe(
        read,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("error").isNotNull()).alias("unusable"),
    )
    _write_clean(good_records(observed), clean_path, written)
    counts = read.get
    return {"read": counts["rows"], "unusable": counts["unusable"], "written": written.get["rows"]}


def _write_clean(records: DataFrame, clean_path: str, written: Observation) -> None:
    clean = cleaning.clean_cases(records).withColumn("event_date", F.to_date("timestamp"))
    write_parquet(clean, clean_path, ["event_date"], ["region_id", "timestamp"], written)


def add_to_clean(
    records: DataFrame, clean_path: str, ts: str = "timestamp", symptoms: str = "symptoms", file_bytes: int = FILE_BYTES
) -> dict[str, int]:
    """Merges new records into the clean table and rewrites only the days that change.

    These are the days of the new rows and those that hold older copies of their cases; to find the latter
    only ids and days are read. The newest copy of a case wins, as if all files had been cleaned together, so
    the same records may come again: a run that broke off is repaired by running it once more. A day that
    loses its last row is removed. Without a table yet it is created; no records change nothing.
    """
    spark = records.sparkSession
    fresh = cleaning.clean_cases(records, ts, symptoms).withColumn("event_date", F.to_date(ts))
    order = ["event_date"], ["region_id", ts]
    fresh_path, merged_path, written = work_dir(spark, "etl-fresh"), work_dir(spark, "etl-merged"), Observation("written")
    write_parquet(fresh, fresh_path)
    new = spark.read.schema(fresh.schema).parquet(fresh_path)
    if new.isEmpty():
        remove(spark, fresh_path)
        return {"written": 0, "days": 0}
    if not exists(spark, clean_path):
        write_parquet(new, clean_path, *order, written, file_bytes=file_bytes)
        days = new.select("event_date").distinct().count()
        remove(spark, fresh_path)
        return {"written": written.get["rows"], "days": days}
    table = read_parquet(spark, clean_path)
    older = table.select("case_id", "event_date").join(new.select("case_id"), "case_id", "left_semi")
    days = [r.event_date for r in new.select("event_date").union(older.select("event_date")).distinct().collect()]  # one row per day
    touched = F.col("event_date").isin([d for d in days if d is not None])
    if None in days:
        touched = touched | F.col("event_date").isNull()
    both = table.where(touched).unionByName(new, allowMissingColumns=True).drop("symptom_count", "event_date")
    merged = cleaning.dedupe_cases(both, "case_id", ts).transform(cleaning.with_symptom_count, symptoms)
    write_parquet(merged.withColumn("event_date", F.to_date(ts)), merged_path)
    merged = spark.read.parquet(merged_path)
    write_parquet(merged, clean_path, *order, written, days_only=True, file_bytes=file_bytes)
    left = {r.event_date for r in merged.select("event_date").distinct().collect()}
    for day in days:
        if day not in left:
            remove(spark, f"{clean_path}/event_date={day or '__HIVE_DEFAULT_PARTITION__'}")
    remove(spark, fresh_path)
    remove(spark, merged_path)
    spark.catalog.refreshByPath(clean_path)
    return {"written": written.get["rows"], "days": len(days)}


def run_etl_increment(spark: SparkSession, raw_path: str, clean_path: str) -> dict[str, int]:
    """`run_etl` for further files: merges them into the clean table. Lines that are no records are left out."""
    return add_to_clean(good_records(decode_messages(read_messages(spark, raw_path), required=())), clean_path)


def _run_staged(spark: SparkSession, decoded: DataFrame, clean_path: str, dead_letter_path: str) -> dict[str, int]:
    staged, written = work_dir(spark, "etl"), Observation("written")
    bad = F.col("error").isNotNull()
    # A good line is kept as its record, a bad one as its text.
    parts = decoded.withColumns({"bad": bad, "record": F.when(~bad, F.col("record")), "value": F.when(bad, F.col("value"))})
    parts.write.partitionBy("bad").parquet(staged)
    rows = spark.read.schema(parts.schema).parquet(staged)
    _write_clean(good_records(rows.where("NOT bad")), clean_path, written)
    write_json(dead_letters(rows.where("bad")), dead_letter_path)
    counts = {r["bad"]: r["count"] for r in rows.groupBy("bad").count().collect()}
    remove(spark, staged)
    return {"read": sum(counts.values()), "unusable": counts.get(True, 0), "written": written.get["rows"]}


def run_insights(spark: SparkSession, clean_path: str, insights_path: str) -> None:
    """Computes the insight tables. Each reads only the columns it needs."""
    cases = read_parquet(spark, clean_path)
    for name, insight in (
        ("positivity_by_region", metrics.positivity_by_region),
        ("climate_correlation", metrics.climate_correlation),
        ("demographics", metrics.demographics),
        ("avg_symptoms_by_result", metrics.avg_symptoms_by_result),
    ):
        write_parquet(insight(cases), f"{insights_path}/{name}")
