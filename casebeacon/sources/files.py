"""File sources and sinks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebeacon.schemas import WIRE_CASE

UNREADABLE = "_unreadable"


def read_raw_json(spark: SparkSession, path: str, schema: T.StructType = WIRE_CASE) -> DataFrame:
    """JSON-lines files under a glob. The schema is given, so files are read once, not twice.

    A line that does not fit is kept whole in ``_unreadable``.
    """
    readable = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])
    return (
        spark.read.schema(readable)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", UNREADABLE)
        .json(path)
    )


def inferred_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema of all JSON lines of all files: a field that appears or widens in any file is in it.

    Every line is parsed as a variant and the types are merged by an aggregate, so partial schemas meet
    and not lines. Fields with types that cannot be merged, or without a value, are text; numbers with a
    fraction are doubles. Lines that are no JSON object have no say.
    """
    line = F.try_parse_json("value")
    objects = spark.read.text(path).select(line.alias("v")).where(F.schema_of_variant("v").startswith("OBJECT<"))
    found = objects.agg(F.schema_of_variant_agg("v")).first()[0] or ""
    names = {"O": "STRUCT<", "V": "STRING", "D": "DOUBLE"}
    ddl = re.sub(r"(?<=: |Y<)(OBJECT<|VOID|VARIANT|DECIMAL\(\d+, ?\d+\))", lambda m: names[m[1][0]], found)
    return T.StructType.fromDDL(ddl[len("OBJECT<") : -1]) if ddl.startswith("OBJECT<") and len(ddl) > 8 else T.StructType()


def read_inferred_json(spark: SparkSession, path: str) -> DataFrame:
    """`read_raw_json` with the schema of all files, which costs a second pass over them."""
    return read_raw_json(spark, path, inferred_schema(spark, path))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    observation: Observation | None = None,
    days_only: bool = False,
    file_bytes: int | None = None,
) -> None:
    """Replaces a Parquet directory, or with ``days_only`` just the partitions that ``df`` has rows of.

    For a partitioned table, rebalancing brings the rows of a partition value together, lets AQE
    split a value that holds very much and merge those that hold little, so files come out
    evenly sized, of about ``file_bytes`` as shuffled. Row counts go through ``observation`` within the same job.
    """
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if days_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with _settings(df.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": file_bytes}):
        writer.parquet(path)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, int | None]) -> Iterator[None]:
    """Settings of the session for a while; those without a value stay as they are."""
    wanted = {name: value for name, value in wanted.items() if value is not None}
    before = spark.conf.getAll
    try:
        for name, value in wanted.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name in wanted:
            if name in before:
                spark.conf.set(name, before[name])
            else:
                spark.conf.unset(name)


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replaces a JSON directory; a partitioned one is rebalanced like `write_parquet`'s."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def _folder(spark: SparkSession, path: str):
    """Hadoop's handle of a path, on whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _folder(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _folder(spark, path)
    system.delete(where, True)


def numbered_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers N of the completely written folders ``name=N`` below a path, from a listing alone."""
    system, where = _folder(spark, path)
    if not system.exists(where):
        return []
    names = [s.getPath().getName() for s in system.listStatus(where)]
    numbers = [int(n.split("=", 1)[1]) for n in names if n.startswith(f"{name}=")]
    return sorted(n for n in numbers if exists(spark, f"{path}/{name}={n}/_SUCCESS"))


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's partitions, largest first and without null, from a listing of folders alone."""
    system, where = _folder(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return sorted((v for v in values if v != "__HIVE_DEFAULT_PARTITION__"), reverse=True)


def read_newest(spark: SparkSession, path: str, column: str, enough: Callable[[DataFrame], bool]) -> DataFrame:
    """The newest partitions of a table by dates, so many that ``enough`` is content, else the whole table.

    ``enough`` is asked for the newest partition, the newest 2, 4, 8 and so on. A count in it reads
    the row counts in the files' footers and no rows.
    """
    table, days, taken = read_parquet(spark, path), partition_values(spark, path, column), 1
    while taken < len(days):
        part = table.where(F.col(column) >= F.lit(days[taken - 1]).cast(table.schema[column].dataType))
        if enough(part):
            return part
        taken *= 2
    return table
