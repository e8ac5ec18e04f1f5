"""The self-describing wire form of a case: wrapping, unwrapping and validation."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebeacon.schemas import REQUIRED_FIELDS, WIRE_CASE

_WIRE_TYPES = (
    (T.BooleanType, "boolean"),
    (T.IntegralType, "int64"),
    (T.FractionalType, "double"),
)


def wire_type(data_type: T.DataType) -> str:
    """Wire name of a column type; everything without its own wire type travels as text."""
    for spark_type, name in _WIRE_TYPES:
        if isinstance(data_type, spark_type):
            return name
    return "string"


def wire_schema(schema: T.StructType, name: str) -> str:
    """The schema half of the envelope. It depends on the columns only, so it is built once."""
    return json.dumps(
        {
            "type": "struct",
            "fields": [{"field": f.name, "type": wire_type(f.dataType), "optional": True} for f in schema],
            "optional": False,
            "name": name,
        },
        separators=(",", ":"),
    )


def payload_text(df: DataFrame) -> Column:
    """The record as JSON text; lists travel as JSON text inside it, nulls stay visible."""
    fields = [
        (F.to_json(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)).alias(f.name)
        for f in df.schema
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def wrap_envelope(df: DataFrame, name: str = "case_report", key: str = "region_id") -> DataFrame:
    """Key and envelope text of each record, ready for a keyed sink."""
    head = '{"schema":' + wire_schema(df.schema, name) + ',"payload":'
    value = F.concat(F.lit(head), payload_text(df), F.lit("}"))
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def record_text(value: str = "value") -> Column:
    """The flat record inside a message, whether it came wrapped or flat."""
    return F.coalesce(F.get_json_object(F.col(value), "$.payload"), F.col(value))


def missing_fields(text: Column, required: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """Required keys that are absent. A key holding null is present. Null if not an object."""
    return F.array_except(F.array(*(F.lit(f) for f in required)), F.json_object_keys(text))


def validate_required(
    df: DataFrame, value: str = "value", required: Sequence[str] = REQUIRED_FIELDS
) -> DataFrame:
    """Adds ``missing`` (list of absent keys, null for a non-object) and ``accepted``."""
    missing = missing_fields(record_text(value), required)
    return df.withColumn("missing", missing).withColumn(
        "accepted", F.coalesce(F.array_size("missing") == 0, F.lit(False))
    )


def parsed_message(value: str, schema: T.StructType) -> Column:
    """Both forms of a message from one parse: its own fields and those of its payload."""
    both = T.StructType(
        [*schema.fields, T.StructField("payload", schema), T.StructField("_unreadable", T.StringType())]
    )
    return F.from_json(value, both, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unreadable"})


def decode_messages(
    messages: DataFrame,
    value: str = "value",
    schema: T.StructType = WIRE_CASE,
    required: Sequence[str] = REQUIRED_FIELDS,
) -> DataFrame:
    """Adds ``record`` (the parsed fields) and ``error`` (null when the record is usable).

    Keys are looked at only where a required field came out null: a value proves its key.
    The one-row `inline` keeps the parse in one place; a filter on ``error`` would otherwise
    be moved below it and parse every message again.
    """
    message = F.col("_message")
    flat = F.struct(*(message[f].alias(f) for f in schema.names))
    parsed = messages.withColumn("_message", parsed_message(value, schema)).select(
        *messages.columns,
        F.inline(
            F.array(
                F.struct(
                    F.coalesce(message["payload"], flat).alias("record"),
                    message["_unreadable"].isNotNull().alias("_unreadable"),
                )
            )
        ),
    )
    complete = F.lit(True)
    for field in required:
        complete = complete & F.col("record")[field].isNotNull()
    missing = missing_fields(record_text(value), required)
    error = F.when(complete & ~F.col("_unreadable"), F.lit(None)).otherwise(
        F.when(missing.isNull(), "Not a JSON object")
        .when(F.array_size(missing) > 0, F.concat(F.lit("Missing fields: "), F.array_join(missing, ", ")))
        .when(F.col("_unreadable"), "Unreadable field value")
    )
    return parsed.withColumn("error", error).drop("_unreadable")


def unwrap_envelope(
    messages: DataFrame, value: str = "value", schema: T.StructType = WIRE_CASE
) -> DataFrame:
    """The fields of each message, accepting wrapped and flat records."""
    return decode_messages(messages, value, schema, ()).select(
        *(F.col("record")[f].alias(f) for f in schema.names)
    )


def good_records(decoded: DataFrame, schema: T.StructType = WIRE_CASE, keep: Sequence[str] = ()) -> DataFrame:
    """The usable records, with the columns of the message named in ``keep``."""
    return decoded.where("error IS NULL").select(*(F.col(f"record.{f}").alias(f) for f in schema.names), *keep)


def dead_letters(decoded: DataFrame, value: str = "value") -> DataFrame:
    """What could not be used, with its place in the stream, the reason and the raw text."""
    return decoded.where("error IS NOT NULL").select("partition", "offset", "error", F.col(value).alias("raw"))
