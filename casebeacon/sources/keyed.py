"""A table keyed by one column that takes upserts: rows in buckets by key, versions by manifest.

Layout: ``manifests/N.json`` names for every bucket the folder that holds it in version N,
``data/<write>/bucket=B`` are these folders. An upsert reads and rewrites only the buckets that its keys
fall into; what it writes counts once its manifest, one file, is put in place by a rename. A crash
before leaves the old version and folders that no manifest names, for `remove_unused` to delete.
The driver handles one line per bucket; ``buckets`` is chosen when the table is made (its bytes over
the wanted file size), so it grows with the table and not with a batch.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebeacon.operators import merge
from casebeacon.sources.files import _folder, exists, remove


class Conflict(RuntimeError):
    """Another writer committed the same version first."""


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string")), F.lit(buckets)).cast("int")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first, from a listing alone."""
    system, where = _folder(spark, f"{path}/manifests")
    if not system.exists(where):
        return []
    names = [s.getPath().getName() for s in system.listStatus(where)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """{"version", "key", "buckets", "schema", "info", "folders": {bucket: folder}}; of the newest version if none is named."""
    if version is None:
        known = versions(spark, path)
        if not known:
            raise ValueError(f"no table at {path}")
        version = known[-1]
    text = spark.read.option("wholetext", True).text(f"{path}/manifests/{version}.json").first()[0]
    held = json.loads(text)
    return held | {"folders": {int(b): f for b, f in held["folders"].items()}}


def _commit(spark: SparkSession, path: str, held: dict) -> None:
    """Writes the manifest beside its place and renames it there; whoever comes second fails."""
    final = f"{path}/manifests/{held['version']}.json"
    system, place = _folder(spark, final)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/.draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    try:
        out.write(bytearray(json.dumps(held).encode()))
    finally:
        out.close()
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, False)
        raise Conflict(f"version {held['version']} of {path} exists")


def _write(rows: DataFrame, path: str, key: str, buckets: int) -> dict[int, str]:
    """Writes the rows to a folder of their own, a file per bucket; {bucket: folder}."""
    spark, name = rows.sparkSession, f"data/{uuid.uuid4().hex}"
    placed = rows.withColumn("bucket", _bucket(key, buckets)).hint("rebalance", "bucket")
    placed.sortWithinPartitions("bucket", key).write.partitionBy("bucket").parquet(f"{path}/{name}")
    system, where = _folder(spark, f"{path}/{name}")
    found = [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()]
    return {int(f.split("=")[1]): f"{name}/{f}" for f in found}


def _read(spark: SparkSession, path: str, held: dict, folders: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(held["schema"])
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders]) if folders else spark.createDataFrame([], schema)


def create(rows: DataFrame, path: str, key: str = "case_id", buckets: int = 64, info: dict | None = None) -> int:
    """Makes the table with ``rows`` as version 0. Keys should be unique; a table that exists is refused."""
    spark = rows.sparkSession
    if "bucket" in rows.columns or key not in rows.columns:
        raise ValueError("rows need the key and must not have a column called bucket")
    if versions(spark, path):
        raise Conflict(f"{path} holds a table")
    held = {"version": 0, "key": key, "buckets": buckets, "schema": rows.schema.jsonValue(), "info": info or {}, "folders": _write(rows, path, key, buckets)}
    _commit(spark, path, held)
    return 0


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the newest if none is named."""
    held = manifest(spark, path, version)
    return _read(spark, path, held, sorted(held["folders"].values()))


def lookup(spark: SparkSession, path: str, keys: list) -> DataFrame:
    """The rows of a few keys; only their buckets are read."""
    held = manifest(spark, path)
    wanted = spark.createDataFrame([(None if k is None else str(k),) for k in keys], f"`{held['key']}` string")
    touched = [r[0] for r in wanted.select(_bucket(held["key"], held["buckets"])).distinct().collect()]
    return _read(spark, path, held, sorted(held["folders"][b] for b in touched if b in held["folders"])).filter(F.col(held["key"]).isin(keys))


def upsert(updates: DataFrame, path: str, arrival: tuple[str, ...] = ("arrival",), info: dict | None = None) -> int:
    """Puts the last arrival of every key of ``updates`` in place of the key's row; returns the new version.

    The updates meet the rows of their own buckets only, by the rules of `merge.upsert_cases`. Without
    updates no version is made. A writer that finds its version taken raises `Conflict`
    and has changed nothing; it can run again. The frame is read twice: hand over a stored or
    cached one.
    """
    spark = updates.sparkSession
    held = manifest(spark, path)
    key, buckets = held["key"], held["buckets"]
    touched = [r[0] for r in updates.select(_bucket(key, buckets).alias("b")).distinct().collect()]
    if not touched:
        return held["version"]
    old = _read(spark, path, held, sorted(held["folders"][b] for b in touched if b in held["folders"]))
    written = _write(merge.upsert_cases(old, updates, key, arrival).select(*old.columns), path, key, buckets)
    version = held["version"] + 1
    _commit(spark, path, held | {"version": version, "info": info if info is not None else held["info"], "folders": held["folders"] | written})
    return version


def remove_unused(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes all but the newest ``keep`` manifests, and the bucket folders that none of those names.

    Returns the number of folders deleted. Readers of older versions and writers at work must have ended.
    """
    known = versions(spark, path)
    for version in known[: len(known) - keep]:
        remove(spark, f"{path}/manifests/{version}.json")
    named = {f for version in known[-keep:] for f in manifest(spark, path, version)["folders"].values()}
    gone = 0
    if not exists(spark, f"{path}/data"):
        return gone
    system, where = _folder(spark, f"{path}/data")
    for write in [s.getPath() for s in system.listStatus(where)]:
        found = [s.getPath() for s in system.listStatus(write) if s.isDirectory()]
        left = [p for p in found if f"data/{write.getName()}/{p.getName()}" in named]
        for place in found:
            if place not in left:
                gone += 1
                system.delete(place, True)
        if not left:
            system.delete(write, True)
    return gone
