"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Rows carry UTC times; AQE sizes shuffles and splits skewed joins at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "casebeacon", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; keyword settings (dots as ``__``) win."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.ui.enabled", "false")
                .config("spark.driver.host", "127.0.0.1")
                .config("spark.driver.bindAddress", "127.0.0.1")
            )
    for name, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="casebeacon-")
    spark.sparkContext.setCheckpointDir(root)
    return root


_GIVEN: list[str] = []


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the shared folder; `clear_work_dirs` removes it."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _GIVEN.append(path)
    return path


def clear_work_dirs(spark: SparkSession) -> None:
    """Removes the folders given out by this process. Results that still read them must be stored before."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    while _GIVEN:
        path = hadoop.Path(_GIVEN.pop())
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
