"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that hold at any size. Sizes (memory, cores, shuffle partitions) belong to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "forgemeter", **overrides: object) -> SparkSession:
    """A session with the library's settings; keyword names use ``_`` for ``.`` only in ``master``."""
    builder = SparkSession.builder.appName(app_name)
    master = overrides.pop("master", None)
    if master:
        builder = builder.master(str(master))
    for key, value in {**SETTINGS, **overrides.pop("settings", {})}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a master of one process (``local[n]``) may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), "forgemeter")


def new_run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; never reused, so runs cannot mix."""
    return f"{shared_folder(spark)}/forgemeter/{purpose}-{uuid.uuid4().hex}"
