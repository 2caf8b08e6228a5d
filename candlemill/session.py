"""Session settings and scratch space."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "candlemill", **extra: str) -> SparkSession:
    """A session with the settings the jobs are written for; the master is the caller's."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **extra,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_rocksdb_state(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared space the cluster names for checkpoints."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/candlemill/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is; one that isn't there is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def newest_whole(spark: SparkSession, path: str) -> str | None:
    """The last by name of the folders below ``path`` that were written to their end; None if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in system.listStatus(target)] if system.exists(target) else []
    whole = [p.toString() for p in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max(whole, default=None)


@contextmanager
def staged(df, label: str) -> Iterator:
    """The frame as a written table for the time of a rewrite; removed once that is through.

    If the rewrite fails the copy stays, since it may be the only one.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    yield df.sparkSession.read.schema(df.schema).parquet(path)
    remove(df.sparkSession, path)


def materialize(df, label: str):
    """Cut lineage through a written table; survives the loss of any executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
