"""Session settings and the shared folder for data written between two steps."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def local_session(cores: str = "*", partitions: int = 8, **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster, bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("dimkeeper")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a fresh temporary folder. A cluster gets an
    error instead, because its machines do not see each other's temporary folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="dimkeeper-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage: later steps read columns of a finished table, do not repeat the
    work that made it, and see the same rows again after an executor is lost.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
