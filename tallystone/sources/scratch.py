"""Scratch folders in the storage that every executor and the driver can reach, gone when the driver's JVM ends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no checkpoint folder and has one machine (tests, a laptop).
DEFAULT_DIR = "file:///tmp/checkpoints"

_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a local default where it is unset and there is no other machine."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = DEFAULT_DIR
    return found.rstrip("/")


def folder(spark: SparkSession) -> str:
    """A folder of this application. The JVM removes it when it ends, also behind a session that was stopped before."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        path = f"{shared_dir(spark)}/tallystone/{app}-{uuid.uuid4().hex[:8]}"
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        _folders[app] = path
    return _folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in that folder."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in that folder: later jobs read it, and don't depend on the executors that made it."""
    path = new_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
