"""Readers and writers: directory trees, delimited listings, id lists, synthetic catalogues, blob stores."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.operators.blobs import fanout
from tallystone.sources import trees


def _file_system(uri: str):
    """Arrow's file system for a URI, and the path in it."""
    from pyarrow import fs

    local = uri.removeprefix("file://").removeprefix("file:")
    return (fs.LocalFileSystem(), local) if "://" not in local else fs.FileSystem.from_uri(uri)


def scan_tree(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``, empty ones too (Spark's own readers leave them out): path, size, mtime. See ``trees.scan``."""
    return trees.scan(spark, root)


def read_contents(paths: DataFrame, root: str) -> DataFrame:
    """``path, content`` of the files of ``paths(path)`` in the file system of ``root``; a file is one row."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = _file_system(root)
        for frame in frames:
            for path in frame["path"]:
                with store.open_input_stream(path) as stream:
                    yield pd.DataFrame({"path": [path], "content": [stream.read()]})

    return paths.select("path").mapInPandas(read, "path string, content binary")


def with_inodes(paths: DataFrame) -> DataFrame:
    """``path, st_dev, st_inode, size, mtime`` by ``stat`` on a file system that all executors mount; unreadable ones are left out."""

    def stat(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path in frame["path"]:
                try:
                    s = os.stat(path.removeprefix("file:"))
                except (OSError, ValueError):
                    continue
                rows.append((path, s.st_dev, s.st_ino, s.st_size, s.st_mtime))
            yield pd.DataFrame(rows, columns=["path", "st_dev", "st_inode", "size", "mtime"])

    return paths.select("path").mapInPandas(stat, "path string, st_dev long, st_inode long, size long, mtime double")


def synthetic_catalogue(spark: SparkSession, n: int, hardlinks: float = 0.3, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """``(1 - hardlinks) n`` files of their own and ``hardlinks n`` further paths of random ones of them."""
    own = int(n * (1 - hardlinks))
    rows = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    target = F.when(F.col("id") < own, F.col("id")).otherwise(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(1, own))))
    path = F.when(F.col("id") < own, F.format_string("files/batch%d/file_%08d.dat", F.expr("id div 10000"), F.col("id"))).otherwise(F.format_string("backups/copy_%08d.dat", F.col("id")))
    return rows.select(path.alias("path"), F.lit(12345).cast("long").alias("st_dev"), (target + 1_000_000).alias("st_inode"))


def null_delimited(spark: SparkSession, path: str, dataset: str, prefix: str = "/mnt/snapshot/") -> DataFrame:
    """Paths between NUL bytes; comments and blanks are left out, the prefix is dropped."""
    rows = spark.read.option("lineSep", "\0").text(path).where("value <> '' AND NOT startswith(value, '#')")
    text = F.trim("value")
    return rows.select(F.when(text.startswith(prefix), F.substring(text, len(prefix) + 1, 2_147_483_647)).otherwise(text).alias("file_path"), F.lit(dataset).alias("dataset")).where("file_path <> ''")


def mtime_listing(spark: SparkSession, path: str, separator: str = "\x1c") -> DataFrame:
    return spark.read.schema("mtime double, path string").option("sep", separator).option("quote", "").csv(path)


def bad_blob_list(spark: SparkSession, path: str) -> DataFrame:
    """Blob ids of lines ``type | blobid | uploaded | path``; comments, rules and other lines are left out."""
    rows = spark.read.text(path).where("trim(value) <> '' AND NOT startswith(value, '#') AND NOT startswith(value, '-')")
    return rows.select(F.split("value", r"\s*\|\s*").alias("p")).where(F.size("p") == 4).select(F.trim(F.col("p")[1]).alias("blobid")).distinct()


def id_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("blobid")).where("blobid <> '' AND NOT startswith(blobid, '#')").distinct()


def stored_blobs(spark: SparkSession, root: str) -> DataFrame:
    """Blob ids physically present below ``root``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("blobid"), F.col("length").alias("size")).where(F.col("blobid").rlike("^[0-9a-f]{64}$"))


def write_blobs(blobs: DataFrame, root: str) -> DataFrame:
    """Documents of ``blobs(blobid, document)`` to ``root/AA/BB/<id>`` on a mount that all executors share: temporary name, then rename."""

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, document in zip(frame["target"], frame["document"], strict=True):
                target = os.path.join(root, path)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                temporary = f"{target}.{os.getpid()}.tmp"
                with open(temporary, "w") as out:
                    out.write(document)
                os.replace(temporary, target)
            yield frame[["blobid", "target"]]

    return blobs.select("blobid", fanout(F.col("blobid")).alias("target"), "document").dropDuplicates(["blobid"]).mapInPandas(write, "blobid string, target string")


def write_dataset(paths: DataFrame, root: str) -> None:
    """Replace the partitions of the datasets in ``paths(file_path, dataset)`` and leave the others."""
    paths.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset").parquet(root)


def bulk_insert(root: str, records: DataFrame, changeset_id: str) -> None:
    records.withColumn("changeset_id", F.lit(changeset_id)).write.mode("append").partitionBy("changeset_id").parquet(root)


def path_list(spark: SparkSession, path: str) -> DataFrame:
    """One path per line; blank lines are left out."""
    return spark.read.text(path).select(F.trim("value").alias("pth")).where("pth <> ''")


def column_types(spark: SparkSession, table: str) -> DataFrame:
    """Columns of a catalogue table."""
    found = [(c.name, c.dataType, c.nullable, c.isPartition) for c in spark.catalog.listColumns(table)]
    return spark.createDataFrame(found, "name string, type string, nullable boolean, is_partition boolean")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def backup_folders(disk: DataFrame) -> DataFrame:
    """Folders named ``back-*`` of a listing ``disk(pth)``."""
    return disk.select(F.regexp_extract("pth", r"^((?:(?!back-)[^/]*/)*back-[^/]*)", 1).alias("folder")).where("folder <> ''").distinct()


def write_metrics(rows: DataFrame, path: str) -> None:
    """CSV files with a header."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def append_log(rows: DataFrame, path: str) -> None:
    """JSON lines behind those that are there."""
    rows.write.mode("append").json(path)


def write_ids(ids: DataFrame, path: str) -> None:
    """Sorted ids, one per line, each once; files in order of their names."""
    ids.select(F.col("blobid").alias("value")).distinct().orderBy("value").write.mode("overwrite").text(path)


def write_monthly(operations: DataFrame, root: str) -> None:
    """A log partitioned by month, so that a time range reads its months only. A month is dealt to as many tasks as it needs, so
    that tasks don't write a small file for each month; rows without a time are in a partition of their own."""
    rows = operations.withColumn("month", F.date_format("operation_timestamp", "yyyy-MM")).hint("rebalance", "month")
    rows.write.mode("append").partitionBy("month").parquet(root)


def read_monthly(spark: SparkSession, root: str, start: Column | None = None, stop: Column | None = None) -> DataFrame:
    """Rows of the log from ``start`` on and before ``stop``; only the folders of their months are listed in the scan.

    Without both bounds everything is read, rows without a time too.
    """
    rows = spark.read.parquet(root)
    time, month = F.col("operation_timestamp"), F.col("month").cast("string")
    if start is not None:
        rows = rows.where((time >= start) & (month >= F.date_format(start, "yyyy-MM")))
    if stop is not None:
        rows = rows.where((time < stop) & (month <= F.date_format(stop, "yyyy-MM")))
    return rows


def during(log: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows of the log in each of ``windows(label, start, stop)``, the stop left out: the log's columns and ``label``.

    Joined by month first, so that Spark reads the months that occur in windows and no others; windows that are empty
    or lack a bound have no rows, and of overlapping ones each has its own.
    """
    asked = windows.where("start < stop").select("label", "start", "stop")
    first, last = F.trunc(F.col("start"), "month"), F.trunc(F.col("stop"), "month")
    months = asked.withColumn("_month", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))).withColumn("_month", F.date_format("_month", "yyyy-MM"))
    time = F.col("operation_timestamp")
    met = log.join(months, F.col("month") == F.col("_month")).where((time >= F.col("start")) & (time < F.col("stop")))
    return met.select(*log.columns, "label")


def restore_files(restored: DataFrame, root: str) -> DataFrame:
    """``pth, size`` of the files of ``restored(pth, content, mtime)`` written below ``root``, a mount that all executors share.

    Each under a temporary name first; the time of change is set before it gets its own. Paths that lead out of ``root``
    raise an error.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = os.path.realpath(root)
        for frame in frames:
            for path, content, mtime in zip(frame["pth"], frame["content"], frame["mtime"], strict=True):
                target = os.path.realpath(os.path.join(base, path))
                if not target.startswith(base + os.sep):
                    raise ValueError(f"{path!r} leads out of the folder")
                os.makedirs(os.path.dirname(target), exist_ok=True)
                temporary = f"{target}.{os.getpid()}.tmp"
                with open(temporary, "wb") as out:
                    out.write(content)
                if not pd.isna(mtime):
                    os.utime(temporary, (mtime, mtime))
                os.replace(temporary, target)
            yield pd.DataFrame({"pth": frame["pth"], "size": frame["content"].map(len)})

    return restored.select("pth", "content", "mtime").mapInPandas(write, "pth string, size long")
