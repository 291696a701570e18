"""Shared storage: tables in the folder that every executor and the driver can reach."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame

from tallystone.sources.scratch import new_path, remove, shared_dir

__all__ = ["adopt", "discard", "file_system", "materialize", "new_path", "remove", "settle", "shared_dir"]

_paths: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def file_system(uri: str):
    """Arrow's file system for a URI, and the path in it."""
    from pyarrow import fs

    if "://" not in uri:
        uri = uri.replace("file:", "", 1)
        return fs.LocalFileSystem(), uri
    if uri.startswith("file://"):
        return fs.LocalFileSystem(), uri[len("file://") :]
    return fs.FileSystem.from_uri(uri)


def settle(fs, temporary: str, path: str) -> None:
    """Give a finished file its name; what an earlier attempt left there, which has the same bytes, makes way."""
    for _ in range(3):
        if fs.get_file_info(path).is_file:
            fs.delete_file(path)
        try:
            fs.move(temporary, path)
            return
        except OSError:  # another attempt was faster, on a store that doesn't replace files
            if not fs.get_file_info(path).is_file:
                raise
    fs.delete_file(temporary)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    _paths[found] = path
    return found


def adopt(frame: DataFrame, source: DataFrame) -> DataFrame:
    """``frame`` stands for the table of ``source``: to discard it is to discard that."""
    if source in _paths:
        _paths[frame] = _paths[source]
    return frame


def discard(*frames: DataFrame) -> None:
    """Remove tables of ``materialize`` that nothing reads any more: all that was made of them has been written."""
    for frame in frames:
        path = _paths.pop(frame, None)
        if path is not None:
            remove(frame.sparkSession, path)
