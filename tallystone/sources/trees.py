"""Directory trees: a scan in rounds that deals deep and wide folders out again, and a data source with planned partitions.

``scan``: a round's tasks each take some of the known folders and walk down from them, the newest folder first, until they
have listed ``budget`` entries. Folders that they found and did not come to are the next round's, dealt to all tasks
again. A chain of folders is walked by one task in few rounds; a folder whose subfolders hold everything is spread
over all of them. A task holds at most ``STACK`` folders; further ones go to the next round at once. Entries of a folder on a mount are read one by one, so a
folder of any size takes no memory; other file systems list a folder at a time, by Arrow. A round is a table in the scratch folder.

Cases: links are neither followed nor listed; folders that can't be read or have gone are left out, as are entries that
vanish while they are listed; empty files are listed, empty folders give no rows; a root that is a file, or isn't there, gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallystone.sources import scratch

#: Entries that a task lists before it leaves what is below to the next round.
BUDGET = 200_000
#: Folders that a task keeps for itself.
STACK = 10_000
#: Rows of a frame that a task hands on.
ROWS = 10_000

LISTED = "path string, size long, mtime timestamp"

#: A file, or a folder that is still to be listed (without a size).
Entry = tuple[str, int | None, int]


def store(uri: str):
    """Arrow's file system for a URI, and the path in it; None for a mount."""
    local = uri.removeprefix("file://").removeprefix("file:")
    if "://" not in local:
        return None, local
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def entries(system, folder: str) -> Iterator[Entry]:
    """Path, size and microseconds of change of what is in a folder."""
    if system is None:
        try:
            with os.scandir(folder) as found:
                for entry in found:
                    try:
                        if entry.is_dir(follow_symlinks=False):
                            yield entry.path, None, 0
                        elif entry.is_file(follow_symlinks=False):
                            stat = entry.stat(follow_symlinks=False)
                            yield entry.path, stat.st_size, stat.st_mtime_ns // 1000
                    except OSError:
                        continue
        except OSError:
            return
        return
    from pyarrow import fs

    try:
        found = system.get_file_info(fs.FileSelector(folder))
    except OSError:
        return
    for entry in found:
        if entry.type == fs.FileType.Directory:
            yield entry.path, None, 0
        elif entry.is_file:
            yield entry.path, entry.size, (entry.mtime_ns or 0) // 1000


def walk(system, folders: Iterator[str], budget: int) -> Iterator[Entry]:
    """Files below ``folders``, and the folders that were not listed when ``budget`` entries had been."""
    listed = 0
    for top in folders:
        stack = [top]
        while stack:
            folder = stack.pop()
            if listed >= budget:
                yield folder, None, 0
                continue
            listed += 1
            for entry in entries(system, folder):
                listed += 1
                if entry[1] is None and len(stack) < STACK:
                    stack.append(entry[0])
                else:
                    yield entry


def _frames(found: Iterator[Entry]) -> Iterator[pd.DataFrame]:
    rows: list[Entry] = []

    def frame() -> pd.DataFrame:
        paths, sizes, times = zip(*rows, strict=True)
        return pd.DataFrame({"path": paths, "size": pd.array(sizes, "Int64"), "mtime": pd.to_datetime(list(times), unit="us", utc=True)})

    for entry in found:
        rows.append(entry)
        if len(rows) == ROWS:
            yield frame()
            rows = []
    if rows:
        yield frame()


def scan(spark: SparkSession, root: str, budget: int = BUDGET, width: int | None = None) -> DataFrame:
    """Every file below ``root``: path, size, mtime. ``width``: tasks of a round, by default four a core.

    The driver learns how many folders are left after a round, no more.
    """
    _, top = store(root)
    width = width or 4 * spark.sparkContext.defaultParallelism

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = store(root)
        yield from _frames(walk(system, (p for frame in frames for p in frame["path"]), budget))

    folders, left, rounds = spark.createDataFrame([(top,)], "path string"), 1, []
    while left:
        # by number within a task rather than by hash, so that few folders go to as many tasks
        dealt = folders.repartition(min(left, width)) if left > 1 else folders.coalesce(1)
        done = scratch.written(dealt.mapInPandas(step, LISTED), "tree")
        rounds.append(done.where("size IS NOT NULL"))
        folders = done.where("size IS NULL").select("path")
        left = folders.count()
    whole = rounds[0]
    for one in rounds[1:]:
        whole = whole.unionByName(one)
    return whole


class _Folders(InputPartition):
    def __init__(self, folders: list[str], files: list[Entry]):
        super().__init__(None)
        self.folders, self.files = folders, files


class _TreeReader(DataSourceReader):
    def __init__(self, root: str, partitions: int, planned: int):
        self.root, self.many, self.planned = root, partitions, planned

    def partitions(self) -> list[InputPartition]:
        """Folders level by level from the root, until there are several for each partition or ``planned`` entries were listed."""
        system, top = store(self.root)
        level, files, listed = [top], [], 0
        while level and len(level) < 4 * self.many and listed < self.planned:
            below = []
            for at, folder in enumerate(level):
                if listed >= self.planned:
                    below.extend(level[at:])
                    break
                listed += 1
                for entry in entries(system, folder):
                    listed += 1
                    if entry[1] is None:
                        below.append(entry[0])
                    else:
                        files.append(entry)
            level = below
        parts = [_Folders(level[k :: self.many], files[k :: self.many]) for k in range(self.many)]
        return [p for p in parts if p.folders or p.files] or [_Folders([], [])]

    def read(self, partition: _Folders) -> Iterator[tuple]:
        from datetime import datetime, timedelta, timezone

        system, _ = store(self.root)
        start = datetime(1970, 1, 1, tzinfo=timezone.utc)
        for files in (partition.files, walk(system, iter(partition.folders), 1 << 62)):
            stack = list(files) if files is partition.files else files
            for path, size, micros in stack:
                if size is None:  # beyond what the walk keeps
                    yield from ((p, s, start + timedelta(microseconds=m)) for p, s, m in _whole(system, path))
                else:
                    yield path, size, start + timedelta(microseconds=micros)


def _whole(system, folder: str) -> Iterator[Entry]:
    for entry in walk(system, iter([folder]), 1 << 62):
        if entry[1] is None:
            yield from _whole(system, entry[0])
        else:
            yield entry


class TreeSource(DataSource):
    """``spark.read.format("tree").load(root)``: files of a tree of even depth, planned by the driver. Options ``partitions``
    (64) and ``planned`` (10000 entries that the driver lists at most, but for the rest of the folder it is in); a folder
    that is deeper than the others is one task's, which ``scan`` avoids."""

    @classmethod
    def name(cls) -> str:
        return "tree"

    def schema(self) -> str:
        return LISTED

    def reader(self, schema) -> DataSourceReader:
        if "path" not in self.options:
            raise ValueError("the tree's root is missing: load(root)")
        return _TreeReader(self.options["path"], int(self.options.get("partitions", 64)), int(self.options.get("planned", 10_000)))


def register(spark: SparkSession) -> None:
    """Make ``format("tree")`` known to a session."""
    spark.dataSource.register(TreeSource)


def by_folder(files: DataFrame, root: str) -> DataFrame:
    """``folder, files, bytes`` of each folder with files, its path below ``root``; hidden files (``.x``, ``_x``) don't count."""
    _, top = store(root)
    below = F.expr(f"substring(path, {len(top.rstrip('/')) + 2})")
    name = F.substring_index("path", "/", -1)
    rows = files.where(~name.startswith(".") & ~name.startswith("_")).select(below.alias("below"), "size")
    folder = F.regexp_extract("below", r"^(.*)/[^/]*$", 1)
    return rows.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
