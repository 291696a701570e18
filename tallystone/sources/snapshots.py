"""Tables that several drivers change: versions of immutable files, each committed by one put that fails if it is there.

A table is a folder. ``data/`` holds Parquet by bucket of the key; ``versions/<n>.json`` names, for each bucket, the folder
that holds it in version n. A change writes the buckets that it touches under a new name and then puts version n + 1. Of
two drivers that put the same version one wins; the other's change is made again from what the winner left, or, if it
depends on nothing but its own buckets and these are untouched, put on top of it as it is. Readers see whole versions. A
writer that dies leaves files that no version names, which ``vacuum`` removes later.

The put is a hard link on a mounted file system, which all drivers must share, and elsewhere a rename that doesn't
replace, which HDFS does in one step.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(Exception):
    """Another driver's version came first, too many times."""


@dataclass
class Rows:
    """A change: rows that replace those of their keys or are new, and keys that go."""

    put: DataFrame | None = None
    drop: DataFrame | None = None


class _Files:
    """The driver's view of the table's file system."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self.jvm, self.conf = jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(self.conf)
        self.local = self.fs.getUri().getScheme() == "file"

    def bare(self, path: str) -> str:
        return self.path(path).toUri().getPath()

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> bool:
        """Whether ``path`` was absent and now has ``text``, all of it."""
        temporary = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self.fs.create(self.path(temporary), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if self.local:
                os.link(self.bare(temporary), self.bare(path))
            else:
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
                options = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
                context.rename(self.path(temporary), self.path(path), options)
            return True
        except FileExistsError:
            return False
        except Exception as e:  # the JVM's
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            self.remove(temporary)

    def remove(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def age(self, path: str) -> float:
        return time.time() - self.fs.getFileStatus(self.path(path)).getModificationTime() / 1000


class SnapshotTable:
    """A table with one row a key (no nulls), in ``buckets`` by the key's hash."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = _Files(spark, self.root)

    @classmethod
    def create(cls, rows: DataFrame, root: str, key: str, buckets: int = 16) -> SnapshotTable:
        """Version 0; raises ``Conflict`` if the table exists."""
        table = cls(rows.sparkSession, root)
        folder = f"data/{uuid.uuid4().hex}"
        found = table._write(rows, folder, key, buckets)
        meta = {"version": 0, "key": key, "buckets": buckets, "schema": rows.schema.jsonValue(), "operation": "create", "touched": sorted(found), "folders": {str(b): folder for b in found}}
        if not table._put(meta):
            raise Conflict(f"{root} exists")
        return table

    # --- versions
    def latest(self) -> int:
        numbers = [int(n[:-5]) for n in self.files.names(f"{self.root}/versions") if n.endswith(".json")]
        if not numbers:
            raise FileNotFoundError(self.root)
        return max(numbers)

    def manifest(self, version: int | None = None) -> dict:
        return json.loads(self.files.read(self._version(self.latest() if version is None else version)))

    def history(self) -> list[dict]:
        """Versions in order, with what they touched."""
        kept = [int(n[:-5]) for n in self.files.names(f"{self.root}/versions") if n.endswith(".json")]
        return [{k: m[k] for k in ("version", "operation", "touched")} for m in map(self.manifest, sorted(kept))]

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.manifest(version))

    def read_keys(self, keys: list, version: int | None = None) -> DataFrame:
        """The rows of some keys; only their buckets are read."""
        meta = self.manifest(version)
        schema = T.StructType([f for f in T.StructType.fromJson(meta["schema"]) if f.name == meta["key"]])
        wanted = self.spark.createDataFrame([(k,) for k in keys], schema)
        buckets = {r[0] for r in wanted.select(self._bucket(meta)).distinct().collect()}
        return self._read(meta, buckets).join(F.broadcast(wanted), meta["key"], "left_semi")

    # --- changes
    def transact(self, change: Callable[[DataFrame], Rows | None], operation: str = "change", reads_all: bool = True, retries: int = 20) -> int | None:
        """Commit what ``change`` makes of the table's rows; the new version, or None where it changes nothing.

        ``change`` may be called several times, each time with a later version. With ``reads_all`` false it says that its
        rows depend on nothing but rows of the same buckets; then a conflict with versions that touched others needs no
        new call.
        """
        base, prepared = None, None
        for _ in range(retries):
            meta = self.manifest()
            if prepared is not None and not reads_all:
                between = set()
                for v in range(base + 1, meta["version"] + 1):
                    between |= set(self.manifest(v)["touched"])
                if between & set(prepared["touched"]):
                    prepared = None
            else:
                prepared = None
            if prepared is None:
                prepared = self._prepare(change(self._read(meta)), meta)
                if prepared is None:
                    return None
            base = meta["version"]
            folders = {b: f for b, f in meta["folders"].items() if int(b) not in prepared["touched"]} | {str(b): prepared["folder"] for b in prepared["found"]}
            after = meta | {"version": base + 1, "operation": operation, "touched": prepared["touched"], "folders": folders}
            if self._put(after):
                return base + 1
        raise Conflict(f"{retries} versions came first")

    def _prepare(self, rows: Rows | None, meta: dict) -> dict | None:
        """Write the buckets that ``rows`` touch as they will be."""
        if rows is None:
            return None
        key, folder = meta["key"], f"data/{uuid.uuid4().hex}"
        schema = T.StructType.fromJson(meta["schema"])
        puts = rows.put.select(*schema.names) if rows.put is not None else self.spark.createDataFrame([], schema)
        drops = rows.drop.select(key) if rows.drop is not None else puts.select(key).limit(0)
        # written once: all that follows reads the same rows
        staged = f"{self.root}/{folder}/staged"
        puts.withColumn("_put", F.lit(True)).unionByName(drops.withColumn("_put", F.lit(False)), allowMissingColumns=True).write.parquet(staged)
        staged = self.spark.read.schema(T.StructType([*schema, T.StructField("_put", T.BooleanType())])).parquet(staged)
        per = staged.groupBy(key).agg(F.count_if("_put").alias("n"))
        facts = per.groupBy(self._bucket(meta).alias("b")).agg(F.max("n").alias("n"), F.max(F.col(key).isNull()).alias("nulls")).collect()
        if any(r["n"] > 1 or r["nulls"] for r in facts):
            raise ValueError(f"each key of a change must be there once, and not null: {key}")
        if not facts:
            self.files.remove(f"{self.root}/{folder}")
            return None
        touched = sorted(r["b"] for r in facts)
        kept = self._read(meta, set(touched)).join(staged.select(key), key, "left_anti")
        found = self._write(kept.unionByName(staged.where("_put").drop("_put")), f"{folder}", key, meta["buckets"])
        self.files.remove(f"{self.root}/{folder}/staged")
        return {"touched": touched, "found": found, "folder": folder}

    def vacuum(self, keep: int = 2, older_than_s: float = 7 * 86400) -> list[str]:
        """Forget all but the last ``keep`` versions, and remove folders that no kept version names.

        Folders younger than ``older_than_s`` stay: a writer may be about to commit them.
        """
        last = self.latest()
        kept = range(max(0, last - keep + 1), last + 1)
        named = {f for v in kept for f in self.manifest(v)["folders"].values()}
        for name in self.files.names(f"{self.root}/versions"):
            if name.endswith(".json") and int(name[:-5]) not in kept:
                self.files.remove(f"{self.root}/versions/{name}")
        gone = [f"data/{n}" for n in self.files.names(f"{self.root}/data") if f"data/{n}" not in named and self.files.age(f"{self.root}/data/{n}") >= older_than_s]
        for folder in gone:
            self.files.remove(f"{self.root}/{folder}")
        return gone

    # --- files
    def _version(self, number: int) -> str:
        return f"{self.root}/versions/{number:020d}.json"

    def _put(self, meta: dict) -> bool:
        return self.files.put(self._version(meta["version"]), json.dumps(meta))

    def _bucket(self, meta: dict):
        return F.pmod(F.xxhash64(meta["key"]), F.lit(meta["buckets"])).cast("int")

    def _read(self, meta: dict, buckets: set[int] | None = None) -> DataFrame:
        paths = [f"{self.root}/{f}/_bucket={b}" for b, f in meta["folders"].items() if buckets is None or int(b) in buckets]
        schema = T.StructType.fromJson(meta["schema"])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, folder: str, key: str, buckets: int) -> list[int]:
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        rows.withColumn("_bucket", bucket).repartition("_bucket").write.mode("append").partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        return sorted(int(n.removeprefix("_bucket=")) for n in self.files.names(f"{self.root}/{folder}") if n.startswith("_bucket="))
