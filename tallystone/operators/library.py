"""Changesets, hard-link groups and upload state over ``files``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.operators.catalogue import Change


def _packed(ids: Column) -> Column:
    """Bytes in the order of the strings: 64 lower-case hex digits become 32 bytes and 1.

    Any other string goes before (0) or after (2) the digits next to it, and is kept whole behind them.
    """
    digits = F.regexp_extract(ids, "^[0-9a-f]{0,64}", 0)
    following = F.substr(ids, F.length(digits) + 1, F.lit(1))
    padded = lambda start, digit, mark: F.concat(F.unhex(F.rpad(start, 64, digit)), F.unhex(F.lit(mark)), ids.cast("binary"))
    return (
        F.when(ids.rlike("^[0-9a-f]{64}\\z"), F.concat(F.unhex(ids), F.unhex(F.lit("01"))))
        .when((F.length(digits) < 64) & (following < "0"), padded(digits, "0", "00"))
        .when((F.length(digits) < 64) & (following < "a"), padded(F.concat(digits, F.lit("9")), "f", "02"))
        .otherwise(padded(digits, "f", "02"))
    )


def _digits(keys: pa.Array) -> np.ndarray | None:
    """32 bytes a row; nothing where one of the ids is something else than 64 digits."""
    if keys.null_count or pc.any(pc.not_equal(pc.binary_length(keys), 33)).as_py():
        return None
    fixed = keys.cast(pa.binary(33))
    rows = np.frombuffer(fixed.buffers()[1], np.uint8)[33 * fixed.offset :][: 33 * len(fixed)].reshape(-1, 33)
    return rows[:, :32] if (rows[:, 32] == 1).all() else None


def _joined(keys: pa.Array, last: bytes | None) -> tuple[list[bytes], bytes | None]:
    """The different ids of sorted keys behind ``last``, joined by commas (a list of one, or of none), and the last key."""
    rows = _digits(keys)
    if rows is None:
        new = list(dict.fromkeys(x for x in keys.to_pylist() if x is not None and x != last))
        return [b",".join(x[:32].hex().encode() if x[32] == 1 else x[33:] for x in new)][: len(new)], new[-1] if new else last
    new = rows[np.append(rows[0].tobytes() + b"\x01" != last, (rows[1:] != rows[:-1]).any(axis=1))]
    return [new.tobytes().hex(",", 32).encode()][: len(new)], rows[-1].tobytes() + b"\x01"


def _content_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each changeset's different ids with commas between; rows come sorted, and none are kept."""
    began, current, last, digest = False, None, None, hashlib.sha256()
    for batch in batches:
        done, (changes, keys) = [], batch.columns
        for start, end in pairwise([0, *pc.run_end_encode(changes).run_ends.to_pylist()]):
            changeset = changes[start].as_py()
            if began and changeset != current:
                done.append((current, digest.hexdigest()))
                last, digest = None, hashlib.sha256()
            before = b"," if last is not None else b""
            found, last = _joined(keys.slice(start, end - start), last)
            digest.update(b"".join([before, *found]) if found else b"")
            began, current = True, changeset
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], changes.type), pa.array([x for _, x in done])], ["changeset_id", "content_hash"])
    if began:
        yield pa.RecordBatch.from_arrays([pa.array([current], changes.type), pa.array([digest.hexdigest()])], ["changeset_id", "content_hash"])


def changesets(files: DataFrame) -> DataFrame:
    """One row per changeset, with a content hash over its sorted file ids.

    A hash over a sorted list is made in order, so the ids of a changeset are sorted by one task, which spills, and flow through the hash.
    """
    rows = files.select("changeset_id", _packed(F.col("file_id")).alias("key")).repartition("changeset_id").sortWithinPartitions("changeset_id", "key")
    found = rows.mapInArrow(_content_hashes, T.StructType([files.schema["changeset_id"], T.StructField("content_hash", T.StringType())]))
    return found.select("changeset_id", F.concat(F.lit("changeset "), "changeset_id").alias("name"), "content_hash", F.lit("pending").alias("status"))


def stats(files: DataFrame) -> DataFrame:
    return files.groupBy("changeset_id").agg(F.count("path").alias("file_count"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_size"))


def status(files: DataFrame) -> DataFrame:
    return files.groupBy("changeset_id").agg(
        F.count("*").alias("files"),
        F.count("upload_finish_tm").alias("completed"),
        F.count("upload_start_tm").alias("started"),
        F.count_if("is_canonical").alias("canonical"),
        F.count_if(F.col("is_canonical") & F.col("upload_finish_tm").isNotNull()).alias("canonical_completed"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_size"),
    )


def needing_upload(files: DataFrame) -> DataFrame:
    return files.where("is_canonical AND upload_finish_tm IS NULL")


def stuck(files: DataFrame, as_of: Column, hours: int = 1) -> DataFrame:
    return files.where(F.col("is_canonical") & F.col("upload_finish_tm").isNull() & (F.col("upload_start_tm") < as_of - F.make_dt_interval(hours=F.lit(hours))))


def upload_state() -> Column:
    return F.when(F.col("upload_start_tm").isNull(), "not_started").when(F.col("upload_finish_tm").isNull(), "in_progress").otherwise("completed")


def hardlink_groups(files: DataFrame) -> DataFrame:
    grouped = files.groupBy("changeset_id", "st_dev", "st_inode").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return grouped.where(F.size("paths") > 1)


def canonical(files: DataFrame) -> DataFrame:
    """The smallest path of a group is its canonical one; all share its file id."""
    own = F.min("path").over(Window.partitionBy("changeset_id", "st_dev", "st_inode"))
    return files.withColumn("canonical_path", own).withColumn("is_canonical", F.col("path") == F.col("canonical_path"))


def dedup_ratio(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("files"), F.countDistinct("changeset_id", "st_dev", "st_inode").alias("inodes")).withColumn(
        "ratio", F.round(F.try_divide(F.col("files").cast("double"), F.col("inodes")), 6)
    )


def mark_started(files: DataFrame, file_ids: DataFrame, as_of: Column) -> Change:
    """Canonical paths of these file ids."""
    joined = files.join(file_ids.select("file_id", F.lit(True).alias("_m")).dropDuplicates(), "file_id", "left")
    hit = F.coalesce(F.col("_m") & F.col("is_canonical"), F.lit(False))
    changed = joined.withColumn("upload_start_tm", F.when(hit, as_of).otherwise(F.col("upload_start_tm")))
    return Change(changed.select(*files.columns), changed.where(hit).select(*files.columns))


def mark_completed(files: DataFrame, file_ids: DataFrame, as_of: Column) -> Change:
    """All paths of these file ids: the whole hard-link group."""
    joined = files.join(file_ids.select("file_id", F.lit(True).alias("_m")).dropDuplicates(), "file_id", "left")
    changed = joined.withColumn("upload_finish_tm", F.when(F.col("_m"), as_of).otherwise(F.col("upload_finish_tm")))
    return Change(changed.select(*files.columns), changed.where("_m").select(*files.columns))


def success_rate(files: DataFrame) -> DataFrame:
    return files.groupBy("changeset_id").agg(F.round(F.count("upload_finish_tm") * 100.0 / F.count("*"), 6).alias("rate"))


def seconds_by_size(files: DataFrame) -> DataFrame:
    took = F.expr("timestampdiff(SECOND, upload_start_tm, upload_finish_tm)")
    return files.where("upload_finish_tm IS NOT NULL").groupBy("size").agg(F.round(F.avg(took), 6).alias("avg_seconds"), F.count("*").alias("n"))


def from_catalogue(fs: DataFrame) -> DataFrame:
    """The catalogue's columns under the library's names."""
    return fs.select(
        F.col("pth").alias("path"), F.col("tree").alias("st_dev"), F.col("inode").alias("st_inode"), "size", F.col("mtime"), F.col("hash").alias("file_hash"), F.col("main").alias("is_canonical")
    )
