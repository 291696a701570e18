"""Chains of changesets: ids that hash a manifest and the id before, verification of every link, and replay from checkpoints.

``actions(dataset, seq, pth, action, blobid)`` is the log: in each changeset (a dataset's ``seq``) a path is written or
removed at most once. ``chain(dataset, seq, manifest, id, previous_id)`` is what was recorded of it. Making ids is an
ordered fold, one dataset at a time, that holds one id; checking them needs no order, as each recorded link can be
checked alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of a path's hash that name its bucket: a manifest is hashed by buckets, then over these.
DIGITS = 3
#: Changesets of one folder of a stored log.
BLOCK = 16


def _line() -> Column:
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("pth", "action", "blobid")]
    # lengths keep lines apart whatever the names hold
    return F.sha2(F.encode(F.concat_ws(":", *(F.octet_length(p).cast("string") for p in parts), *parts), "utf-8"), 256)


def manifests(actions: DataFrame, digits: int = DIGITS) -> DataFrame:
    """``dataset, seq, manifest, actions``: a hash of all actions of a changeset, in any order.

    Each bucket of paths is hashed by itself, so that no row holds a changeset.
    """
    rows = actions.select("dataset", "seq", F.substring(F.sha2(F.encode(F.coalesce("pth", F.lit("")), "utf-8"), 256), 1, digits).alias("bucket"), _line().alias("line"))
    buckets = rows.groupBy("dataset", "seq", "bucket").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("line")), "").cast("binary"), 256).alias("part"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("bucket", "part"))), lambda b: F.concat(b["bucket"], b["part"]))
    return buckets.groupBy("dataset", "seq").agg(F.sha2(F.array_join(parts, "").cast("binary"), 256).alias("manifest"), F.sum("n").alias("actions"))


def identity(manifest: Column, previous: Column) -> Column:
    """The id of a changeset; the first of a dataset has no previous one."""
    return F.sha2(F.concat(manifest, F.coalesce(previous, F.lit(""))).cast("binary"), 256)


def extend(fresh: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """``dataset, seq, manifest, id, previous_id`` for new ``fresh(dataset, seq, manifest)`` in order of ``seq``.

    ``heads(dataset, id)``: where each dataset's chain ends so far. Each id needs the one before, so a dataset is folded in
    order; the fold streams over sorted rows and holds one id.
    """
    rows = fresh.select("dataset", "seq", "manifest")
    if heads is None:
        rows = rows.withColumn("head", F.lit(None).cast("string"))
    else:
        rows = rows.join(heads.select("dataset", F.col("id").alias("head")), "dataset", "left")

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dataset, previous = object(), None
        for part in parts:
            found, before = [], []
            for own, manifest, head in zip(part["dataset"], part["manifest"], part["head"], strict=True):
                if own != dataset:
                    dataset, previous = own, head if isinstance(head, str) else None
                before.append(previous)
                previous = hashlib.sha256((manifest + (previous or "")).encode()).hexdigest()
                found.append(previous)
            yield part[["dataset", "seq", "manifest"]].assign(id=found, previous_id=pd.Series(before, index=part.index, dtype=object))

    kind, number = (rows.schema[c].dataType.simpleString() for c in ("dataset", "seq"))
    ordered = rows.repartition("dataset").sortWithinPartitions("dataset", "seq")
    return ordered.mapInPandas(fold, f"dataset {kind}, seq {number}, manifest string, id string, previous_id string")


def verify(chain: DataFrame, actions: DataFrame, digits: int = DIGITS) -> DataFrame:
    """``dataset, seq, status`` for each recorded changeset; the first that holds:

    ``manifest``: the actions don't have the recorded hash; ``id``: manifest and previous id don't give the id;
    ``genesis``: no previous id, but not the first; ``missing``: the previous changeset is not there, or not before it;
    ``fork``: another changeset follows the same one; else ``ok``.
    """
    made = manifests(actions, digits).select("dataset", "seq", F.col("manifest").alias("made"))
    known = chain.groupBy("dataset", F.col("id").alias("previous_id")).agg(F.min("seq").alias("before"))
    first = chain.groupBy("dataset").agg(F.min("seq").alias("first"))
    after = chain.where("previous_id IS NOT NULL").groupBy("dataset", "previous_id").agg(F.count("*").alias("followers"))
    rows = chain.join(made, ["dataset", "seq"], "left").join(first, "dataset")
    rows = rows.join(known, ["dataset", "previous_id"], "left").join(after, ["dataset", "previous_id"], "left")
    status = (
        F.when(~F.col("manifest").eqNullSafe(F.coalesce("made", F.sha2(F.lit(b""), 256))), "manifest")
        .when(~F.col("id").eqNullSafe(identity(F.col("manifest"), F.col("previous_id"))), "id")
        .when(F.col("previous_id").isNull() & (F.col("seq") > F.col("first")), "genesis")
        .when(F.col("previous_id").isNotNull() & ~F.coalesce(F.col("before") < F.col("seq"), F.lit(False)), "missing")
        .when(F.col("followers") > 1, "fork")
        .otherwise("ok")
    )
    return rows.select("dataset", "seq", status.alias("status"))


def _last(rows: DataFrame) -> DataFrame:
    found = rows.groupBy("dataset", "pth").agg(F.max_by(F.struct("action", "blobid"), "seq").alias("l"))
    return found.where("l.action = 'WRITE'").select("dataset", "pth", "l.blobid")


def checkpoint(actions: DataFrame, at: Column) -> DataFrame:
    """``dataset, seq, pth, blobid``: the whole state of each dataset as of changeset ``at``, by full replay."""
    return _last(actions.where(F.col("seq") <= at)).select("dataset", at.alias("seq"), "pth", "blobid")


def bounds(checkpoints: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``dataset, start, stop``: each dataset's latest checkpoint, and the first broken changeset after it (null: none).

    ``links(dataset, seq, status)`` as ``verify`` gives them; datasets without a checkpoint start from nothing.
    """
    start = checkpoints.groupBy("dataset").agg(F.max("seq").alias("start"))
    if links is None:
        return start.select("dataset", "start", F.lit(None).cast(start.schema["start"].dataType).alias("stop"))
    both = links.select("dataset", "seq", "status").join(start, "dataset", "left")
    late = (F.col("status") != "ok") & (F.col("start").isNull() | (F.col("seq") > F.col("start")))
    stops = both.groupBy("dataset").agg(F.min(F.when(late, F.col("seq"))).alias("stop"))
    return start.join(stops, "dataset", "full").select("dataset", "start", "stop")


def restore(actions: DataFrame, checkpoints: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``dataset, pth, blobid``: from each dataset's latest checkpoint, changesets applied up to the first broken link.

    What is broken before a checkpoint doesn't matter: the checkpoint is the whole state. With a log that ``write_log``
    wrote, only the blocks of changesets behind the checkpoint are read.
    """
    limits = bounds(checkpoints, links)
    base = checkpoints.join(limits.select("dataset", F.col("start").alias("seq")), ["dataset", "seq"], "left_semi")
    base = base.select("dataset", "seq", "pth", F.lit("WRITE").alias("action"), "blobid")
    if "block" in actions.columns:
        from_, to = F.floor(F.col("start") / BLOCK), F.floor(F.col("stop") / BLOCK)
        held = actions.select("dataset", "block").distinct().join(limits, "dataset", "left")
        held = held.where((from_.isNull() | (F.col("block") >= from_)) & (to.isNull() | (F.col("block") <= to))).select("dataset", "block")
        # a row for each folder, which the driver has listed already
        actions = actions.join(F.broadcast(held), ["dataset", "block"])
    open_ = actions.join(limits, "dataset", "left").where((F.col("start").isNull() | (F.col("seq") > F.col("start"))) & (F.col("stop").isNull() | (F.col("seq") < F.col("stop"))))
    return _last(base.unionByName(open_.select("dataset", "seq", "pth", "action", "blobid")))


def write_log(actions: DataFrame, path: str) -> None:
    """Append ``actions`` in folders of ``BLOCK`` changesets a dataset."""
    actions.withColumn("block", F.floor(F.col("seq") / BLOCK)).write.mode("append").partitionBy("dataset", "block").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
