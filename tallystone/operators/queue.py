"""Work-queue lifecycle as functions: add, claim, reset, finish, remove. Nothing is locked; work is dealt by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.operators.catalogue import Change, eligible, finished


def with_new(queue: DataFrame, paths: DataFrame, as_of: Column) -> Change:
    """Append the paths that aren't queued; adding twice adds nothing."""
    fresh = paths.select("pth").dropDuplicates().join(queue, "pth", "left_anti")
    rows = fresh.select("pth", F.lit(None).cast("timestamp_ntz").alias("claimed_at"), F.lit(None).cast("string").alias("claimed_by"), as_of.alias("created_at"))
    return Change(queue.unionByName(rows), rows)


def add_eligible(queue: DataFrame, fs: DataFrame, as_of: Column) -> Change:
    return with_new(queue, fs.where(eligible()), as_of)


def add_mains(queue: DataFrame, fs: DataFrame, as_of: Column) -> Change:
    """All main files without a blob, whatever their path."""
    return with_new(queue, fs.where("main AND blobid IS NULL"), as_of)


def populate(queue: DataFrame, fs: DataFrame, as_of: Column, duplicates: bool = False) -> Change:
    return with_new(queue, fs.where(F.col("blobid").isNull() & (F.lit(duplicates) | F.col("main"))), as_of)


def already_queued(queue: DataFrame, fs: DataFrame) -> DataFrame:
    """Needed, queued of these, and to add."""
    flag = queue.select("pth", F.lit(1).alias("_q")).dropDuplicates()
    need = fs.where("main AND blobid IS NULL").join(flag, "pth", "left")
    return need.agg(F.count("*").alias("needed"), F.count("_q").alias("queued"), (F.count("*") - F.count("_q")).alias("to_add"))


def reset_stale(queue: DataFrame, as_of: Column, minutes: int = 30) -> Change:
    """Claims strictly older than the threshold are given up; the delta has the claims as they were."""
    stale = F.coalesce(F.col("claimed_at") < as_of - F.make_dt_interval(mins=F.lit(minutes)), F.lit(False))
    state = queue.select(
        "pth",
        F.when(~stale, F.col("claimed_at")).alias("claimed_at"),
        F.when(~stale, F.col("claimed_by")).alias("claimed_by"),
        "created_at",
    )
    return Change(state, queue.where(stale))


def setup(queue: DataFrame, fs: DataFrame, as_of: Column, minutes: int = 30) -> Change:
    """Seed an empty queue with eligible files; of one that has entries, give up stale claims."""
    return add_eligible(queue, fs, as_of) if queue.isEmpty() else reset_stale(queue, as_of, minutes)


def finish_batch(queue: DataFrame, fs: DataFrame, results: DataFrame, as_of: Column) -> tuple[Change, Change]:
    """Take over ``results(pth, blobid, error)``: catalogue and queue after them.

    A result without an error gives its blob; an error that says "not found" marks the file missing; other errors change
    nothing in the catalogue. Every path that has a result leaves the queue. Of several results of a path a success counts.
    """
    one = results.groupBy("pth").agg(F.min(F.struct(F.col("error").isNotNull().alias("failed"), F.col("blobid").alias("new"), "error")).alias("_r"))
    joined = fs.join(one, "pth", "left")
    done = F.coalesce(~F.col("_r.failed"), F.lit(False))
    gone = F.coalesce(F.col("_r.failed") & F.lower("_r.error").contains("not found"), F.lit(False))
    changed = (
        joined.withColumn("_hit", done | gone)
        .withColumn("uploaded", F.when(done, as_of).otherwise(F.col("uploaded")))
        .withColumn("blobid", F.when(done, F.col("_r.new")).otherwise(F.col("blobid")))
        .withColumn("last_missing_at", F.when(gone, as_of).otherwise(F.col("last_missing_at")))
    )
    return Change(changed.select(*fs.columns), changed.where("_hit").select(*fs.columns)), remove(queue, one)


def claim_at(queue: DataFrame, offset: int) -> DataFrame:
    """The unclaimed path at a place in order of paths."""
    return queue.where("claimed_at IS NULL").orderBy("pth").offset(offset).limit(1)


def claim_random(queue: DataFrame, seed: int, candidates: int = 500) -> DataFrame:
    """One of the first ``candidates`` unclaimed paths, by a hash that ``seed`` changes: the same in every run."""
    first = queue.where("claimed_at IS NULL").orderBy("pth").limit(candidates)
    return first.orderBy(F.xxhash64("pth", F.lit(seed)), "pth").limit(1)


def reset_processing(fs: DataFrame, as_of: Column, minutes: int = 60) -> Change:
    stale = F.coalesce(F.col("blobid").isNull() & (F.col("processing_started") < as_of - F.make_dt_interval(mins=F.lit(minutes))), F.lit(False))
    return Change(fs.withColumn("processing_started", F.when(~stale, F.col("processing_started"))), fs.where(stale))


def claim(queue: DataFrame, fs: DataFrame, worker: str, as_of: Column, limit: int, workers: int = 1, number: int = 0) -> Change:
    """The ``limit`` smallest unclaimed files of this worker's share (``number`` of ``workers``, by hash of the path)."""
    share = F.pmod(F.crc32("pth"), F.lit(workers)) == number
    free = queue.where(F.col("claimed_at").isNull() & share).join(fs.select("pth", "size"), "pth", "left")
    chosen = free.orderBy("size", "pth").limit(limit).select("pth", "size")
    joined = queue.join(chosen.select("pth", F.lit(True).alias("_c")), "pth", "left")
    state = joined.select(
        "pth",
        F.when(F.col("_c"), as_of).otherwise(F.col("claimed_at")).alias("claimed_at"),
        F.when(F.col("_c"), F.lit(worker)).otherwise(F.col("claimed_by")).alias("claimed_by"),
        "created_at",
    )
    return Change(state, chosen)


def sample_unclaimed(queue: DataFrame, fraction: float, seed: int) -> DataFrame:
    """A share of the unclaimed, by a hash of the path; it may be empty although work remains."""
    return queue.where("claimed_at IS NULL").where(F.pmod(F.xxhash64("pth", F.lit(seed)), F.lit(1_000_000)) < fraction * 1_000_000)


def remove_completed(queue: DataFrame, fs: DataFrame, kind: str = "missing") -> Change:
    done = fs.where(finished(kind)).select("pth")
    return Change(queue.join(done, "pth", "left_anti"), queue.join(done, "pth", "left_semi"))


def remove(queue: DataFrame, paths: DataFrame) -> Change:
    return Change(queue.join(paths.select("pth"), "pth", "left_anti"), queue.join(paths.select("pth"), "pth", "left_semi"))


def maintain(queue: DataFrame, fs: DataFrame, as_of: Column) -> DataFrame:
    """One cycle: give up stale claims, add new files, remove completed ones."""
    return remove_completed(add_eligible(reset_stale(queue, as_of).state, fs, as_of).state, fs).state


def stats(queue: DataFrame) -> DataFrame:
    return queue.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("claimed_at").isNull()).alias("unclaimed"),
        F.count("claimed_at").alias("claimed"),
        F.min("claimed_at").alias("oldest_claim"),
        F.max("claimed_at").alias("newest_claim"),
    )


def claims_by_worker(queue: DataFrame) -> DataFrame:
    return queue.where("claimed_by IS NOT NULL").groupBy("claimed_by").agg(F.count("*").alias("claims"))


def summary(queue: DataFrame, fs: DataFrame) -> DataFrame:
    """Of queued files: completed, pending, missing (a file may be completed and missing), and progress in percent."""
    rows = queue.select("pth").join(fs, "pth")
    done, gone = F.col("blobid").isNotNull(), F.col("last_missing_at").isNotNull()
    counted = rows.agg(F.count_if(done).alias("completed"), F.count_if(~done & ~gone).alias("pending"), F.count_if(gone).alias("missing"))
    total = F.col("completed") + F.col("pending") + F.col("missing")
    return counted.withColumn("progress", F.coalesce(F.round(F.try_divide(100.0 * (F.col("completed") + F.col("missing")), total), 1), F.lit(0.0)))


def commit_claim(table, fs: DataFrame, worker: str, as_of: Column, limit: int, workers: int = 1, number: int = 0) -> int | None:
    """``claim`` on a ``SnapshotTable`` of the queue: the version in which the claimed rows are this worker's, or None.

    Two drivers never claim one path: of two claims made from one version, the second is made again from what the first left.
    """
    from tallystone.sources.snapshots import Rows

    def change(queue: DataFrame) -> Rows:
        chosen = claim(queue, fs, worker, as_of, limit, workers, number).delta
        rows = queue.join(chosen.select("pth"), "pth", "left_semi")
        return Rows(put=rows.withColumn("claimed_at", as_of).withColumn("claimed_by", F.lit(worker)))

    return table.transact(change, f"claim by {worker}")


def commit_processing(table, seed: int, as_of: Column, candidates: int = 500) -> int | None:
    """Mark one of the catalogue's first ``candidates`` eligible files that nobody processes as being processed; None if there is none."""
    from tallystone.sources.snapshots import Rows

    def change(fs: DataFrame) -> Rows:
        free = fs.where(eligible() & F.col("processing_started").isNull()).orderBy("pth").limit(candidates)
        return Rows(put=free.orderBy(F.xxhash64("pth", F.lit(seed)), "pth").limit(1).withColumn("processing_started", as_of))

    return table.transact(change, "processing")


def commit_finished(table, paths: DataFrame) -> int | None:
    """Take paths out of the queue, whatever others do to it meanwhile."""
    from tallystone.sources.snapshots import Rows

    return table.transact(lambda queue: Rows(drop=paths.select("pth").distinct()), "finished", reads_all=False)
