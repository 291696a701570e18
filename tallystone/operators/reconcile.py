"""Catalogue against storage, staged listings and manifests: set differences and update joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.operators.catalogue import Change

DIRECTORY = "DIRECTORY_SKIPPED"


def known_blobs(fs: DataFrame) -> DataFrame:
    return fs.where(F.col("blobid").isNotNull() & (F.col("blobid") != DIRECTORY)).select("blobid").distinct()


def phantoms(fs: DataFrame, storage: DataFrame) -> DataFrame:
    """Blobs that the catalogue names and storage lacks."""
    return known_blobs(fs).join(storage, "blobid", "left_anti")


def orphans(fs: DataFrame, storage: DataFrame) -> DataFrame:
    return storage.select("blobid").distinct().join(known_blobs(fs), "blobid", "left_anti")


def summary(fs: DataFrame, storage: DataFrame) -> DataFrame:
    known, stored = known_blobs(fs).withColumn("k", F.lit(1)), storage.select("blobid").distinct().withColumn("s", F.lit(1))
    both = known.join(stored, "blobid", "full")
    return both.agg(F.count("k").alias("known"), F.count("s").alias("stored"), F.count_if(F.col("s").isNull()).alias("phantom"), F.count_if(F.col("k").isNull()).alias("orphan"))


def requeue_bad(fs: DataFrame, bad: DataFrame) -> Change:
    """Clear the blobs in ``bad`` from every path that has them; the delta, with the old ids, is what to queue again."""
    joined = fs.join(bad.select("blobid", F.lit(True).alias("_b")).dropDuplicates(), "blobid", "left")
    hit = F.coalesce(F.col("_b"), F.lit(False))
    state = joined.withColumn("uploaded", F.when(~hit, F.col("uploaded"))).withColumn("blobid", F.when(~hit, F.col("blobid")))
    return Change(state.select(*fs.columns), joined.where(hit).select(*fs.columns))


def requeue_summary(fs: DataFrame, bad: DataFrame) -> DataFrame:
    rows = fs.join(bad, "blobid", "left_semi").agg(F.count("*").alias("paths"), F.countDistinct("blobid").alias("bad_blobs"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    return rows.withColumn("dedup_factor", F.round(F.try_divide(F.col("paths").cast("double"), F.col("bad_blobs")), 6))


def source_of_blob(fs: DataFrame) -> DataFrame:
    """One path for each blob, from which it can be made again: the smallest."""
    return fs.where(F.col("blobid").isNotNull() & (F.col("blobid") != DIRECTORY)).groupBy("blobid").agg(F.min("pth").alias("pth"), F.count("*").alias("paths"))


def history(fs: DataFrame) -> DataFrame:
    return fs.where("blobid IS NOT NULL").groupBy("blobid").agg(F.count("*").alias("rows"), F.count("uploaded").alias("with_uploaded"), F.min("mtime").alias("min_mtime"), F.max("mtime").alias("max_mtime"))


def new_blobs(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Of ``incoming(pth, blobid)`` what must be uploaded: unknown ids, each once, by its smallest path."""
    fresh = incoming.join(stored.select("blobid").distinct(), "blobid", "left_anti")
    return fresh.groupBy("blobid").agg(F.min("pth").alias("pth"))


def mark_uploaded(fs: DataFrame, blobs: DataFrame, as_of: Column) -> Change:
    """All rows of these blobs that have no upload time get one."""
    joined = fs.join(blobs.select("blobid", F.lit(True).alias("_u")).dropDuplicates(), "blobid", "left")
    hit = F.coalesce(F.col("_u") & F.col("uploaded").isNull(), F.lit(False))
    changed = joined.withColumn("_hit", hit).withColumn("uploaded", F.when(F.col("_hit"), as_of).otherwise(F.col("uploaded")))
    return Change(changed.select(*fs.columns), changed.where("_hit").select(*fs.columns))


def update_mtime(rows: DataFrame, staged: DataFrame, key: str = "pth") -> Change:
    """Take ``mtime`` of ``staged(path, mtime)`` over where there is one (the largest, if several)."""
    new = staged.groupBy(F.col("path").alias(key)).agg(F.max("mtime").alias("_new"))
    joined = rows.join(new, key, "left")
    changed = joined.withColumn("mtime", F.coalesce("_new", "mtime") if "mtime" in rows.columns else F.col("_new"))
    columns = list(dict.fromkeys([*rows.columns, "mtime"]))
    return Change(changed.select(*columns), changed.where("_new IS NOT NULL").select(*columns))


def mtime_counts(fs: DataFrame, staged: DataFrame) -> DataFrame:
    """Labelled counts: staged, with and without a time, and rows still to update."""
    left = fs.where("mtime IS NULL").join(staged.select(F.col("path").alias("pth")), "pth", "left_semi")
    one = lambda label, n: n.select(F.lit(label).alias("label"), F.col("n"))
    counted = fs.agg(F.count("mtime").alias("with_mtime"), F.count_if(F.col("mtime").isNull()).alias("without_mtime"))
    long = counted.select(F.expr("stack(2, 'with_mtime', with_mtime, 'without_mtime', without_mtime) AS (label, n)"))
    return one("staged", staged.agg(F.count("*").alias("n"))).unionByName(long).unionByName(one("to_update", left.agg(F.count("*").alias("n"))))


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """WRITE what is new or changed, REMOVE what is gone."""
    a = old.select("pth", F.struct("blobid", "size", "mtime").alias("o"))
    b = new.select("pth", F.struct("blobid", "size", "mtime").alias("n"))
    both = a.join(b, "pth", "full")
    action = F.when(F.col("n").isNull(), "REMOVE").when(F.col("o").isNull() | ~F.col("o").eqNullSafe(F.col("n")), "WRITE")
    return both.select("pth", action.alias("action"), F.coalesce("n.blobid", "o.blobid").alias("blobid")).where("action IS NOT NULL")


def replay(log: DataFrame) -> DataFrame:
    """State after a log ``(seq, pth, action, blobid)``: the last action of each path, unless it removes."""
    last = log.groupBy("pth").agg(F.max_by(F.struct("action", "blobid"), "seq").alias("l"))
    return last.where("l.action = 'WRITE'").select("pth", "l.blobid")


def broken_links(chain: DataFrame) -> DataFrame:
    """Changesets whose predecessor is not in the chain (the first has none)."""
    known = chain.select(F.col("id").alias("previous_id"))
    return chain.where("previous_id IS NOT NULL").join(known, "previous_id", "left_anti")


def latest_status(operations: DataFrame) -> DataFrame:
    """Last operation of each blob at each installation."""
    w = Window.partitionBy("content_hash", "installation_id").orderBy(F.desc("operation_timestamp"), F.desc("operation_id"))
    return operations.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def verification_candidates(operations: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Uploaded blobs that were never verified, or not for so many days."""
    verified = F.when(F.col("operation_type") == "verification_success", F.col("operation_timestamp"))
    grouped = operations.groupBy("content_hash", "installation_id").agg(F.max(verified).alias("last_verified"), F.count_if(F.col("operation_type") == "upload_completed").alias("uploads"))
    return grouped.where(F.col("last_verified").isNull() | (F.col("last_verified") < as_of - F.make_dt_interval(days=F.lit(days))))


def grouped_by_fanout(ids: DataFrame) -> DataFrame:
    """Blob ids by the two-level folder that holds them."""
    folder = F.concat_ws("/", F.substring("blobid", 1, 2), F.substring("blobid", 3, 2))
    return ids.groupBy(folder.alias("folder")).agg(F.sort_array(F.collect_set("blobid")).alias("blobids"))


def recovery_status(missing: DataFrame, fs: DataFrame, storage: DataFrame, remade: DataFrame) -> DataFrame:
    """What became of each id of ``missing(blobid)``; ``remade(pth, new_blobid)``: ids made again from files that exist.

    In order: it is there after all; no path leads to it; the file is gone; its content has changed; it can be uploaded.
    """
    source = source_of_blob(fs).select("blobid", "pth")
    there = storage.select("blobid", F.lit(True).alias("_s")).dropDuplicates()
    rows = missing.select("blobid").distinct().join(there, "blobid", "left").join(source, "blobid", "left")
    rows = rows.join(remade.groupBy("pth").agg(F.min("new_blobid").alias("new_blobid")), "pth", "left")
    status = (
        F.when(F.col("_s"), "present")
        .when(F.col("pth").isNull(), "no_source")
        .when(F.col("new_blobid").isNull(), "source_missing")
        .when(F.col("new_blobid") != F.col("blobid"), "content_changed")
        .otherwise("recovered")
    )
    return rows.select("blobid", "pth", status.alias("status"))


def size_mismatches(fs: DataFrame, listing: DataFrame) -> DataFrame:
    """Paths whose size in ``listing(pth, disk_size)`` isn't that of the catalogue."""
    return fs.join(listing, "pth").where("size <> disk_size").select("pth", "size", "disk_size")


def chain(changesets: list[tuple[str, str]]) -> list[tuple[str, str, str | None]]:
    """Names, ids and predecessors of ``(name, manifest hash)`` in order: an id hashes its manifest and the id before it.

    Each id needs the one before it, so this is a loop, over changesets and not over their files.
    """
    import hashlib

    found, previous = [], None
    for name, manifest in changesets:
        own = hashlib.sha256((manifest + (previous or "")).encode()).hexdigest()
        found.append((name, own, previous))
        previous = own
    return found


def backend_health(copies: DataFrame, least: int) -> DataFrame:
    """Of ``copies(blobid, backend, status)``: blobs by how many backends hold them, against the number asked for."""
    held = copies.groupBy("blobid").agg(F.countDistinct(F.when(F.col("status") == "uploaded", F.col("backend"))).alias("held"))
    state = F.when(F.col("held") >= least, "healthy").when(F.col("held") > 0, "degraded").otherwise("lost")
    return held.select("blobid", "held", state.alias("health"))


def pending_copies(copies: DataFrame, backend: str | None = None) -> DataFrame:
    """What a push must take up again."""
    rows = copies.where(F.col("status").isin("failed", "pending"))
    return rows if backend is None else rows.where(F.col("backend") == backend)


def backend_status(copies: DataFrame) -> DataFrame:
    return copies.groupBy("backend").agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("uploaded", "pending", "failed")))


def search_files(files: DataFrame, pattern: str, changeset: str | None = None) -> DataFrame:
    rows = files.where(F.col("path").rlike(pattern))
    return rows if changeset is None else rows.where(F.col("changeset_id") == changeset)


def snapshot_files(files: DataFrame, snapshots: DataFrame, at: Column) -> DataFrame:
    """The files of each dataset's last snapshot at or before a time: ``snapshots(changeset_id, dataset, snapshot_timestamp)``."""
    last = snapshots.where(F.col("snapshot_timestamp") <= at).groupBy("dataset").agg(F.max_by("changeset_id", F.struct("snapshot_timestamp", "changeset_id")).alias("changeset_id"))
    return files.join(last, "changeset_id")


def first_from(rows: DataFrame, ts: str, start: Column, columns: list[str]) -> DataFrame:
    """The first row at or after a time."""
    return rows.where(F.col(ts) >= start).orderBy(ts, *columns).limit(1).select(ts, *columns)


def timestamp_sample(rows: DataFrame, ts: str, limit: int = 5) -> DataFrame:
    """The latest times and how many rows have each."""
    return rows.where(F.col(ts).isNotNull()).groupBy(ts).agg(F.count("*").alias("n")).orderBy(F.desc(ts)).limit(limit)
