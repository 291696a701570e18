"""Predicates, duplicate propagation and reports over the catalogue ``fs``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Paths that never become blobs end so.
SKIPPED_SUFFIXES = ("/", "/status", "/.git", "/.svn")


@dataclass
class Change:
    """``state``: the relation after a change; ``delta``: the rows that it affected (with their new values, or as said)."""

    state: DataFrame
    delta: DataFrame


def eligible(processing: bool = False) -> Column:
    """Main files without a blob that aren't missing and whose path isn't skipped; ``processing``: nor being processed."""
    found = F.col("main") & F.col("blobid").isNull() & F.col("last_missing_at").isNull()
    for suffix in SKIPPED_SUFFIXES:
        found &= ~F.col("pth").endswith(suffix)
    return found & F.col("processing_started").isNull() if processing else found


def finished(kind: str = "missing") -> Column:
    """Done means a blob or: last seen missing; also not findable (``cantfind``); or uploaded (``uploaded``)."""
    done = F.col("blobid").isNotNull() | F.col("last_missing_at").isNotNull()
    if kind == "cantfind":
        return done | F.coalesce(F.col("cantfind"), F.lit(False))
    return F.col("uploaded").isNotNull() if kind == "uploaded" else done


def basename(path: Column) -> Column:
    return F.regexp_substr(path, F.lit("[^/]+$"))


def propagate(fs: DataFrame, keys: list[str], as_of: Column) -> Change:
    """Give files that aren't main the blob of the main file with equal ``keys`` (the smallest, if several).

    Only rows that may get a blob are joined, with keys that aren't null, so the filters reach the scan and no rows
    meet on null; all others go to the state as they are.
    """
    source = fs.where(F.col("main") & F.col("blobid").isNotNull()).dropna(subset=keys).groupBy(*keys).agg(F.min("blobid").alias("_blob"))
    whole = F.lit(True)
    for key in keys:
        whole &= F.col(key).isNotNull()
    open_ = F.coalesce(~F.col("main") & F.col("blobid").isNull() & whole, F.lit(False))
    delta = fs.where(open_).join(source, keys).withColumn("blobid", F.col("_blob")).withColumn("uploaded", as_of).select(*fs.columns)
    found = fs.where(open_).join(source, keys, "left")
    hit = F.col("_blob").isNotNull()
    tried = found.withColumn("uploaded", F.when(hit, as_of).otherwise(F.col("uploaded"))).withColumn("blobid", F.col("_blob"))
    return Change(fs.where(~open_).unionByName(tried.select(*fs.columns)), delta)


def propagate_all(fs: DataFrame, as_of: Column) -> Change:
    """By hash, then what is left by (tree, inode); sources are main files only, so one pass each is the fixed point."""
    first = propagate(fs, ["hash"], as_of)
    second = propagate(first.state, ["tree", "inode"], as_of)
    return Change(second.state, first.delta.unionByName(second.delta))


def by_name_and_size(fs: DataFrame) -> DataFrame:
    return fs.withColumn("filename", basename(F.col("pth")))


def name_size_conflicts(fs: DataFrame) -> DataFrame:
    """(filename, size) pairs with several blobs."""
    rows = by_name_and_size(fs).where("blobid IS NOT NULL AND filename IS NOT NULL AND size IS NOT NULL")
    return (
        rows.groupBy("filename", "size")
        .agg(F.countDistinct("blobid").alias("different_blobids"), F.count("*").alias("file_count"), F.sort_array(F.collect_set(F.substring("blobid", 1, 16))).alias("samples"))
        .where("different_blobids > 1")
    )


def name_size_map(fs: DataFrame, safe: bool) -> DataFrame:
    """One blob for each (filename, size): the smallest, or (``safe``) only where there is just one."""
    rows = by_name_and_size(fs).where("blobid IS NOT NULL AND filename IS NOT NULL AND size IS NOT NULL")
    found = rows.groupBy("filename", "size").agg(F.min("blobid").alias("new_blobid"), F.max("blobid").alias("_max"))
    return (found.where("new_blobid = _max") if safe else found).drop("_max")


def name_size_update(fs: DataFrame, safe: bool) -> DataFrame:
    """Files without a blob that another of equal name and size has: pth and the blob it gets."""
    rows = by_name_and_size(fs).where("blobid IS NULL")
    return rows.join(name_size_map(fs, safe), ["filename", "size"]).select("pth", "filename", "size", F.col("new_blobid").alias("blobid"))


def first_per_name_size(fs: DataFrame) -> DataFrame:
    rows = by_name_and_size(fs).where("blobid IS NOT NULL AND filename IS NOT NULL")
    return rows.groupBy("filename", "size").agg(F.min(F.struct("blobid", "pth")).alias("m")).select("filename", "size", "m.blobid", "m.pth")


def progress(fs: DataFrame) -> DataFrame:
    return fs.agg(
        F.count_if((~F.col("main")) & F.col("blobid").isNull()).alias("duplicates_open"),
        F.count_if((~F.col("main")) & F.col("blobid").isNotNull()).alias("duplicates_done"),
        F.count_if(F.col("main") & F.col("blobid").isNotNull()).alias("mains_done"),
    )


def size_buckets(fs: DataFrame) -> DataFrame:
    """Files that need a blob by size; null sizes are in no bucket."""
    need = fs.where("main AND blobid IS NULL")
    return need.agg(
        F.count_if(F.col("size") > 10 * 1024 * 1024).alias("over_10_mib"),
        F.count_if((F.col("size") > 1024 * 1024) & (F.col("size") <= 10 * 1024 * 1024)).alias("over_1_mib"),
        F.count_if(F.col("size") <= 1024 * 1024).alias("up_to_1_mib"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.count_if(F.col("size") > 1_000_000).alias("large"),
        F.count("*").alias("remaining"),
    )


def by_tree(fs: DataFrame) -> DataFrame:
    return fs.groupBy("tree").agg(
        F.count_if(eligible()).alias("ready"),
        F.count_if(F.col("last_missing_at").isNotNull()).alias("missing"),
        F.min("last_missing_at").alias("first_missing"),
        F.max("last_missing_at").alias("last_missing"),
        F.count_if("cantfind").alias("not_found"),
    )


def by_main(fs: DataFrame) -> DataFrame:
    return fs.groupBy("main").agg(F.count("*").alias("total"), F.count("blobid").alias("has_blobid"), F.count_if(F.col("blobid").isNull()).alias("needs_blobid"))


def quality(fs: DataFrame) -> DataFrame:
    return fs.agg(
        F.count_if("cantfind").alias("cantfind"),
        F.count_if(F.col("hash").isNull() & F.col("main")).alias("mains_without_hash"),
        F.count_if(F.col("blobid").isNull()).alias("without_blob"),
        F.count_if(F.col("last_missing_at").isNotNull()).alias("missing"),
        F.count_if(eligible()).alias("eligible"),
        F.count_if(eligible(processing=True)).alias("eligible_idle"),
    )


def route(size: Column, small: int, medium: int) -> Column:
    """Bounds are inclusive."""
    return F.when(size <= small, "small").when(size <= medium, "medium").otherwise("large")


def classify(fs: DataFrame, present: DataFrame) -> DataFrame:
    """Each path against a listing ``present(pth, is_dir)``: missing, directory or file."""
    kind = F.when(F.col("is_dir").isNull(), "missing").when(F.col("is_dir"), "directory").otherwise("file")
    return fs.join(present, "pth", "left").select("pth", kind.alias("kind"))


def apply_outcomes(fs: DataFrame, outcomes: DataFrame, as_of: Column) -> Change:
    """Take over ``outcomes(pth, kind, new_blobid)``: missing files are marked, directories skipped, files get their blob."""
    joined = fs.join(outcomes.withColumn("_hit", F.lit(True)), "pth", "left")
    kind = F.col("kind")
    changed = (
        joined.withColumn("last_missing_at", F.when(kind == "missing", as_of).otherwise(F.col("last_missing_at")))
        .withColumn("blobid", F.when(kind == "directory", F.lit("DIRECTORY_SKIPPED")).when(kind == "file", F.coalesce("new_blobid", "blobid")).otherwise(F.col("blobid")))
        .withColumn("uploaded", F.when(kind.isin("directory", "file"), as_of).otherwise(F.col("uploaded")))
    )
    return Change(changed.select(*fs.columns), changed.where("_hit").select(*fs.columns))


def rename(fs: DataFrame, mapping: DataFrame) -> tuple[Change, DataFrame]:
    """Give paths of ``mapping(pth, repaired)`` their new name and clear ``cantfind``; and what can't be renamed.

    A new name that several old ones would get, or that another row has, is a collision: those rows stay as they are.
    """
    new = mapping.where("repaired IS NOT NULL AND repaired <> pth").dropDuplicates(["pth"])
    known = new.join(fs.select("pth").distinct(), "pth", "left_semi")
    several = known.groupBy("repaired").agg(F.count("*").alias("n")).where("n > 1").select("repaired")
    taken = known.join(fs.select(F.col("pth").alias("repaired")), "repaired", "left_semi").select("repaired")
    bad = several.unionByName(taken).distinct()
    good = known.join(bad, "repaired", "left_anti").select("pth", F.col("repaired").alias("_new"))
    joined = fs.join(good, "pth", "left")
    changed = joined.withColumn("_hit", F.col("_new").isNotNull()).withColumn("pth", F.coalesce("_new", "pth")).withColumn("cantfind", F.col("cantfind") & ~F.col("_hit"))
    return Change(changed.select(*fs.columns), changed.where("_hit").select(*fs.columns)), known.join(bad, "repaired", "left_semi").select("pth", "repaired")


def clear_flag(fs: DataFrame, which: Column) -> Change:
    """Clear ``cantfind`` of all rows that ``which`` names, whether they were renamed or not."""
    hit = F.coalesce(F.col("cantfind") & which, F.lit(False))
    return Change(fs.withColumn("cantfind", F.col("cantfind") & ~hit), fs.where(hit).withColumn("cantfind", F.lit(False)).select(*fs.columns))


def evolve(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add columns that are missing (null), and cast those that have another type."""
    kept = [F.col(c).cast(columns[c]).alias(c) if c in columns else F.col(c) for c in rows.columns]
    return rows.select(*kept, *(F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in rows.columns))


def reference_counts(files: DataFrame) -> DataFrame:
    """How many files have each content."""
    return files.where("blobid IS NOT NULL").groupBy("blobid").agg(F.count("*").alias("references"))
