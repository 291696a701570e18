"""Queries over the derived relations, each with the DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone import fixtures as fx
from tallystone.functions import format_size, percent
from tallystone.operators import blobs, catalogue, ciphers, library, metrics, paths, queue, reconcile

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None):
    """The function's name is the query's; ``sql`` is its oracle."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def fs_of(spark, d):
    return fx.catalogue(spark, d)


def now():
    return fx.at(fx.AS_OF)


NOW = f"TIMESTAMP '{fx.AS_OF}'"
ELIGIBLE = "main AND blobid IS NULL AND last_missing_at IS NULL AND pth NOT LIKE '%/' AND pth NOT LIKE '%/status' AND pth NOT LIKE '%/.git' AND pth NOT LIKE '%/.svn'"
NAME = "nullif(regexp_extract(pth, '[^/]+$'), '')"
CHANGED = "pth, blobid, uploaded"


# --- catalogue: progress, propagation, names and sizes
@register(f"WITH {fx.FS} SELECT count(*) FILTER (NOT main AND blobid IS NULL) AS duplicates_open, count(*) FILTER (NOT main AND blobid IS NOT NULL) AS duplicates_done, count(*) FILTER (main AND blobid IS NOT NULL) AS mains_done FROM fs")
def fs_progress(spark, d):
    return catalogue.progress(fs_of(spark, d))


@register(f"WITH {fx.FS} SELECT main, count(*) AS total, count(blobid) AS has_blobid, count(*) - count(blobid) AS needs_blobid FROM fs GROUP BY main")
def fs_stats_by_main(spark, d):
    return catalogue.by_main(fs_of(spark, d))


@register(f"WITH {fx.FS} SELECT tree, count(*) FILTER ({ELIGIBLE}) AS ready, count(last_missing_at) AS missing, min(last_missing_at) AS first_missing, max(last_missing_at) AS last_missing, count(*) FILTER (cantfind) AS not_found FROM fs GROUP BY tree")
def fs_by_tree(spark, d):
    return catalogue.by_tree(fs_of(spark, d))


@register(f"WITH {fx.FS}, n AS (SELECT * FROM fs WHERE main AND blobid IS NULL) SELECT count(*) FILTER (size > 10485760) AS over_10_mib, count(*) FILTER (size > 1048576 AND size <= 10485760) AS over_1_mib, count(*) FILTER (size <= 1048576) AS up_to_1_mib, coalesce(sum(size), 0)::BIGINT AS bytes, count(*) FILTER (size > 1000000) AS large, count(*) AS remaining FROM n")
def fs_size_buckets(spark, d):
    return catalogue.size_buckets(fs_of(spark, d))


@register(f"WITH {fx.FS} SELECT count(*) FILTER (cantfind) AS cantfind, count(*) FILTER (hash IS NULL AND main) AS mains_without_hash, count(*) - count(blobid) AS without_blob, count(last_missing_at) AS missing, count(*) FILTER ({ELIGIBLE}) AS eligible, count(*) FILTER ({ELIGIBLE} AND processing_started IS NULL) AS eligible_idle FROM fs")
def fs_quality(spark, d):
    return catalogue.quality(fs_of(spark, d))


@register(f"WITH {fx.FS} SELECT pth, size FROM fs WHERE {ELIGIBLE}")
def eligible_files(spark, d):
    return fs_of(spark, d).where(catalogue.eligible()).select("pth", "size")


_SRC = "src AS (SELECT {k}, min(blobid) AS b FROM fs WHERE main AND blobid IS NOT NULL GROUP BY {k})"


@register(f"WITH {fx.FS}, {_SRC.format(k='hash')} SELECT pth, b AS blobid, {NOW} AS uploaded FROM fs JOIN src USING (hash) WHERE NOT main AND blobid IS NULL")
def propagate_hash(spark, d):
    return catalogue.propagate(fs_of(spark, d), ["hash"], now()).delta.select("pth", "blobid", "uploaded")


@register(f"WITH {fx.FS}, {_SRC.format(k='tree, inode')} SELECT pth, b AS blobid, {NOW} AS uploaded FROM fs JOIN src USING (tree, inode) WHERE NOT main AND blobid IS NULL")
def propagate_inode(spark, d):
    return catalogue.propagate(fs_of(spark, d), ["tree", "inode"], now()).delta.select("pth", "blobid", "uploaded")


@register(
    f"""WITH {fx.FS}, h AS (SELECT hash, min(blobid) AS hb FROM fs WHERE main AND blobid IS NOT NULL GROUP BY hash),
i AS (SELECT tree, inode, min(blobid) AS ib FROM fs WHERE main AND blobid IS NOT NULL GROUP BY ALL)
SELECT pth, CASE WHEN blobid IS NULL AND NOT main THEN coalesce(hb, ib) ELSE blobid END AS blobid,
       CASE WHEN blobid IS NULL AND NOT main AND coalesce(hb, ib) IS NOT NULL THEN {NOW} ELSE uploaded END AS uploaded
FROM fs LEFT JOIN h USING (hash) LEFT JOIN i USING (tree, inode)"""
)
def propagate_both(spark, d):
    return catalogue.propagate_all(fs_of(spark, d), now()).state.select("pth", "blobid", "uploaded")


@register(f"WITH {fx.FS} SELECT count(DISTINCT ({NAME}, size)) AS pairs, count(*) AS files FROM fs WHERE blobid IS NULL AND size IS NOT NULL")
def filename_size_pairs(spark, d):
    rows = catalogue.by_name_and_size(fs_of(spark, d)).where("blobid IS NULL AND size IS NOT NULL")
    return rows.agg(F.countDistinct(F.struct("filename", "size")).alias("pairs"), F.count("*").alias("files"))


_NAMED = f"named AS (SELECT *, {NAME} AS filename FROM fs)"


@register(f"WITH {fx.FS}, {_NAMED} SELECT filename, size, count(DISTINCT blobid) AS different_blobids, count(*) AS file_count, list_sort(list(DISTINCT blobid[1:16])) AS samples FROM named WHERE blobid IS NOT NULL AND filename IS NOT NULL GROUP BY filename, size HAVING count(DISTINCT blobid) > 1")
def filename_size_conflicts(spark, d):
    return catalogue.name_size_conflicts(fs_of(spark, d))


@register(f"WITH {fx.FS}, {_NAMED} SELECT filename, size, count(DISTINCT blobid) AS different_blobids FROM named WHERE blobid IS NOT NULL AND filename IS NOT NULL GROUP BY filename, size HAVING count(DISTINCT blobid) > 1 ORDER BY different_blobids DESC, size DESC, filename LIMIT 10")
def conflict_examples(spark, d):
    found = catalogue.name_size_conflicts(fs_of(spark, d)).orderBy(F.desc("different_blobids"), F.desc("size"), "filename")
    return found.limit(10).select("filename", "size", "different_blobids")


_UPDATE = "SELECT pth, filename, size, b AS blobid FROM named JOIN m USING (filename, size) WHERE blobid IS NULL"


@register(f"WITH {fx.FS}, {_NAMED}, m AS (SELECT filename, size, min(blobid) AS b FROM named WHERE blobid IS NOT NULL GROUP BY ALL) {_UPDATE}")
def filename_size_update(spark, d):
    return catalogue.name_size_update(fs_of(spark, d), safe=False)


@register(f"WITH {fx.FS}, {_NAMED}, m AS (SELECT filename, size, min(blobid) AS b FROM named WHERE blobid IS NOT NULL GROUP BY ALL HAVING count(DISTINCT blobid) = 1) {_UPDATE}")
def filename_size_safe_update(spark, d):
    return catalogue.name_size_update(fs_of(spark, d), safe=True)


@register(f"WITH {fx.FS}, {_NAMED} SELECT DISTINCT ON (filename, size) filename, size, blobid, pth FROM named WHERE blobid IS NOT NULL AND filename IS NOT NULL ORDER BY filename, size, blobid, pth")
def distinct_filename_size(spark, d):
    return catalogue.first_per_name_size(fs_of(spark, d))


@register(f"WITH {fx.FS} SELECT pth, CASE WHEN size <= 1048576 THEN 'small' WHEN size <= 10485760 THEN 'medium' ELSE 'large' END AS route FROM fs")
def size_routing(spark, d):
    return fs_of(spark, d).select("pth", catalogue.route(F.col("size"), 1_048_576, 10_485_760).alias("route"))


@register(
    f"""WITH {fx.FS}, present AS (SELECT pth, doc_id % 8 = 0 AS is_dir FROM fs WHERE doc_id % 5 <> 2),
o AS (SELECT pth, CASE WHEN is_dir IS NULL THEN 'missing' WHEN is_dir THEN 'directory' ELSE 'file' END AS kind FROM fs LEFT JOIN present USING (pth) WHERE main AND fs.blobid IS NULL)
SELECT fs.pth, CASE kind WHEN 'directory' THEN 'DIRECTORY_SKIPPED' WHEN 'file' THEN sha256(fs.pth) ELSE blobid END AS blobid,
  CASE WHEN kind = 'missing' THEN {NOW} ELSE last_missing_at END AS last_missing_at, CASE WHEN kind IN ('directory', 'file') THEN {NOW} ELSE uploaded END AS uploaded
FROM fs JOIN o USING (pth)"""
)
def apply_outcomes(spark, d):
    fs = fs_of(spark, d)
    present = fs.where("doc_id % 5 <> 2").selectExpr("pth", "doc_id % 8 = 0 AS is_dir")
    outcome = catalogue.classify(fs.where("main AND blobid IS NULL"), present).withColumn("new_blobid", F.sha2("pth", 256))
    return catalogue.apply_outcomes(fs, outcome, now()).delta.select("pth", "blobid", "last_missing_at", "uploaded")


@register(f"WITH {fx.FS} SELECT pth, last_missing_at FROM fs WHERE last_missing_at IS NOT NULL ORDER BY last_missing_at DESC, pth LIMIT 20")
def recent_missing(spark, d):
    return fs_of(spark, d).where("last_missing_at IS NOT NULL").orderBy(F.desc("last_missing_at"), "pth").limit(20).select("pth", "last_missing_at")


@register(f"WITH {fx.FS} SELECT pth AS path, tree AS st_dev, inode AS st_inode, size, mtime, hash AS file_hash, main AS is_canonical FROM fs")
def fs_to_files_mapping(spark, d):
    return library.from_catalogue(fs_of(spark, d))


@register(f"""WITH {fx.FS} SELECT tree, count(*) AS n, round(100.0 * count(blobid) / nullif(count(*), 0), 2) AS done_percent,
  CASE WHEN sum(size) >= 1099511627776 THEN format('{{:.1f}}TB', sum(size) / 1099511627776.0) WHEN sum(size) >= 1073741824 THEN format('{{:.1f}}GB', sum(size) / 1073741824.0)
  WHEN sum(size) >= 1048576 THEN format('{{:.1f}}MB', sum(size) / 1048576.0) WHEN sum(size) >= 1024 THEN format('{{:.1f}}KB', sum(size) / 1024.0) ELSE format('{{:.1f}}B', sum(size)::DOUBLE) END AS total
  FROM fs GROUP BY tree""")
def tree_sizes(spark, d):
    rows = fs_of(spark, d).groupBy("tree").agg(F.count("*").alias("n"), F.count("blobid").alias("k"), F.sum("size").alias("s"))
    return rows.select("tree", "n", percent(F.col("k"), F.col("n")).alias("done_percent"), format_size(F.col("s")).alias("total"))


# --- queue
def queued(spark, d):
    fs = fs_of(spark, d)
    return fs, fx.work_queue(fs)


@register(f"WITH {fx.QUEUE} SELECT count(*) AS total, count(*) - count(claimed_at) AS unclaimed, count(claimed_at) AS claimed, min(claimed_at) AS oldest_claim, max(claimed_at) AS newest_claim FROM work_queue")
def queue_stats(spark, d):
    return queue.stats(queued(spark, d)[1])


@register(f"WITH {fx.QUEUE} SELECT claimed_by, count(*) AS claims FROM work_queue WHERE claimed_by IS NOT NULL GROUP BY claimed_by")
def queue_claims_by_worker(spark, d):
    return queue.claims_by_worker(queued(spark, d)[1])


@register(f"WITH {fx.QUEUE}, j AS (SELECT fs.* FROM work_queue JOIN fs USING (pth)), s AS (SELECT count(blobid) AS completed, count(*) FILTER (blobid IS NULL AND last_missing_at IS NULL) AS pending, count(last_missing_at) AS missing FROM j) SELECT *, coalesce(round(100.0 * (completed + missing) / nullif(completed + pending + missing, 0), 1), 0) AS progress FROM s")
def progress_summary(spark, d):
    fs, q = queued(spark, d)
    return queue.summary(q, fs)


_NEW = "SELECT DISTINCT pth FROM fs WHERE {w} AND NOT EXISTS (SELECT 1 FROM work_queue q WHERE q.pth = fs.pth)"


@register(f"WITH {fx.QUEUE} {_NEW.format(w=ELIGIBLE)}")
def queue_add_new(spark, d):
    fs, q = queued(spark, d)
    return queue.add_eligible(q, fs, now()).delta.select("pth")


@register(f"WITH {fx.QUEUE} {_NEW.format(w='main AND blobid IS NULL')}")
def queue_add_main(spark, d):
    fs, q = queued(spark, d)
    return queue.add_mains(q, fs, now()).delta.select("pth")


@register(f"WITH {fx.QUEUE} SELECT pth, claimed_at, claimed_by, created_at FROM work_queue UNION ALL SELECT pth, NULL, NULL, {NOW} FROM ({_NEW.format(w='blobid IS NULL')})")
def queue_populate(spark, d):
    fs, q = queued(spark, d)
    return queue.populate(q, fs, now(), duplicates=True).state


@register(f"WITH {fx.QUEUE}, n AS (SELECT pth FROM fs WHERE main AND blobid IS NULL) SELECT count(*) AS needed, count(*) FILTER (pth IN (SELECT pth FROM work_queue)) AS queued, count(*) FILTER (pth NOT IN (SELECT pth FROM work_queue)) AS to_add FROM n")
def queue_already_queued(spark, d):
    fs, q = queued(spark, d)
    return queue.already_queued(q, fs)


@register(f"WITH {fx.QUEUE} SELECT pth, claimed_at, claimed_by FROM work_queue WHERE claimed_at < {NOW} - INTERVAL 30 MINUTE")
def queue_reset_stale(spark, d):
    return queue.reset_stale(queued(spark, d)[1], now()).delta.select("pth", "claimed_at", "claimed_by")


@register(f"WITH {fx.FS} SELECT pth, processing_started FROM fs WHERE blobid IS NULL AND processing_started < {NOW} - INTERVAL 60 MINUTE")
def reset_processing(spark, d):
    return queue.reset_processing(fs_of(spark, d), now()).delta.select("pth", "processing_started")


@register(f"WITH {fx.QUEUE} SELECT pth, claimed_by FROM work_queue WHERE pth IN (SELECT pth FROM fs WHERE blobid IS NOT NULL OR last_missing_at IS NOT NULL OR cantfind)")
def queue_remove_completed(spark, d):
    fs, q = queued(spark, d)
    return queue.remove_completed(q, fs, "cantfind").delta.select("pth", "claimed_by")


@register(f"WITH {fx.QUEUE} SELECT pth, size FROM work_queue LEFT JOIN fs USING (pth) WHERE claimed_at IS NULL ORDER BY size, pth LIMIT 50")
def claim_batch(spark, d):
    fs, q = queued(spark, d)
    return queue.claim(q, fs, "worker_x", now(), 50).delta


@register(
    f"""WITH {fx.QUEUE}, done AS (SELECT pth FROM fs WHERE blobid IS NOT NULL OR last_missing_at IS NOT NULL),
r AS (SELECT pth, CASE WHEN claimed_at < {NOW} - INTERVAL 30 MINUTE THEN NULL ELSE claimed_by END AS claimed_by FROM work_queue UNION ALL SELECT pth, NULL FROM ({_NEW.format(w=ELIGIBLE)}))
SELECT pth, claimed_by FROM r WHERE pth NOT IN (SELECT pth FROM done)"""
)
def queue_maintenance(spark, d):
    fs, q = queued(spark, d)
    return queue.maintain(q, fs, now()).select("pth", "claimed_by")


# --- library
@register(f"WITH {fx.FILES} SELECT changeset_id, count(path) AS file_count, coalesce(sum(size), 0)::BIGINT AS total_size FROM files GROUP BY changeset_id")
def changeset_stats(spark, d):
    return library.stats(fx.files(spark, d))


@register(f"WITH {fx.FILES} SELECT changeset_id, count(*) AS files, count(upload_finish_tm) AS completed, count(upload_start_tm) AS started, count(*) FILTER (is_canonical) AS canonical, count(*) FILTER (is_canonical AND upload_finish_tm IS NOT NULL) AS canonical_completed, sum(size)::BIGINT AS total_size FROM files GROUP BY changeset_id")
def changeset_status(spark, d):
    return library.status(fx.files(spark, d))


@register(f"WITH {fx.FILES} SELECT changeset_id, 'changeset ' || changeset_id AS name, sha256(string_agg(DISTINCT file_id, ',' ORDER BY file_id)) AS content_hash, 'pending' AS status FROM files GROUP BY changeset_id")
def changesets(spark, d):
    return library.changesets(fx.files(spark, d))


@register(f"WITH {fx.FILES} SELECT path, changeset_id FROM files WHERE is_canonical AND upload_finish_tm IS NULL")
def canonical_needing_upload(spark, d):
    return library.needing_upload(fx.files(spark, d)).select("path", "changeset_id")


@register(f"WITH {fx.FILES} SELECT path, upload_start_tm FROM files WHERE is_canonical AND upload_finish_tm IS NULL AND upload_start_tm < TIMESTAMP '1997-01-01 00:00:00' - INTERVAL 1 HOUR")
def stuck_uploads(spark, d):
    return library.stuck(fx.files(spark, d), fx.at("1997-01-01 00:00:00")).select("path", "upload_start_tm")


@register(f"WITH {fx.FILES} SELECT changeset_id, CASE WHEN upload_start_tm IS NULL THEN 'not_started' WHEN upload_finish_tm IS NULL THEN 'in_progress' ELSE 'completed' END AS state, count(*) AS n FROM files GROUP BY ALL")
def upload_state(spark, d):
    return fx.files(spark, d).groupBy("changeset_id", library.upload_state().alias("state")).agg(F.count("*").alias("n"))


@register(f"WITH {fx.FILES} SELECT changeset_id, st_dev, st_inode, list_sort(list(path)) AS paths FROM files GROUP BY ALL HAVING count(*) > 1")
def hardlink_groups(spark, d):
    return library.hardlink_groups(fx.files(spark, d))


@register(f"WITH {fx.FILES}, i AS (SELECT DISTINCT changeset_id, st_dev, st_inode FROM files) SELECT (SELECT count(*) FROM files) AS files, count(*) AS inodes, round((SELECT count(*) FROM files)::DOUBLE / count(*), 6) AS ratio FROM i")
def dedup_ratio(spark, d):
    return library.dedup_ratio(fx.files(spark, d))


@register(f"WITH {fx.FILES} SELECT path, file_id FROM files WHERE file_id IN (SELECT file_id FROM files WHERE is_canonical AND st_inode % 10 = 0)")
def mark_upload_completed(spark, d):
    files = fx.files(spark, d)
    return library.mark_completed(files, files.where("is_canonical AND st_inode % 10 = 0"), now()).delta.select("path", "file_id")


@register(f"WITH {fx.FILES} SELECT path, {NOW} AS upload_start_tm FROM files WHERE is_canonical AND st_inode % 10 = 0")
def mark_upload_started(spark, d):
    files = fx.files(spark, d)
    return library.mark_started(files, files.where("st_inode % 10 = 0"), now()).delta.select("path", "upload_start_tm")


@register(f"WITH {fx.FILES} SELECT changeset_id, round(count(upload_finish_tm) * 100.0 / count(*), 6) AS rate FROM files GROUP BY changeset_id")
def upload_success_rate(spark, d):
    return library.success_rate(fx.files(spark, d))


@register(f"WITH {fx.FILES} SELECT size, round(avg(date_diff('second', upload_start_tm, upload_finish_tm)), 6) AS avg_seconds, count(*) AS n FROM files WHERE upload_finish_tm IS NOT NULL GROUP BY size")
def upload_seconds_by_size(spark, d):
    return library.seconds_by_size(fx.files(spark, d))


# --- reconciliation
_KNOWN = "known AS (SELECT DISTINCT blobid FROM fs WHERE blobid IS NOT NULL AND blobid <> 'DIRECTORY_SKIPPED')"


@register(f"WITH {fx.STORAGE}, {_KNOWN} SELECT blobid FROM known EXCEPT SELECT blobid FROM storage")
def phantom_blobs(spark, d):
    fs = fs_of(spark, d)
    return reconcile.phantoms(fs, fx.storage(fs))


@register(f"WITH {fx.STORAGE}, {_KNOWN} SELECT blobid FROM storage EXCEPT SELECT blobid FROM known")
def orphan_blobs(spark, d):
    fs = fs_of(spark, d)
    return reconcile.orphans(fs, fx.storage(fs))


@register(f"WITH {fx.STORAGE}, {_KNOWN} SELECT (SELECT count(*) FROM known) AS known, (SELECT count(*) FROM storage) AS stored, (SELECT count(*) FROM known WHERE blobid NOT IN (SELECT blobid FROM storage)) AS phantom, (SELECT count(*) FROM storage WHERE blobid NOT IN (SELECT blobid FROM known)) AS orphan")
def storage_summary(spark, d):
    fs = fs_of(spark, d)
    return reconcile.summary(fs, fx.storage(fs))


@register(f"WITH {fx.BAD} SELECT pth, blobid, uploaded FROM fs WHERE blobid IN (SELECT blobid FROM bad)")
def requeue_bad_blobs(spark, d):
    fs = fs_of(spark, d)
    return reconcile.requeue_bad(fs, fx.bad_blobs(fs)).delta.select("pth", "blobid", "uploaded")


@register(f"WITH {fx.BAD} SELECT count(*) AS paths, count(DISTINCT blobid) AS bad_blobs, coalesce(sum(size), 0)::BIGINT AS bytes, round(count(*)::DOUBLE / nullif(count(DISTINCT blobid), 0), 6) AS dedup_factor FROM fs WHERE blobid IN (SELECT blobid FROM bad)")
def requeue_summary(spark, d):
    fs = fs_of(spark, d)
    return reconcile.requeue_summary(fs, fx.bad_blobs(fs))


@register(f"WITH {fx.FS} SELECT blobid, min(pth) AS pth, count(*) AS paths FROM fs WHERE blobid IS NOT NULL AND blobid <> 'DIRECTORY_SKIPPED' GROUP BY blobid")
def source_for_blob(spark, d):
    return reconcile.source_of_blob(fs_of(spark, d))


@register(f"WITH {fx.FS} SELECT blobid, count(*) AS rows, count(uploaded) AS with_uploaded, min(mtime) AS min_mtime, max(mtime) AS max_mtime FROM fs WHERE blobid IS NOT NULL GROUP BY blobid")
def blob_history(spark, d):
    return reconcile.history(fs_of(spark, d))


@register(f"WITH {fx.STORAGE}, incoming AS (SELECT pth, blobid FROM fs WHERE blobid IS NOT NULL AND blobid <> 'DIRECTORY_SKIPPED') SELECT blobid, min(pth) AS pth FROM incoming WHERE blobid NOT IN (SELECT blobid FROM storage) GROUP BY blobid")
def dedup_new_blobs(spark, d):
    fs = fs_of(spark, d)
    return reconcile.new_blobs(fs.where("blobid IS NOT NULL AND blobid <> 'DIRECTORY_SKIPPED'").select("pth", "blobid"), fx.storage(fs))


@register(f"WITH {fx.STORAGE} SELECT pth, CASE WHEN doc_id % 2 = 0 AND blobid IN (SELECT blobid FROM storage) THEN {NOW} ELSE CASE WHEN doc_id % 2 = 1 THEN uploaded END END AS uploaded FROM fs")
def mark_blob_uploaded(spark, d):
    fs = fs_of(spark, d).withColumn("uploaded", F.expr("IF(doc_id % 2 = 1, uploaded, NULL)"))
    return reconcile.mark_uploaded(fs, fx.storage(fs), now()).state.select("pth", "uploaded")


@register(f"WITH {fx.MTIMES} SELECT fs.pth, coalesce(t.mtime, fs.mtime) AS mtime FROM fs LEFT JOIN temp_mtime t ON t.path = fs.pth")
def mtime_update(spark, d):
    fs = fs_of(spark, d)
    return reconcile.update_mtime(fs, fx.mtimes(fs)).state.select("pth", "mtime")


@register(f"WITH {fx.MTIMES} SELECT 'staged' AS label, count(*) AS n FROM temp_mtime UNION ALL SELECT 'with_mtime', count(mtime) FROM fs UNION ALL SELECT 'without_mtime', count(*) - count(mtime) FROM fs UNION ALL SELECT 'to_update', count(*) FROM fs WHERE mtime IS NULL AND pth IN (SELECT path FROM temp_mtime)")
def mtime_counts(spark, d):
    fs = fs_of(spark, d)
    return reconcile.mtime_counts(fs, fx.mtimes(fs))


@register(
    f"""WITH {fx.MANIFESTS} SELECT coalesce(n.pth, o.pth) AS pth, CASE WHEN n.pth IS NULL THEN 'REMOVE' ELSE 'WRITE' END AS action, coalesce(n.blobid, o.blobid) AS blobid
FROM manifest_old o FULL JOIN manifest_new n ON o.pth = n.pth
WHERE n.pth IS NULL OR o.pth IS NULL OR o.blobid IS DISTINCT FROM n.blobid OR o.size IS DISTINCT FROM n.size OR o.mtime IS DISTINCT FROM n.mtime"""
)
def manifest_diff(spark, d):
    return reconcile.manifest_diff(*fx.manifests(fs_of(spark, d)))


@register(f"WITH {fx.MANIFESTS} SELECT pth, blobid FROM manifest_new")
def manifest_replay(spark, d):
    old, new = fx.manifests(fs_of(spark, d))
    log = old.select(F.lit(0).alias("seq"), "pth", F.lit("WRITE").alias("action"), "blobid").unionByName(reconcile.manifest_diff(old, new).select(F.lit(1).alias("seq"), "pth", "action", "blobid"))
    return reconcile.replay(log)


@register(f"WITH {fx.STORAGE} SELECT blobid[1:2] || '/' || blobid[3:4] AS folder, list_sort(list(DISTINCT blobid)) AS blobids FROM storage GROUP BY folder")
def blobs_by_folder(spark, d):
    return reconcile.grouped_by_fanout(fx.storage(fs_of(spark, d)))


@register("WITH c AS (SELECT event_id AS id, CASE WHEN event_id > 0 THEN event_id - 1 END AS previous_id FROM events WHERE event_id % 97 <> 5) SELECT id, previous_id FROM c WHERE previous_id IS NOT NULL AND previous_id NOT IN (SELECT id FROM c)")
def broken_chain_links(spark, d):
    chain = fx.table(spark, d, "events").where("event_id % 97 <> 5").selectExpr("event_id AS id", "IF(event_id > 0, event_id - 1, NULL) AS previous_id")
    return reconcile.broken_links(chain).select("id", "previous_id")


# --- operations log
@register(f"WITH {fx.OPERATIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY content_hash, installation_id ORDER BY operation_timestamp DESC, operation_id DESC) AS k FROM operations) SELECT content_hash, installation_id, operation_id, operation_type, operation_timestamp FROM r WHERE k = 1")
def latest_blob_status(spark, d):
    return reconcile.latest_status(fx.operations(spark, d)).select("content_hash", "installation_id", "operation_id", "operation_type", "operation_timestamp")


@register(f"WITH {fx.OPERATIONS} SELECT content_hash, installation_id, max(operation_timestamp) FILTER (operation_type = 'verification_success') AS last_verified, count(*) FILTER (operation_type = 'upload_completed') AS uploads FROM operations GROUP BY ALL HAVING last_verified IS NULL OR last_verified < TIMESTAMP '{fx.EVENTS_AS_OF}' - INTERVAL 7 DAY")
def verification_candidates(spark, d):
    return reconcile.verification_candidates(fx.operations(spark, d), fx.at(fx.EVENTS_AS_OF))


@register(f"WITH {fx.OPERATIONS} SELECT count(*) AS n, round(count(*) / 48.0, 6) AS per_hour FROM operations WHERE operation_timestamp >= TIMESTAMP '2024-01-10' AND operation_timestamp <= TIMESTAMP '2024-01-12'")
def throughput_window(spark, d):
    return metrics.window_throughput(fx.operations(spark, d), "operation_timestamp", fx.at("2024-01-10 00:00:00"), fx.at("2024-01-12 00:00:00"))


@register(f"WITH {fx.FS} SELECT count(*) AS n, min(uploaded) AS oldest, max(uploaded) AS newest FROM fs WHERE uploaded > TIMESTAMP '2025-09-02 08:00:00' - INTERVAL 60 MINUTE")
def recent_uploads(spark, d):
    return metrics.recent(fs_of(spark, d), "uploaded", fx.at("2025-09-02 08:00:00"), 60)


@register(f"WITH {fx.OPERATIONS} SELECT operation_type, round(quantile_cont(latency_ms, 0.5), 6) AS p50, round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99, count(*) AS n FROM operations GROUP BY operation_type")
def latency_percentiles(spark, d):
    return metrics.percentiles(fx.operations(spark, d), "operation_type", "latency_ms")


@register(f"WITH {fx.OPERATIONS}, r AS (SELECT operation_type, latency_ms, row_number() OVER (PARTITION BY operation_type ORDER BY latency_ms) AS k, count(*) OVER (PARTITION BY operation_type) AS n FROM operations) SELECT operation_type, max(latency_ms) FILTER (k = n // 2 + 1) AS median, max(latency_ms) FILTER (k = CASE WHEN n > 20 THEN floor(n * 0.95) + 1 ELSE n END) AS p95 FROM r GROUP BY operation_type")
def latency_nearest_rank(spark, d):
    return metrics.nearest_rank(fx.operations(spark, d), "operation_type", "latency_ms")


@register(f"WITH {fx.OPERATIONS}, p AS (SELECT installation_id, round(quantile_cont(latency_ms, 0.95) / nullif(quantile_cont(latency_ms, 0.5), 0), 6) AS ratio, count(*) AS n FROM operations GROUP BY ALL) SELECT installation_id, ratio, CASE WHEN n < 20 THEN 'unknown' WHEN ratio > 10 THEN 'severe' WHEN ratio > 5 THEN 'thrashing' ELSE 'normal' END AS state FROM p")
def thrashing(spark, d):
    return metrics.thrashing(fx.operations(spark, d), "installation_id", "latency_ms")


@register(f"WITH {fx.OPERATIONS}, r AS (SELECT installation_id, operation_id, latency_ms, row_number() OVER (PARTITION BY installation_id ORDER BY operation_timestamp DESC, operation_id DESC)::INT AS position FROM operations) SELECT installation_id, operation_id, latency_ms, position FROM r WHERE position <= 10")
def latest_samples(spark, d):
    rows = metrics.latest(fx.operations(spark, d), "installation_id", "operation_timestamp", "operation_id", 10)
    return rows.select("installation_id", "operation_id", "latency_ms", "position")


def cpu_samples(spark, d):
    return fx.operations(spark, d).selectExpr("installation_id AS worker", "operation_timestamp AS ts", "operation_id AS id", "latency_ms % 100 AS cpu", "operation_type = 'upload_completed' AS progress")


_IDLE = f"""{fx.OPERATIONS}, s AS (SELECT installation_id AS worker, operation_timestamp AS ts, operation_id AS id, latency_ms % 100 AS cpu, operation_type = 'upload_completed' AS progress FROM operations),
r AS (SELECT *, row_number() OVER (PARTITION BY worker ORDER BY ts DESC, id DESC) AS k FROM s),
idle AS (SELECT worker, CASE WHEN count(*) = 5 THEN round(avg(cpu), 6) END AS mean_cpu, CASE WHEN count(*) = 5 THEN round(avg(cpu), 6) < 40 END AS idle FROM r WHERE k <= 5 GROUP BY worker)"""


@register(f"WITH {_IDLE} SELECT * FROM idle")
def worker_cpu_idle(spark, d):
    return metrics.idle_workers(cpu_samples(spark, d))


@register(f"WITH {_IDLE}, p AS (SELECT worker, max(ts) FILTER (progress) AS lp FROM s GROUP BY worker) SELECT worker, idle, lp IS NULL OR lp < TIMESTAMP '2024-01-30 22:00:00' - INTERVAL 15 MINUTE AS stalled, coalesce(idle AND (lp IS NULL OR lp < TIMESTAMP '2024-01-30 22:00:00' - INTERVAL 15 MINUTE), false) AS hung FROM idle JOIN p USING (worker)")
def hung_workers(spark, d):
    return metrics.hung_workers(cpu_samples(spark, d), fx.at("2024-01-30 22:00:00"))


_HOURLY = "hourly AS (SELECT event_type AS series, date_trunc('hour', ts) AS ts, count(*)::DOUBLE AS rate FROM events GROUP BY ALL)"


@register(f"WITH {_HOURLY}, l AS (SELECT *, lag(rate, 2) OVER (PARTITION BY series ORDER BY ts) AS b FROM hourly) SELECT series, ts, rate, CASE WHEN b IS NULL THEN 'unknown' WHEN rate > b * 1.1 THEN 'improving' WHEN rate < b * 0.9 THEN 'degrading' ELSE 'stable' END AS trend FROM l")
def throughput_trend(spark, d):
    events = fx.table(spark, d, "events")
    points = events.groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.count("*").cast("double").alias("rate"))
    return metrics.trend(points)


@register(f"WITH {_HOURLY}, l AS (SELECT *, sum(rate) OVER w AS total FROM hourly WINDOW w AS (PARTITION BY series ORDER BY ts)), m AS (SELECT series, ts, total - lag(total) OVER w AS dt, date_diff('second', lag(ts) OVER w, ts) AS s FROM l WINDOW w AS (PARTITION BY series ORDER BY ts)) SELECT series, ts, round(dt / nullif(s, 0), 6) AS per_second FROM m")
def counter_rates(spark, d):
    from pyspark.sql import Window

    events = fx.table(spark, d, "events")
    points = events.groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.count("*").alias("n"))
    return metrics.rates(points.withColumn("total", F.sum("n").over(Window.partitionBy("series").orderBy("ts"))))


@register(
    """SELECT event_id, CASE WHEN (event_id % 50) / 10.0 > 3.5 THEN 'shared memory pressure' WHEN event_id % 101 > 80 THEN 'compression bottleneck'
WHEN event_id % 97 > 80 AND event_id % 89 > 80 THEN 'disk bottleneck' WHEN event_id % 100 > 90 THEN 'cpu bottleneck' WHEN event_id % 97 = 0 AND event_id % 101 = 0 THEN 'idle' ELSE 'balanced' END AS diagnosis FROM events"""
)
def diagnosis(spark, d):
    e = F.col("event_id")
    return fx.table(spark, d, "events").select("event_id", metrics.diagnosis((e % 50) / 10.0, e % 97, e % 101, e % 100, e % 89).alias("diagnosis"))


@register("WITH t AS (SELECT round(avg(value), 6) AS a, round(avg(value % 7), 6) AS b, round(avg(value % 13), 6) AS c, count(*) AS files FROM events) SELECT a AS read_ms, b AS process_ms, c AS upload_ms, files, round(1000.0 / nullif(a + b + c, 0), 6) AS files_per_second, CASE WHEN a >= b AND a >= c THEN 'read_ms' WHEN b >= c THEN 'process_ms' ELSE 'upload_ms' END AS bottleneck FROM t")
def stage_averages(spark, d):
    rows = fx.table(spark, d, "events").selectExpr("value AS read_ms", "value % 7 AS process_ms", "value % 13 AS upload_ms")
    return metrics.stage_averages(rows, ["read_ms", "process_ms", "upload_ms"])


@register("SELECT user_id % 10 AS worker, count(*) FILTER (event_type <> 'error') AS succeeded, count(*) FILTER (event_type = 'error') AS failed, round(avg(value) FILTER (event_type <> 'error'), 6) AS avg_ms FROM events GROUP BY ALL")
def success_summary(spark, d):
    return metrics.success_summary(fx.table(spark, d, "events").selectExpr("user_id % 10 AS worker", "event_type <> 'error' AS ok", "value AS ms"), "worker")


# --- paths
def disk_of(spark, d):
    return fx.disk(spark, d)


@register(f"WITH {fx.DISK} SELECT doc_id, name, strip_accents(name) AS stripped FROM disk")
def strip_accents(spark, d):
    return disk_of(spark, d).select("doc_id", "name", paths.strip_accents("name").alias("stripped"))


@register(f"WITH {fx.DISK}, w AS (SELECT DISTINCT parent, strip_accents(name) AS db_name FROM disk), e AS (SELECT DISTINCT parent, name FROM disk), k AS (SELECT parent, strip_accents(name) AS key, min(name) AS n FROM disk GROUP BY ALL) SELECT w.parent, w.db_name, coalesce(e.name, k.n) AS name, CASE WHEN e.name IS NOT NULL THEN 'exact' ELSE 'accents' END AS method FROM w LEFT JOIN e ON e.parent = w.parent AND e.name = w.db_name LEFT JOIN k ON k.parent = w.parent AND k.key = w.db_name")
def repair_accents(spark, d):
    disk = disk_of(spark, d)
    wanted = disk.select("parent", paths.strip_accents("name").alias("db_name")).distinct()
    return paths.match_names(wanted, disk, [s for s in paths.STRATEGIES if s[0] in ("exact", "accents")])


@register(f"WITH {fx.DISK} SELECT DISTINCT parent, nfc_normalize(name) AS name, name AS found FROM (SELECT parent, min(name) AS name FROM disk GROUP BY parent, nfc_normalize(name))")
def repair_nfc(spark, d):
    """Catalogue names in decomposed form find the composed names on disk."""
    disk = disk_of(spark, d)
    wanted = disk.select("parent", paths.nfd("name").alias("db_name"), paths.nfc("name").alias("key")).distinct()
    found = paths.match_names(wanted, disk, [("normal_form", paths.nfc)])
    return found.select("parent", F.col("key").alias("name"), F.col("name").alias("found"))


@register(f"WITH {fx.DISK} SELECT DISTINCT parent, name, name AS found FROM disk")
def repair_markers(spark, d):
    disk = disk_of(spark, d)
    damaged = F.concat(F.lit("‪"), "name", F.lit("‬"))
    wanted = disk.select("parent", damaged.alias("db_name"), F.col("name").alias("own")).distinct()
    return paths.match_names(wanted, disk, [("markers", paths.strip_markers)]).select("parent", F.col("own").alias("name"), F.col("name").alias("found"))


@register(f"WITH {fx.DISK} SELECT DISTINCT parent, name || '''s' AS name, name || chr(8217) || 's' AS found FROM disk")
def repair_quotes(spark, d):
    disk = disk_of(spark, d)
    curly = disk.select("parent", F.concat("name", F.lit("’s")).alias("name"))
    wanted = disk.select("parent", F.concat("name", F.lit("'s")).alias("db_name")).distinct()
    return paths.match_names(wanted, curly, [("quotes", paths.fold_quotes)]).select("parent", F.col("db_name").alias("name"), F.col("name").alias("found"))


_ANY = "a AS (SELECT DISTINCT parent, name FROM disk WHERE NOT regexp_matches(name, '[^\\x00-\\x7F]'))"


@register(rf"WITH {fx.DISK}, {_ANY}, w AS (SELECT parent, name[2:] AS db_name FROM a GROUP BY ALL), c AS (SELECT w.parent, w.db_name, a.name, levenshtein(w.db_name, a.name) AS distance FROM w JOIN a USING (parent) WHERE levenshtein(w.db_name, a.name) <= 2), r AS (SELECT *, row_number() OVER (PARTITION BY parent, db_name ORDER BY distance, name) AS k FROM c) SELECT parent, db_name, name, distance::INT AS distance FROM r WHERE k = 1")
def fuzzy_match_names(spark, d):
    """Every ASCII name of a directory, of any length."""
    names = disk_of(spark, d).where(~paths.non_ascii(F.col("name"))).select("parent", "name").distinct()
    return paths.fuzzy_match(names.select("parent", F.expr("substring(name, 2)").alias("db_name")).distinct(), names)


@register(f"WITH {fx.FS}, p AS (SELECT pth FROM fs WHERE doc_id % 6 <> 1) SELECT CASE WHEN pth IN (SELECT pth FROM p) AND cantfind THEN 'found_but_flagged' WHEN pth NOT IN (SELECT pth FROM p) AND NOT cantfind THEN 'absent_not_flagged' ELSE 'consistent' END AS state, count(*) AS n FROM fs GROUP BY state")
def repair_verify(spark, d):
    fs = fs_of(spark, d)
    return paths.verify(fs, fs.where("doc_id % 6 <> 1").select("pth"))


@register(f"WITH {fx.FS}, l AS (SELECT * FROM fs WHERE cantfind), c AS (SELECT count(*) AS t, count(*) FILTER (pth LIKE '%/fr/%') AS french, count(*) FILTER (pth LIKE '%.txt') AS text, count(*) FILTER (pth LIKE '%/status') AS status FROM l) SELECT category, n, CASE WHEN t = 0 THEN 0 ELSE n * 100 // t END AS percent FROM (SELECT t, unnest(['french', 'text', 'status']) AS category, unnest([french, text, status]) AS n FROM c)")
def missing_categories(spark, d):
    return paths.categories(fs_of(spark, d), {"french": "/fr/", "text": r"\.txt$", "status": "/status$"})


@register(None)
def path_walk(spark, d):
    """Paths of decomposed, accent-less or marked parts, repaired against the tree on disk."""
    base = disk_of(spark, d)
    top = base.select(F.lit("").alias("parent"), F.split("parent", "/")[0].alias("name"))
    second = base.select(F.split("parent", "/")[0].alias("parent"), F.split("parent", "/")[1].alias("name"))
    tree = top.unionByName(second).unionByName(base.select("parent", "name")).distinct()
    damaged = F.concat_ws("/", "parent", paths.strip_accents("name"))
    return paths.outcome(paths.walk(base.select(damaged.alias("pth")).distinct(), tree, 3))


# --- blobs
@register("SELECT doc_id, sha256(text) AS blobid, sha256(source || '/' || doc_id || ':' || sha256(text)) AS path_id, sha256(text)[1:2] || '/' || sha256(text)[3:4] || '/' || sha256(text) AS target FROM documents")
def blob_ids(spark, d):
    rows = fx.table(spark, d, "documents").withColumn("blobid", F.sha2("text", 256))
    own = blobs.path_aware_id(F.concat_ws("/", "source", F.col("doc_id").cast("string")), F.col("blobid"))
    return rows.select("doc_id", "blobid", own.alias("path_id"), blobs.fanout(F.col("blobid")).alias("target"))


def blob_documents(spark, d):
    rows = fx.table(spark, d, "documents").select(
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), F.encode("text", "UTF-8").alias("content"), (F.lit(1.7e9) + F.col("doc_id")).alias("mtime")
    )
    return blobs.create(rows)


@register("SELECT source || '/' || doc_id AS path, sha256(text) AS blobid, true AS verified, strlen(text)::BIGINT AS size FROM documents")
def blob_roundtrip(spark, d):
    return blobs.restore(blob_documents(spark, d)).select("path", "blobid", "verified", F.octet_length("content").cast("long").alias("size"))


@register("SELECT sha256(text) AS blobid, source || '/' || doc_id AS pth, strlen(text)::BIGINT AS size, 1.7e9 + doc_id AS mtime FROM documents")
def blob_metadata(spark, d):
    return blobs.rebuild_catalogue(blob_documents(spark, d)).select("blobid", "pth", "size", "mtime")


@register("SELECT CASE doc_id % 3 WHEN 0 THEN 'JSON' WHEN 1 THEN 'BINARY' ELSE 'MISSING' END AS format, count(*) AS n FROM documents GROUP BY ALL")
def blob_format_class(spark, d):
    rows = blob_documents(spark, d).withColumn("k", F.split("path", "/")[1].cast("long") % 3)
    head = F.when(F.col("k") == 0, F.encode("document", "UTF-8")).when(F.col("k") == 1, F.unhex(F.concat(F.lit("1F8B08"), F.substring("blobid", 1, 8))))
    rows = rows.select(head.alias("b"))
    return rows.groupBy(blobs.format_class(F.substring("b", 1, 100), F.substring("b", -200, 200)).alias("format")).agg(F.count("*").alias("n"))


@register("SELECT doc_id, source || '/' || doc_id AS path FROM documents")
def path_encrypt_ecb(spark, d):
    """Encrypted and decrypted again."""
    rows = fx.table(spark, d, "documents").select("doc_id", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("p"))
    return rows.select("doc_id", blobs.decrypt_path(blobs.encrypt_path(F.col("p"), "secret"), "secret").alias("path"))


@register("SELECT doc_id, sha256(text) AS digest FROM documents")
def blob_gcm_roundtrip(spark, d):
    """Encrypted and decrypted again, each blob with the key of its own id."""
    rows = fx.table(spark, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("c"), F.sha2("text", 256).alias("blobid"))
    key, blobid = F.col("key"), F.col("blobid")
    return ciphers.with_keys(rows, "secret").select("doc_id", F.sha2(ciphers.decrypt_gcm(ciphers.encrypt_gcm(F.col("c"), key, blobid), key, blobid), 256).alias("digest"))


@register(f"WITH {fx.FS} SELECT pth, hash, blobid FROM fs WHERE ('0x' || md5(pth)[1:6])::INT < 0.01 * 16777216")
def sample_validation(spark, d):
    """A hundredth of the catalogue by a hash of the path, for inspection."""
    place = F.conv(F.substring(F.md5("pth"), 1, 6), 16, 10).cast("int")
    return fs_of(spark, d).where(place < 0.01 * 16_777_216).select("pth", "hash", "blobid")


# last, as they register their own queries here
from tallystone.plans import additions, listings, stores  # noqa: E402, F401
