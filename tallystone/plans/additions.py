"""Further registered queries: spelling repair, batches of results, recovery, labels, sampling, sealed blobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone import fixtures as fx
from tallystone.functions import clamp, format_throughput, format_timestamp
from tallystone.operators import blobs, catalogue, metrics, queue, reconcile, spelling
from tallystone.plans.registry import ELIGIBLE, NOW, fs_of, now, register


def documents(spark, d):
    return fx.table(spark, d, "documents")


def quoted(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def nth(words, key: str):
    """The word whose number is the key's remainder."""
    return F.element_at(F.array(*map(F.lit, words)), (F.col(key) % len(words) + 1).cast("int"))


_WORD = f"({quoted(spelling.SPANISH)})[doc_id % {len(spelling.SPANISH)} + 1]"


# --- spelling
@register(f"SELECT doc_id, concat(lower({_WORD}), ' x', strip_accents({_WORD}), '-', upper({_WORD}), ' ', doc_id) AS name FROM documents")
def repair_dictionary(spark, d):
    """Whole words only: what has a letter before it stays."""
    word = nth(spelling.SPANISH, "doc_id")
    plain = nth([spelling.without_accents(w) for w in spelling.SPANISH], "doc_id")
    damaged = F.concat(F.lower(plain), F.lit(" x"), plain, F.lit("-"), F.upper(plain), F.lit(" "), F.col("doc_id").cast("string"))
    return documents(spark, d).where(word.isNotNull()).select("doc_id", spelling.replace_words(damaged, spelling.spanish()).alias("name"))


@register("SELECT doc_id, concat('xRodríguez', doc_id, 'MUÑOZ') AS name FROM documents")
def repair_dictionary_parts(spark, d):
    damaged = F.concat(F.lit("xRodriguez"), F.col("doc_id").cast("string"), F.lit("MUNOZ"))
    return documents(spark, d).select("doc_id", spelling.replace_parts(damaged, list(spelling.spanish().items())).alias("name"))


_SHORT = f"({quoted(spelling.CONTRACTIONS)})[doc_id % {len(spelling.CONTRACTIONS)} + 1]"


@register(f"SELECT doc_id, concat('a_', replace({_SHORT}, '''', ''), ' ', {_SHORT}, ' ', doc_id) AS name FROM documents")
def repair_contractions(spark, d):
    plain = nth([w.replace("'", "") for w in spelling.CONTRACTIONS], "doc_id")
    damaged = F.concat(F.lit("a_"), plain, F.lit(" "), plain, F.lit(" "), F.col("doc_id").cast("string"))
    return documents(spark, d).select("doc_id", spelling.replace_words(damaged, spelling.contractions()).alias("name"))


@register("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN concat('m/Björk/', doc_id) WHEN 1 THEN concat('m/Bjork/', doc_id) WHEN 2 THEN concat('m/Bjork - ', doc_id) END AS variant, CASE doc_id % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'replaced_Björk_with_Bjork' WHEN 2 THEN 'multiple_replacements' END AS method FROM documents")
def repair_substitutions(spark, d):
    """Exact, one substitution, several, and nothing on disk."""
    k = F.col("doc_id") % 4
    number = F.col("doc_id").cast("string")
    rows = documents(spark, d).select("doc_id", F.when(k == 2, F.concat(F.lit("m/Björk — "), number)).otherwise(F.concat(F.lit("m/Björk/"), number)).alias("pth"))
    present = documents(spark, d).where(k < 3).select(F.when(k == 0, F.concat(F.lit("m/Björk/"), number)).when(k == 1, F.concat(F.lit("m/Bjork/"), number)).otherwise(F.concat(F.lit("m/Bjork - "), number)).alias("pth"))
    return spelling.first_present(rows, present, spelling.substitution_variants(F.col("pth"))).select("doc_id", "variant", "method")


@register("SELECT doc_id, concat('a/', CASE doc_id % 3 WHEN 0 THEN 'patrick''s iPhone' WHEN 1 THEN 'Jose x, María x' ELSE 'plain' END, '/', doc_id) AS fixed, CASE doc_id % 3 WHEN 0 THEN 'patricks_to_apostrophe' WHEN 1 THEN 'spanish_José ' END AS label FROM documents")
def repair_known_fixes(spark, d):
    """Of the last fixes only the first that applies is made."""
    middle = F.when(F.col("doc_id") % 3 == 0, "patricks iPhone").when(F.col("doc_id") % 3 == 1, "José x, María x").otherwise("plain")
    fixed, label = spelling.known_fix(F.concat(F.lit("a/"), middle, F.lit("/"), F.col("doc_id").cast("string")))
    return documents(spark, d).select("doc_id", fixed.alias("fixed"), label.alias("label"))


@register("SELECT label, count(*) AS n FROM (SELECT CASE doc_id % 3 WHEN 0 THEN 'patricks_to_apostrophe' WHEN 1 THEN 'spanish_José ' ELSE 'none' END AS label FROM documents) GROUP BY label")
def repair_fix_counts(spark, d):
    return repair_known_fixes(spark, d).groupBy(F.coalesce("label", F.lit("none")).alias("label")).agg(F.count("*").alias("n"))


_METHODS = "CASE doc_id % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'no_accent_full' WHEN 2 THEN 'no_accent_filename' WHEN 3 THEN 'no_accent_parent' END"


@register(f"SELECT 'é' || doc_id AS parent, 'ñ' AS db_name, {_METHODS} AS method, CASE doc_id % 5 WHEN 0 THEN 'é' || doc_id || '/ñ' WHEN 1 THEN 'e' || doc_id || '/n' WHEN 2 THEN 'é' || doc_id || '/n' WHEN 3 THEN 'e' || doc_id || '/ñ' END AS found FROM documents")
def repair_accents_by_level(spark, d):
    rows = documents(spark, d).select("doc_id", F.concat(F.lit("é"), F.col("doc_id").cast("string")).alias("parent"), F.lit("ñ").alias("db_name"))
    k = F.col("doc_id") % 5
    plain = F.concat(F.lit("e"), F.col("doc_id").cast("string"))
    disk = rows.where(k < 4).select(F.when(k.isin(1, 3), plain).otherwise(F.col("parent")).alias("parent"), F.when(k.isin(1, 2), "n").otherwise("ñ").alias("name"))
    return spelling.by_accents(rows, disk).select("parent", "db_name", "method", "found")


@register("SELECT 'a ' || doc_id || '’s' AS parent, 'b–c' AS db_name, 'a ' || doc_id || '''s/b-c' AS found FROM documents")
def repair_combinations(spark, d):
    """Folders and files damaged in different ways."""
    number = F.col("doc_id").cast("string")
    rows = documents(spark, d).select(F.concat(F.lit("a "), number, F.lit("’s")).alias("parent"), F.lit("b–c").alias("db_name"))
    disk = documents(spark, d).select(F.concat(F.lit("a "), number, F.lit("'s")).alias("parent"), F.lit("b-c").alias("name"))
    return spelling.combinations(rows, disk)


@register("SELECT CASE doc_id % 4 WHEN 0 THEN 'no_backup' WHEN 1 THEN 'deleted_backup' ELSE 'existing_backup' END AS kind, count(*) AS n FROM documents GROUP BY ALL")
def backup_classes(spark, d):
    k = F.col("doc_id") % 4
    number = F.col("doc_id").cast("string")
    missing = documents(spark, d).select(F.when(k == 0, F.concat(F.lit("t/x/"), number)).otherwise(F.concat(F.lit("t/back-"), k.cast("string"), F.lit("/d/"), number)).alias("pth"))
    backups = spark.createDataFrame([("t/back-2",), ("t/back-3",), ("t/back-3",), ("u/back-1",)], "folder string")
    return spelling.backup_class(missing, backups)


@register("SELECT doc_id, 'U+0065' AS was, 'U+00E9' AS is_now, 1 AS place FROM documents")
def code_point_differences(spark, d):
    number = F.col("doc_id").cast("string")
    found = spelling.differing_code_points(F.concat(F.lit("ae"), number), F.concat(F.lit("aé"), number))
    return documents(spark, d).select("doc_id", F.explode(found).alias("x")).select("doc_id", F.col("x.left").alias("was"), F.col("x.right").alias("is_now"), F.col("x.place").alias("place"))


@register(f"""WITH {fx.FS}, m AS (SELECT pth, CASE WHEN doc_id % 10 = 1 THEN 'same' || doc_id // 20 ELSE 'new/' || pth END AS r FROM fs WHERE doc_id % 5 = 1),
ok AS (SELECT pth, r FROM m WHERE r NOT IN (SELECT r FROM m GROUP BY r HAVING count(*) > 1))
SELECT coalesce(r, fs.pth) AS pth, cantfind AND r IS NULL AS cantfind FROM fs LEFT JOIN ok ON fs.pth = ok.pth""")
def rename_paths(spark, d):
    """Names that two paths would get are given to neither."""
    fs = fs_of(spark, d)
    mapping = fs.where("doc_id % 5 = 1").selectExpr("pth", "IF(doc_id % 10 = 1, concat('same', doc_id DIV 20), concat('new/', pth)) AS repaired")
    return catalogue.rename(fs, mapping)[0].state.select("pth", "cantfind")


@register(f"""WITH {fx.FS}, m AS (SELECT pth, CASE WHEN doc_id % 10 = 1 THEN 'same' || doc_id // 20 ELSE 'new/' || pth END AS r FROM fs WHERE doc_id % 5 = 1)
SELECT pth, r AS repaired FROM m WHERE r IN (SELECT r FROM m GROUP BY r HAVING count(*) > 1)""")
def rename_collisions(spark, d):
    fs = fs_of(spark, d)
    mapping = fs.where("doc_id % 5 = 1").selectExpr("pth", "IF(doc_id % 10 = 1, concat('same', doc_id DIV 20), concat('new/', pth)) AS repaired")
    return catalogue.rename(fs, mapping)[1]


@register(f"WITH {fx.FS} SELECT pth FROM fs WHERE cantfind AND pth LIKE '%/fr/%'")
def clear_cantfind(spark, d):
    return catalogue.clear_flag(fs_of(spark, d), F.col("pth").rlike("/fr/")).delta.select("pth")


# --- queue
_RESULTS = f"""{fx.QUEUE}, results AS (SELECT pth, CASE WHEN doc_id % 3 = 0 THEN sha256(pth) END AS new, CASE doc_id % 3 WHEN 1 THEN 'File Not Found: x' WHEN 2 THEN 'timeout' END AS error FROM fs WHERE doc_id % 4 = 1)"""


def _finished(spark, d):
    fs = fs_of(spark, d)
    results = fs.where("doc_id % 4 = 1").selectExpr("pth", "IF(doc_id % 3 = 0, sha2(pth, 256), NULL) AS blobid", "CASE doc_id % 3 WHEN 1 THEN 'File Not Found: x' WHEN 2 THEN 'timeout' END AS error")
    return queue.finish_batch(fx.work_queue(fs), fs, results, now())


@register(f"WITH {_RESULTS} SELECT pth, CASE WHEN error IS NULL THEN new ELSE blobid END AS blobid, CASE WHEN error IS NULL THEN {NOW} ELSE uploaded END AS uploaded, CASE WHEN error LIKE '%Not Found%' THEN {NOW} ELSE last_missing_at END AS last_missing_at FROM fs JOIN results USING (pth) WHERE error IS NULL OR error LIKE '%Not Found%'")
def finish_batch_catalogue(spark, d):
    return _finished(spark, d)[0].delta.select("pth", "blobid", "uploaded", "last_missing_at")


@register(f"WITH {_RESULTS} SELECT pth, claimed_by FROM work_queue WHERE pth NOT IN (SELECT pth FROM results)")
def finish_batch_queue(spark, d):
    """Paths with any result leave the queue, errors too."""
    return _finished(spark, d)[1].state.select("pth", "claimed_by")


@register(f"WITH {fx.FS} SELECT pth FROM fs WHERE {ELIGIBLE}")
def queue_setup_empty(spark, d):
    fs = fs_of(spark, d)
    return queue.setup(fx.work_queue(fs).limit(0), fs, now()).state.select("pth")


@register(f"WITH {fx.QUEUE} SELECT pth, CASE WHEN claimed_at >= {NOW} - INTERVAL 30 MINUTE THEN claimed_by END AS claimed_by FROM work_queue")
def queue_setup_again(spark, d):
    fs = fs_of(spark, d)
    return queue.setup(fx.work_queue(fs), fs, now()).state.select("pth", "claimed_by")


@register(f"WITH {fx.QUEUE} SELECT pth FROM work_queue WHERE claimed_at IS NULL ORDER BY pth LIMIT 1 OFFSET 7")
def queue_claim_at(spark, d):
    return queue.claim_at(fx.work_queue(fs_of(spark, d)), 7).select("pth")


@register(f"WITH {fx.FS} SELECT pth, size FROM fs WHERE {ELIGIBLE} AND processing_started IS NULL ORDER BY CASE WHEN pth LIKE 'web/%' THEN 0 ELSE 1 END, size, pth LIMIT 20")
def priority_order(spark, d):
    """A report of the first twenty."""
    rows = fs_of(spark, d).where(catalogue.eligible(processing=True))
    return rows.orderBy(F.when(F.col("pth").startswith("web/"), 0).otherwise(1), "size", "pth").limit(20).select("pth", "size")


# --- reconciliation
@register(f"""WITH {fx.STORAGE}, wanted AS (SELECT DISTINCT blobid FROM fs WHERE blobid IS NOT NULL AND blobid <> '{fx.DIRECTORY}' UNION SELECT sha256('lost' || doc_id) FROM fs WHERE doc_id % 50 = 0),
src AS (SELECT blobid, min(pth) AS pth FROM fs WHERE blobid IS NOT NULL GROUP BY blobid), again AS (SELECT pth, CASE WHEN doc_id % 9 = 0 THEN 'other' ELSE blobid END AS new FROM fs WHERE doc_id % 7 <> 0)
SELECT blobid, src.pth AS pth, CASE WHEN blobid IN (SELECT blobid FROM storage) THEN 'present' WHEN src.pth IS NULL THEN 'no_source' WHEN new IS NULL THEN 'source_missing' WHEN new <> blobid THEN 'content_changed' ELSE 'recovered' END AS status
FROM wanted LEFT JOIN src USING (blobid) LEFT JOIN again ON src.pth = again.pth""")
def recovery_status(spark, d):
    fs = fs_of(spark, d)
    wanted = reconcile.known_blobs(fs).unionByName(fs.where("doc_id % 50 = 0").selectExpr("sha2(concat('lost', doc_id), 256) AS blobid"))
    remade = fs.where("doc_id % 7 <> 0").selectExpr("pth", "IF(doc_id % 9 = 0, 'other', blobid) AS new_blobid")
    return reconcile.recovery_status(wanted, fs, fx.storage(fs), remade)


@register(f"WITH {fx.FS} SELECT pth, size, size + 1 AS disk_size FROM fs WHERE doc_id % 6 = 0")
def size_mismatches(spark, d):
    fs = fs_of(spark, d)
    return reconcile.size_mismatches(fs, fs.selectExpr("pth", "IF(doc_id % 6 = 0, size + 1, size) AS disk_size"))


_COPIES = f"{fx.FS}, copies AS (SELECT blobid, 'b' || k AS backend, CASE (doc_id + k) % 3 WHEN 0 THEN 'uploaded' WHEN 1 THEN 'pending' ELSE 'failed' END AS status FROM fs, (SELECT unnest([0, 1, 2, 3]) AS k) WHERE main AND blobid IS NOT NULL AND blobid <> '{fx.DIRECTORY}')"


def _copies(spark, d):
    own = fs_of(spark, d).where(f"main AND blobid IS NOT NULL AND blobid <> '{fx.DIRECTORY}'").select("doc_id", "blobid", F.explode(F.array(*map(F.lit, range(4)))).alias("k"))
    return own.selectExpr("blobid", "concat('b', k) AS backend", "CASE (doc_id + k) % 3 WHEN 0 THEN 'uploaded' WHEN 1 THEN 'pending' ELSE 'failed' END AS status")


@register(f"WITH {_COPIES}, h AS (SELECT blobid, count(DISTINCT backend) FILTER (status = 'uploaded') AS held FROM copies GROUP BY blobid) SELECT blobid, held, CASE WHEN held >= 2 THEN 'healthy' WHEN held > 0 THEN 'degraded' ELSE 'lost' END AS health FROM h")
def backend_health(spark, d):
    return reconcile.backend_health(_copies(spark, d), 2)


@register(f"WITH {_COPIES} SELECT backend, count(*) FILTER (status = 'uploaded') AS uploaded, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'failed') AS failed FROM copies GROUP BY backend")
def backend_status(spark, d):
    return reconcile.backend_status(_copies(spark, d))


@register(f"WITH {_COPIES} SELECT blobid, status FROM copies WHERE backend = 'b1' AND status IN ('failed', 'pending')")
def backend_pending(spark, d):
    return reconcile.pending_copies(_copies(spark, d), "b1").select("blobid", "status")


@register(f'WITH {fx.FS} SELECT blobid, count(*) AS "references" FROM fs WHERE blobid IS NOT NULL GROUP BY blobid')
def reference_counts(spark, d):
    return catalogue.reference_counts(fs_of(spark, d))


@register(f"WITH {fx.FILES} SELECT path, size FROM files WHERE changeset_id = 'cs-1995' AND regexp_matches(path, '^o[0-9]*7/')")
def search_files(spark, d):
    return reconcile.search_files(fx.files(spark, d), "^o[0-9]*7/", "cs-1995").select("path", "size")


_SNAPSHOTS = "s AS (SELECT DISTINCT changeset_id, 'd' || CAST(substr(changeset_id, 4) AS INT) % 2 AS dataset, make_timestamp(CAST(substr(changeset_id, 4) AS INT), 12, 31, 0, 0, 0.0) AS t FROM files)"


@register(f"WITH {fx.FILES}, {_SNAPSHOTS}, l AS (SELECT dataset, arg_max(changeset_id, t) AS changeset_id FROM s WHERE t <= TIMESTAMP '1997-06-01' GROUP BY dataset) SELECT dataset, path FROM files JOIN l USING (changeset_id)")
def snapshot_files(spark, d):
    files = fx.files(spark, d)
    year = F.substring("changeset_id", 4, 4).cast("int")
    snapshots = files.select("changeset_id").distinct().select("changeset_id", F.concat(F.lit("d"), (year % 2).cast("string")).alias("dataset"), F.make_timestamp_ntz(year, F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias("snapshot_timestamp"))
    return reconcile.snapshot_files(files, snapshots, F.lit("1997-06-01").cast("timestamp_ntz")).select("dataset", "path")


@register(f"WITH {fx.FS} SELECT uploaded, pth FROM fs WHERE uploaded >= TIMESTAMP '2025-09-02 03:00:00' ORDER BY uploaded, pth LIMIT 1")
def first_upload_from(spark, d):
    return reconcile.first_from(fs_of(spark, d), "uploaded", fx.at("2025-09-02 03:00:00"), ["pth"])


@register(f"WITH {fx.FS} SELECT uploaded, count(*) AS n FROM fs WHERE uploaded IS NOT NULL GROUP BY uploaded ORDER BY uploaded DESC LIMIT 5")
def latest_upload_times(spark, d):
    return reconcile.timestamp_sample(fs_of(spark, d), "uploaded")


# --- metrics
@register("SELECT count(*) AS files, sum(strlen(text))::BIGINT AS original_bytes, sum(strlen(text) + doc_id % 7)::BIGINT AS blob_bytes, round(avg((strlen(text) + doc_id % 7)::DOUBLE / nullif(strlen(text), 0)), 6) AS mean_ratio, round(sum(strlen(text) + doc_id % 7)::DOUBLE / sum(strlen(text)), 6) AS total_ratio, round(count(*) * 1000.0::DOUBLE / sum(doc_id % 5 + 1), 6) AS files_per_second, round(sum(strlen(text))::DOUBLE / 1000 / sum(doc_id % 5 + 1), 6) AS megabytes_per_second, round(sum(doc_id % 5 + 1)::DOUBLE / count(*), 6) AS ms_per_file FROM documents")
def benchmark_summary(spark, d):
    size = F.octet_length("text").cast("long")
    return metrics.benchmark_summary(documents(spark, d).select(size.alias("original_bytes"), (size + F.col("doc_id") % 7).alias("blob_bytes"), (F.col("doc_id") % 5 + 1).alias("ms")))


@register("SELECT event_id, CASE WHEN m < 50 AND o < 20 THEN CASE WHEN l < 2000000000 AND u > 0.8 * l THEN 'increase_aggressive' END WHEN m < 70 AND o < 30 THEN CASE WHEN l < 1500000000 AND u > 0.9 * l THEN 'increase_moderate' END WHEN m > 85 OR o > 40 THEN 'decrease' END AS action FROM (SELECT event_id, event_id % 100 AS m, event_id % 60 AS o, 1000000000 + event_id % 3 * 500000000 AS l, 900000000 + event_id % 11 * 100000000 AS u FROM events)")
def memory_actions(spark, d):
    e = F.col("event_id")
    action = metrics.memory_action(e % 100, e % 60, 1_000_000_000 + e % 3 * 500_000_000, 900_000_000 + e % 11 * 100_000_000)
    return fx.table(spark, d, "events").select("event_id", action.alias("action"))


@register("""SELECT event_id, CASE WHEN q = -1 THEN '[?]' WHEN q > 80 THEN '[HIGH]' WHEN q > 50 THEN '[MED]' ELSE '[LOW]' END AS queue, CASE WHEN s > 500 THEN '[BACKLOG]' WHEN s > 200 THEN '[BUSY]' ELSE '[OK]' END AS stage,
CASE WHEN q = -1 THEN CASE WHEN 2 < 4 AND c < 50 THEN '[C-SLOW]' WHEN s > 500 THEN '[U-SLOW]' ELSE '[OK]' END WHEN q > 70 THEN '[C-SLOW]' WHEN s > 500 THEN '[U-SLOW]' WHEN w < 8 THEN '[DB-LAG]' WHEN c > 90 THEN '[CPU-MAX]' WHEN m > 85 THEN '[MEM-HIGH]' ELSE '[OK]' END AS bottleneck
FROM (SELECT event_id, event_id % 102 - 1 AS q, event_id % 701 AS s, event_id % 23 AS w, event_id % 97 AS c, event_id % 93 AS m FROM events)""")
def status_labels(spark, d):
    e = F.col("event_id")
    q, s = e % 102 - 1, e % 701
    return fx.table(spark, d, "events").select("event_id", metrics.queue_label(q).alias("queue"), metrics.stage_label(s).alias("stage"), metrics.bottleneck_label(q, s, e % 23, F.lit(4), F.lit(2), e % 97, e % 93).alias("bottleneck"))


@register("SELECT user_id % 8 AS worker, round(CASE WHEN sum(value) + sum(event_id % 50) > 0 THEN 100.0 * sum(value) / (sum(value) + sum(event_id % 50)) ELSE 0 END, 6) AS idle_percent FROM events GROUP BY ALL")
def idle_percents(spark, d):
    rows = fx.table(spark, d, "events").groupBy((F.col("user_id") % 8).alias("worker")).agg(F.sum("value").alias("w"), F.sum(F.col("event_id") % 50).alias("b"))
    return rows.select("worker", metrics.idle_percent(F.col("w"), F.col("b")).alias("idle_percent"))


@register("SELECT count(DISTINCT user_id % 8) AS workers, sum(event_id % 10)::BIGINT AS hashed, sum(event_id % 3)::BIGINT AS hits, round(100.0::DOUBLE * sum(event_id % 3) / greatest(sum(event_id % 10), 1), 6) AS hit_percent FROM events")
def worker_totals(spark, d):
    return metrics.worker_totals(fx.table(spark, d, "events").select((F.col("user_id") % 8).alias("worker"), (F.col("event_id") % 10).alias("hashed"), (F.col("event_id") % 3).alias("hits")))


@register("SELECT count(*) AS groups, round(avg(v), 6) AS mean FROM (SELECT user_id, arg_max(event_id % 100, (ts, event_id)) AS v FROM events GROUP BY user_id)")
def mean_of_latest(spark, d):
    return metrics.mean_of_latest(fx.table(spark, d, "events").withColumn("cpu", F.col("event_id") % 100), "user_id", "cpu", "ts", "event_id")


@register("SELECT doc_id, strftime(make_timestamp((1700000000 + doc_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS at, CASE WHEN doc_id % 4 = 0 THEN '∞ MB/s' ELSE printf('%.1f MB/s', doc_id / 2 / (doc_id % 4)) END AS rate, greatest(10, least(100, doc_id)) AS clamped FROM documents")
def formats(spark, d):
    seconds = F.col("doc_id") % 4
    rate = format_throughput(F.col("doc_id") / 2, seconds)
    return documents(spark, d).select("doc_id", format_timestamp(1_700_000_000 + F.col("doc_id")).alias("at"), rate.alias("rate"), clamp(F.col("doc_id"), 10, 100).cast("long").alias("clamped"))


# --- blobs
@register("SELECT DISTINCT sha256(text) AS blobid, true AS verified, strlen(text)::BIGINT AS size FROM documents")
def blob_seal_recover(spark, d):
    """Compressed, encrypted with ChaCha20-Poly1305 under the key of its own id, and recovered; each content and key once."""
    files = documents(spark, d).select(F.encode("text", "UTF-8").alias("content")).distinct()
    found = blobs.recover(blobs.seal(files, "secret", keep_key=True), "secret")
    return found.select("blobid", "verified", F.octet_length("content").cast("long").alias("size"))


@register("SELECT doc_id, doc_id % 3 <> 1 AS valid FROM documents")
def valid_documents(spark, d):
    text = F.when(F.col("doc_id") % 3 == 0, F.to_json(F.struct("doc_id", "text"))).when(F.col("doc_id") % 3 == 1, F.lit('{"cut": ')).otherwise(F.lit("[1, null]"))
    return documents(spark, d).select("doc_id", blobs.valid_document(text).alias("valid"))


@register(f"WITH {fx.FILES} SELECT file_id, path, changeset_id FROM files WHERE is_canonical AND upload_finish_tm IS NULL AND NOT is_symlink")
def files_not_finished(spark, d):
    return fx.files(spark, d).where("is_canonical AND upload_finish_tm IS NULL AND NOT is_symlink").select("file_id", "path", "changeset_id")
