"""Registered queries of frames, changeset chains, committed tables, supervised workers and similar names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone import fixtures as fx
from tallystone.operators import blake3, blobs, chains, frames, names, queue
from tallystone.plans.registry import fs_of, now, register
from tallystone.sources import scratch
from tallystone.sources.snapshots import Rows, SnapshotTable
from tallystone.streaming import watchdog


def documents(spark, d):
    return fx.table(spark, d, "documents")


# --- BLAKE3: no SQL knows it; tests hold it against published vectors
@register(None)
def blob_blake3(spark, d):
    return documents(spark, d).select("doc_id", blake3.blake3(F.encode("text", "utf-8")).alias("blobid"))


@register("""WITH b AS (SELECT doc_id, strlen(text) AS size, ceil(strlen(text) / 2048)::BIGINT AS n FROM documents)
SELECT doc_id, (CASE WHEN doc_id % 10 = 3 THEN greatest(n - 1, 0) * 2048 ELSE size END)::BIGINT AS size, (CASE WHEN doc_id % 10 = 3 THEN greatest(n - 1, 0) ELSE n END)::BIGINT AS frames,
NOT (size > 0 AND doc_id % 10 = 3 OR size > 2048 AND doc_id % 10 = 4) AS verified FROM b""")
def blob_frames(spark, d):
    """Texts as frames of 2 KiB, of which some lose their last frame and some have their first moved behind the others:
    what is left is decoded and checked, frame by frame, against the id of the whole text."""
    chunk, piece = 2048, 1024
    rows = documents(spark, d).select("doc_id", F.encode("text", "utf-8").alias("content"))
    rows = rows.withColumn("n", F.ceil(F.octet_length("content") / chunk).cast("long")).withColumn("blobid", F.concat("doc_id", F.lit("-"), blake3.blake3("content")))
    # cut before rows are made of them, so that no frame carries its whole text
    cuts = F.transform(F.sequence(F.lit(1).cast("long"), F.greatest("n", F.lit(1))), lambda k: F.substring("content", (k - 1) * chunk + 1, F.lit(chunk)))
    cut = rows.select("doc_id", "blobid", "n", F.posexplode(cuts)).withColumn("k", F.col("pos") + 1).where("k <= n AND NOT (doc_id % 10 = 3 AND k = n)")
    frame = F.when((F.col("doc_id") % 10 == 4) & (F.col("n") > 1), F.pmod(F.col("k") - 2, "n")).otherwise(F.col("k") - 1).cast("long")
    shuffled = cut.select("blobid", frame.alias("frame"), F.base64(blobs.compressed("col")).alias("data"))
    # names carry the document, as several have one text
    decoded = frames.decoded(shuffled, chunk, piece)
    found = frames.verified(decoded, rows, F.substring_index("blobid", "-", -1))
    return found.select(F.substring_index("blobid", "-", 1).cast("long").alias("doc_id"), "size", "frames", "verified")


# --- chains of changesets
def _actions(spark, d):
    rows = fx.table(spark, d, "events").selectExpr(
        "event_id", "user_id % 5 AS dataset", "datediff(ts, DATE'2024-01-01') AS seq", "concat('p', event_id % 300) AS pth",
        "IF(event_type = 'error', 'REMOVE', 'WRITE') AS action", "sha2(concat('c', event_id % 500), 256) AS blobid",
    )
    last = rows.groupBy("dataset", "seq", "pth").agg(F.max_by(F.struct("action", "blobid"), "event_id").alias("l"))
    return last.select("dataset", "seq", "pth", "l.action", "l.blobid")


_ACTIONS = """actions AS (SELECT dataset, seq, pth, arg_max(action, event_id) AS action, arg_max(blobid, event_id) AS blobid FROM (
    SELECT event_id, user_id % 5 AS dataset, date_diff('day', DATE '2024-01-01', ts::DATE)::INT AS seq, 'p' || event_id % 300 AS pth,
           CASE WHEN event_type = 'error' THEN 'REMOVE' ELSE 'WRITE' END AS action, sha256('c' || event_id % 500) AS blobid FROM events) GROUP BY ALL)"""
_CHAIN = f"""{_ACTIONS}, lines AS (SELECT dataset, seq, sha256(pth)[1:3] AS bucket, sha256(strlen(pth) || ':' || strlen(action) || ':' || strlen(blobid) || ':' || pth || ':' || action || ':' || blobid) AS line FROM actions),
buckets AS (SELECT dataset, seq, bucket, sha256(string_agg(line, '' ORDER BY line)) AS part FROM lines GROUP BY ALL),
manifests AS (SELECT dataset, seq, sha256(string_agg(bucket || part, '' ORDER BY bucket)) AS manifest, row_number() OVER (PARTITION BY dataset ORDER BY seq) AS i FROM buckets GROUP BY dataset, seq),
chain AS (SELECT dataset, seq, i, manifest, sha256(manifest) AS id, NULL::VARCHAR AS previous_id FROM manifests WHERE i = 1
    UNION ALL SELECT m.dataset, m.seq, m.i, m.manifest, sha256(m.manifest || c.id), c.id FROM chain c JOIN manifests m ON m.dataset = c.dataset AND m.i = c.i + 1)"""


@register(f"WITH RECURSIVE {_CHAIN} SELECT dataset, seq, manifest, id, previous_id FROM chain")
def changeset_chain(spark, d):
    """Ids in two goes: up to day 11, and on from there."""
    made = chains.manifests(_actions(spark, d))
    early = chains.extend(made.where("seq < 12"))
    heads = early.groupBy("dataset").agg(F.max_by("id", "seq").alias("id"))
    return early.unionByName(chains.extend(made.where("seq >= 12"), heads))


def _damaged(spark, d):
    """A recorded chain with a manifest, an id or a whole changeset wrong here and there."""
    whole = chains.extend(chains.manifests(_actions(spark, d)))
    kept = whole.where("(dataset + seq) % 13 <> 5")
    manifest = F.expr("IF((dataset + seq) % 11 = 3, sha2(manifest, 256), manifest)")
    return kept.withColumn("manifest", manifest).withColumn("id", F.expr("IF((dataset + seq) % 17 = 7, sha2(id, 256), id)"))


_VERIFIED = f"""{_CHAIN}, bad AS (SELECT dataset, seq, CASE WHEN (dataset + seq) % 11 = 3 THEN sha256(manifest) ELSE manifest END AS manifest,
    CASE WHEN (dataset + seq) % 17 = 7 THEN sha256(id) ELSE id END AS id, previous_id, i FROM chain WHERE (dataset + seq) % 13 <> 5),
verified AS (SELECT dataset, seq, CASE WHEN (dataset + seq) % 11 = 3 THEN 'manifest' WHEN (dataset + seq) % 17 = 7 THEN 'id'
    WHEN previous_id IS NOT NULL AND previous_id NOT IN (SELECT id FROM bad) THEN 'missing' ELSE 'ok' END AS status FROM bad)"""


@register(f"WITH RECURSIVE {_VERIFIED} SELECT dataset, seq, status FROM verified")
def changeset_chain_verify(spark, d):
    return chains.verify(_damaged(spark, d), _actions(spark, d))


@register(f"""WITH RECURSIVE {_VERIFIED}, stops AS (SELECT dataset, min(seq) FILTER (status <> 'ok' AND seq > 20) AS stop FROM verified GROUP BY dataset),
last AS (SELECT dataset, pth, arg_max(action, seq) AS action, arg_max(blobid, seq) AS blobid FROM actions JOIN stops USING (dataset) WHERE stop IS NULL OR seq < stop GROUP BY ALL)
SELECT dataset, pth, blobid FROM last WHERE action = 'WRITE'""")
def changeset_restore(spark, d):
    """From the checkpoints of days 10 and 20 on; the SQL replays everything."""
    actions = _actions(spark, d)
    checkpoints = chains.checkpoint(actions, F.lit(10)).unionByName(chains.checkpoint(actions, F.lit(20)))
    return chains.restore(actions, checkpoints, chains.verify(_damaged(spark, d), actions))


# --- supervision: the SQL follows each worker check by check
_CHECKS = """s AS (SELECT 'w' || user_id % 8 AS worker, ts, event_id AS id, floor(value) % 100 AS cpu, CASE WHEN event_id % 97 = 0 THEN 'zombie' WHEN event_id % 89 = 0 THEN 'disk-sleep' ELSE 'running' END AS status,
    event_type = 'signup' AS progress FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY worker ORDER BY ts, id) AS i, sum(cpu) OVER (PARTITION BY worker ORDER BY ts, id ROWS 4 PRECEDING) AS five,
    max(CASE WHEN progress THEN ts END) OVER (PARTITION BY worker ORDER BY ts, id) AS progressed FROM s),
begun AS (SELECT worker, 0::BIGINT AS i, 0::BIGINT AS n, NULL::TIMESTAMP AS since, NULL::TIMESTAMP AS restarted, 0::BIGINT AS restarts, NULL::TIMESTAMP AS ts, NULL::VARCHAR AS event, NULL::VARCHAR AS reason FROM o WHERE i = 1),
w AS (SELECT * FROM begun UNION ALL
    SELECT worker, i, CASE WHEN event = 'restart' THEN 0 ELSE n END, since, CASE WHEN event = 'restart' THEN ts ELSE restarted END, restarts + CASE WHEN event = 'restart' THEN 1 ELSE 0 END, ts, event, reason FROM (
        SELECT *, CASE WHEN reason IS NULL THEN NULL WHEN restarted IS NOT NULL AND ts - restarted <= INTERVAL 600 MINUTE THEN 'cooldown' ELSE 'restart' END AS event FROM (
            SELECT *, CASE WHEN status <> 'running' THEN 'unresponsive' WHEN n >= 5 AND five < 5 * 60 AND ts - greatest(since, progressed) > INTERVAL 120 MINUTE THEN 'stalled' END AS reason FROM (
                SELECT o.worker, o.i, w.n + 1 AS n, CASE WHEN w.n = 0 THEN o.ts ELSE w.since END AS since, w.restarted, w.restarts, o.ts, o.five, o.status,
                    CASE WHEN o.progressed >= CASE WHEN w.n = 0 THEN o.ts ELSE w.since END THEN o.progressed END AS progressed
                FROM w JOIN o ON o.worker = w.worker AND o.i = w.i + 1))))"""


@register(f"WITH RECURSIVE {_CHECKS} SELECT worker, ts, event, reason, restarts FROM w WHERE event IS NOT NULL")
def watchdog_events(spark, d):
    """Restarts of hung workers, and those put off as the last was too recent."""
    samples = fx.table(spark, d, "events").selectExpr(
        "concat('w', user_id % 8) AS worker", "ts", "event_id AS id", "floor(value) % 100 AS cpu", "CASE WHEN event_id % 97 = 0 THEN 'zombie' WHEN event_id % 89 = 0 THEN 'disk-sleep' ELSE 'running' END AS status",
        "event_type = 'signup' AS progress",
    )
    found = watchdog.supervise(samples, watchdog.Limits(idle=60, stalled=120, cooldown=600))
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# --- a queue that several drivers claim from
_FREE = f"{fx.QUEUE}, free AS (SELECT q.pth, row_number() OVER (ORDER BY fs.size, q.pth) AS r FROM work_queue q JOIN fs USING (pth) WHERE claimed_at IS NULL)"


@register(f"""WITH {_FREE} SELECT q.pth, coalesce(CASE WHEN r <= 60 THEN 'second' WHEN r <= 90 THEN 'first' END, claimed_by) AS claimed_by,
CASE WHEN r <= 90 THEN TIMESTAMP '{fx.AS_OF}' ELSE claimed_at END AS claimed_at FROM work_queue q LEFT JOIN free USING (pth) WHERE r IS NULL OR r <= 90 OR r > 100""")
def queue_committed(spark, d):
    """Two drivers claim from one version: the first to commit gets the first 60 paths, the other's claim is made again and
    gets the next 30; the ten after these are taken out."""
    fs = fs_of(spark, d).cache()
    table = SnapshotTable.create(fx.work_queue(fs), scratch.new_path(spark, "queue"), "pth")
    seen = []

    def late(rows):
        if not seen:
            seen.append(queue.commit_claim(SnapshotTable(spark, table.root), fs, "second", now(), 60))
        chosen = queue.claim(rows, fs, "first", now(), 30).delta
        return Rows(put=rows.join(chosen.select("pth"), "pth", "left_semi").withColumn("claimed_at", now()).withColumn("claimed_by", F.lit("first")))

    table.transact(late, "claim by first")
    rest = table.read().where("claimed_at IS NULL").join(fs.select("pth", "size"), "pth").orderBy("size", "pth").limit(10)
    queue.commit_finished(table, rest)
    return table.read().select("pth", "claimed_by", "claimed_at")


# --- similar names: the SQL compares all names of a folder
@register("""WITH disk AS (SELECT DISTINCT p_brand AS parent, lower(p_type) || ' ' || p_name AS name, p_partkey FROM part),
asked AS (SELECT DISTINCT parent, CASE p_partkey % 4 WHEN 1 THEN name[:4] || 'x' || name[6:] WHEN 2 THEN name[2:] || '!' WHEN 3 THEN upper(name) ELSE name END AS db_name FROM disk),
s AS (SELECT DISTINCT asked.parent, db_name, name, CASE WHEN db_name = name THEN 1.0 ELSE 1 - levenshtein(db_name, name)::DOUBLE / greatest(len(db_name), len(name)) END AS s FROM asked JOIN disk USING (parent)),
r AS (SELECT *, row_number() OVER (PARTITION BY parent, db_name ORDER BY s DESC, name) AS r FROM s WHERE s > 0.85) SELECT parent, db_name, name, round(s, 6) AS score FROM r WHERE r = 1""")
def similar_names(spark, d):
    disk = fx.table(spark, d, "part").select(F.col("p_brand").alias("parent"), F.concat(F.lower("p_type"), F.lit(" "), "p_name").alias("name"), "p_partkey")
    damaged = F.expr("""CASE p_partkey % 4 WHEN 1 THEN concat(substring(name, 1, 4), 'x', substring(name, 6)) WHEN 2 THEN concat(substring(name, 2), '!') WHEN 3 THEN upper(name) ELSE name END""")
    return names.similar(disk.select("parent", damaged.alias("db_name")), disk)
