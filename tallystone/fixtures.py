"""Relations of a file catalogue derived from the base tables, for queries, benchmarks and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Stands for the database clock: no query reads the time of day.
AS_OF = "2025-09-03 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
DIRECTORY = "DIRECTORY_SKIPPED"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fs``: one row per path."""
    rank = F.row_number().over(Window.partitionBy(F.md5("text")).orderBy("doc_id"))
    rows = table(spark, sf_dir, "documents").withColumn("rn", rank)
    rows = rows.withColumn("main", F.expr("rn = 1 AND doc_id % 5 <> 0"))
    rows = rows.withColumn(
        "blobid",
        F.expr(f"""CASE WHEN main AND doc_id % 3 <> 0 THEN IF(doc_id % 97 = 0, '{DIRECTORY}', sha2(text, 256))
                        WHEN NOT main AND doc_id % 25 = 0 THEN sha2(text, 256) END"""),
    )
    return rows.selectExpr(
        "doc_id",
        """concat(source, '/', lang, '/', doc_id, '/f', n_chars % 50,
           CASE WHEN doc_id % 41 = 0 THEN '/status' WHEN doc_id % 43 = 0 THEN '/.git' WHEN doc_id % 47 = 0 THEN '/' ELSE '.txt' END) AS pth""",
        "source AS tree",
        "doc_id % 40 AS inode",
        "n_chars * 1000 AS size",
        "IF(doc_id % 23 <> 0, md5(text), NULL) AS hash",
        "main",
        "blobid",
        "IF(blobid IS NOT NULL, TIMESTAMP_NTZ'2025-09-02 00:00:00' + make_dt_interval(0, 0, doc_id), NULL) AS uploaded",
        "IF(doc_id % 37 = 0, TIMESTAMP_NTZ'2025-09-01 00:00:00' + make_dt_interval(0, 0, doc_id), NULL) AS last_missing_at",
        "IF(doc_id % 29 = 0 AND blobid IS NULL, TIMESTAMP_NTZ'2025-09-03 00:00:00' - make_dt_interval(0, 0, doc_id % 120), NULL) AS processing_started",
        "doc_id % 31 = 0 AS cantfind",
        "IF(doc_id % 13 <> 0, CAST(1700000000.0 + doc_id AS DOUBLE), NULL) AS mtime",
    )


FS = f"""
fs_base AS (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents),
fs_main AS (SELECT *, rn = 1 AND doc_id % 5 <> 0 AS main FROM fs_base),
fs_blob AS (SELECT *, CASE WHEN main AND doc_id % 3 <> 0 THEN CASE WHEN doc_id % 97 = 0 THEN '{DIRECTORY}' ELSE sha256(text) END
                           WHEN NOT main AND doc_id % 25 = 0 THEN sha256(text) END AS blobid FROM fs_main),
fs AS (SELECT doc_id, concat(source, '/', lang, '/', doc_id, '/f', n_chars % 50,
         CASE WHEN doc_id % 41 = 0 THEN '/status' WHEN doc_id % 43 = 0 THEN '/.git' WHEN doc_id % 47 = 0 THEN '/' ELSE '.txt' END) AS pth,
         source AS tree, doc_id % 40 AS inode, n_chars * 1000 AS size, CASE WHEN doc_id % 23 <> 0 THEN md5(text) END AS hash, main, blobid,
         CASE WHEN blobid IS NOT NULL THEN TIMESTAMP '2025-09-02 00:00:00' + to_minutes(doc_id) END AS uploaded,
         CASE WHEN doc_id % 37 = 0 THEN TIMESTAMP '2025-09-01 00:00:00' + to_minutes(doc_id) END AS last_missing_at,
         CASE WHEN doc_id % 29 = 0 AND blobid IS NULL THEN TIMESTAMP '2025-09-03 00:00:00' - to_minutes(doc_id % 120) END AS processing_started,
         doc_id % 31 = 0 AS cantfind, CASE WHEN doc_id % 13 <> 0 THEN (1700000000.0 + doc_id)::DOUBLE END AS mtime FROM fs_blob)"""


def work_queue(fs: DataFrame) -> DataFrame:
    return fs.where("doc_id % 4 <> 3").selectExpr(
        "pth",
        "IF(doc_id % 6 = 0, TIMESTAMP_NTZ'2025-09-03 00:00:00' - make_dt_interval(0, 0, doc_id % 90), NULL) AS claimed_at",
        "IF(doc_id % 6 = 0, concat('worker_', doc_id % 8), NULL) AS claimed_by",
        "TIMESTAMP_NTZ'2025-09-01 00:00:00' AS created_at",
    )


QUEUE = (
    FS
    + """,
work_queue AS (SELECT pth, CASE WHEN doc_id % 6 = 0 THEN TIMESTAMP '2025-09-03 00:00:00' - to_minutes(doc_id % 90) END AS claimed_at,
    CASE WHEN doc_id % 6 = 0 THEN concat('worker_', doc_id % 8) END AS claimed_by, TIMESTAMP '2025-09-01 00:00:00' AS created_at
    FROM fs WHERE doc_id % 4 <> 3)"""
)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``files`` of the changeset library, from ``lineitem``.

    Rows are dealt out once, by what is a hard link's device and inode, before they get their long columns.
    """
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    rows = table(spark, sf_dir, "lineitem").repartition("l_suppkey", "l_partkey").groupBy(*keys).agg(F.min("l_quantity").alias("q"), F.min("l_shipdate").alias("mtime"))
    rows = rows.selectExpr(
        *keys,
        "q",
        "concat('o', l_orderkey, '/p', l_partkey, '/s', l_suppkey, '/l', l_linenumber) AS path",
        "concat('cs-', year(mtime)) AS changeset_id",
        "l_suppkey AS st_dev",
        "l_partkey AS st_inode",
        "mtime",
    )
    rows = rows.withColumn("canon", F.min("path").over(Window.partitionBy("changeset_id", "st_dev", "st_inode")))
    rows = rows.selectExpr(
        "path",
        "changeset_id",
        "st_dev",
        "st_inode",
        "CAST(q * 1000 AS BIGINT) AS size",
        "mtime",
        "sha2(concat('content_for_inode_', l_partkey), 256) AS file_hash",
        "l_orderkey % 50 = 0 AS is_symlink",
        "IF(l_orderkey % 5 <> 0, mtime + INTERVAL 1 HOUR, NULL) AS upload_start_tm",
        "IF(l_orderkey % 5 <> 0 AND l_orderkey % 3 = 0, mtime + INTERVAL 1 HOUR + make_dt_interval(0, 0, l_linenumber), NULL) AS upload_finish_tm",
        "canon",
    )
    return rows.withColumn("file_id", F.expr("sha2(concat(canon, ':', file_hash), 256)")).withColumn("is_canonical", F.expr("path = canon")).drop("canon")


FILES = """
f0 AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, min(l_quantity) AS q, min(l_shipdate) AS mtime FROM lineitem GROUP BY ALL),
f1 AS (SELECT *, concat('o', l_orderkey, '/p', l_partkey, '/s', l_suppkey, '/l', l_linenumber) AS path, concat('cs-', year(mtime)) AS changeset_id,
   l_suppkey AS st_dev, l_partkey AS st_inode, (q * 1000)::BIGINT AS size, sha256(concat('content_for_inode_', l_partkey)) AS file_hash,
   l_orderkey % 50 = 0 AS is_symlink, CASE WHEN l_orderkey % 5 <> 0 THEN mtime + INTERVAL 1 HOUR END AS upload_start_tm,
   CASE WHEN l_orderkey % 5 <> 0 AND l_orderkey % 3 = 0 THEN mtime + INTERVAL 1 HOUR + to_minutes(l_linenumber) END AS upload_finish_tm FROM f0),
f2 AS (SELECT *, min(path) OVER (PARTITION BY changeset_id, st_dev, st_inode) AS canon FROM f1),
files AS (SELECT path, changeset_id, st_dev, st_inode, size, mtime, file_hash, is_symlink, upload_start_tm, upload_finish_tm,
   sha256(concat(canon, ':', file_hash)) AS file_id, path = canon AS is_canonical FROM f2)"""


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS operation_id",
        "sha2(concat('c', event_id % 500), 256) AS content_hash",
        "user_id % 10 AS installation_id",
        """CASE event_type WHEN 'signup' THEN 'upload_started' WHEN 'view' THEN 'upload_completed' WHEN 'click' THEN 'verification_success'
           WHEN 'error' THEN 'verification_failed' ELSE 'deletion_requested' END AS operation_type""",
        "value AS latency_ms",
        "ts AS operation_timestamp",
    )


OPERATIONS = """
operations AS (SELECT event_id AS operation_id, sha256(concat('c', event_id % 500)) AS content_hash, user_id % 10 AS installation_id,
   CASE event_type WHEN 'signup' THEN 'upload_started' WHEN 'view' THEN 'upload_completed' WHEN 'click' THEN 'verification_success'
   WHEN 'error' THEN 'verification_failed' ELSE 'deletion_requested' END AS operation_type, value AS latency_ms, ts AS operation_timestamp FROM events)"""


def disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names present in directories (``name``) and what the catalogue calls them (``db_name``), with known damage."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "concat(source, '/', lang) AS parent",
        "regexp_extract(text, '[^\\\\s]+', 0) AS name",
    )


DISK = r"""
disk AS (SELECT doc_id, concat(source, '/', lang) AS parent, regexp_extract(text, '[^\s]+') AS name FROM documents)"""


def storage(fs: DataFrame) -> DataFrame:
    """Blob ids physically present: some of the catalogue's are gone, some are nobody's."""
    own = fs.where(f"blobid IS NOT NULL AND blobid <> '{DIRECTORY}' AND doc_id % 11 <> 0").select("blobid")
    orphans = fs.where("doc_id % 19 = 0").selectExpr("sha2(concat('orphan', doc_id), 256) AS blobid")
    return own.union(orphans).distinct()


STORAGE = (
    FS
    + f""",
storage AS (SELECT blobid FROM fs WHERE blobid IS NOT NULL AND blobid <> '{DIRECTORY}' AND doc_id % 11 <> 0
   UNION SELECT sha256(concat('orphan', doc_id)) FROM fs WHERE doc_id % 19 = 0)"""
)


def bad_blobs(fs: DataFrame) -> DataFrame:
    return fs.where(f"main AND doc_id % 17 = 0 AND blobid IS NOT NULL AND blobid <> '{DIRECTORY}'").select("blobid").distinct()


BAD = FS + f", bad AS (SELECT DISTINCT blobid FROM fs WHERE main AND doc_id % 17 = 0 AND blobid IS NOT NULL AND blobid <> '{DIRECTORY}')"


def mtimes(fs: DataFrame) -> DataFrame:
    """A staged listing of modification times by path."""
    return fs.where("doc_id % 3 = 0").selectExpr("pth AS path", "CAST(1710000000.0 + doc_id AS DOUBLE) AS mtime")


MTIMES = QUEUE + ", temp_mtime AS (SELECT pth AS path, (1710000000.0 + doc_id)::DOUBLE AS mtime FROM fs WHERE doc_id % 3 = 0)"


def manifests(fs: DataFrame) -> tuple[DataFrame, DataFrame]:
    old = fs.where("doc_id % 7 <> 0").select("pth", "blobid", "size", "mtime")
    new = fs.where("doc_id % 5 <> 1").selectExpr("pth", "blobid", "IF(doc_id % 9 = 0, size + 1, size) AS size", "mtime")
    return old, new


MANIFESTS = (
    FS
    + """,
manifest_old AS (SELECT pth, blobid, size, mtime FROM fs WHERE doc_id % 7 <> 0),
manifest_new AS (SELECT pth, blobid, CASE WHEN doc_id % 9 = 0 THEN size + 1 ELSE size END AS size, mtime FROM fs WHERE doc_id % 5 <> 1)"""
)
