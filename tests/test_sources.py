"""Readers and writers over files that the tests write; streams; spellings that queries don't reach."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tallystone import sources, streaming
from tallystone.operators import blobs, catalogue, metrics, paths, queue, reconcile, spelling

CONTENTS = {"hello.txt": b"Hello, World!" * 100, "deep/round.bin": b"Round trip test content!" * 1000, "empty": b""}


@pytest.fixture
def tree(tmp_path):
    for name, content in CONTENTS.items():
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return tmp_path


def test_scan_and_stat(spark, tree):
    found = sources.scan_tree(spark, f"file://{tree}/tree")
    assert sorted(r["size"] for r in found.collect()) == sorted(map(len, CONTENTS.values()))
    stats = {os.path.basename(r["path"]): r for r in sources.with_inodes(found.unionByName(found.limit(1).withColumn("path", F.lit("file:/no/such")))).collect()}
    own = os.stat(tree / "tree" / "hello.txt")
    assert len(stats) == 3 and (stats["hello.txt"]["st_inode"], stats["hello.txt"]["mtime"]) == (own.st_ino, own.st_mtime)


def test_synthetic_catalogue(spark):
    rows = sources.synthetic_catalogue(spark, 1000, 0.3).collect()
    assert len({r["path"] for r in rows}) == 1000 and len({r["st_inode"] for r in rows}) == 700


def test_listings(spark, tmp_path):
    (tmp_path / "nul").write_bytes(b"# comment\0/mnt/snapshot/a b\0c\nd\0\0")
    assert sorted(r["file_path"] for r in sources.null_delimited(spark, str(tmp_path / "nul"), "ds").collect()) == ["a b", "c\nd"]
    (tmp_path / "times").write_text('1700000000.5\x1ca "quoted" path\n')
    assert [tuple(r) for r in sources.mtime_listing(spark, str(tmp_path / "times")).collect()] == [(1700000000.5, 'a "quoted" path')]
    (tmp_path / "bad").write_text("# head\n-----\nGZIP | aa | 2025 | p\nGZIP | aa | 2025 | q\nother\nX | bb | y | z\n")
    assert sorted(r[0] for r in sources.bad_blob_list(spark, str(tmp_path / "bad")).collect()) == ["aa", "bb"]
    (tmp_path / "paths").write_text("a/b\n\n c \n")
    assert sorted(r[0] for r in sources.path_list(spark, str(tmp_path / "paths")).collect()) == ["a/b", "c"]


def test_blobs_to_a_store_and_back(spark, tree):
    files = sources.read_contents(sources.scan_tree(spark, f"file://{tree}/tree"), f"file://{tree}/tree")
    rows = files.select(F.regexp_extract("path", "tree/(.*)$", 1).alias("path"), "content", F.lit(1.7e9).alias("mtime"))
    made = blobs.create(rows)
    assert sources.write_blobs(made, str(tree / "store")).count() == 3
    stored = {r["blobid"] for r in sources.stored_blobs(spark, f"file://{tree}/store").collect()}
    assert stored == {hashlib.sha256(c).hexdigest() for c in CONTENTS.values()}
    restored = blobs.restore(made.select("path", "blobid", "document")).withColumnRenamed("path", "pth").withColumn("mtime", F.lit(1.6e9))
    assert restored.where("NOT verified").count() == 0
    assert sources.restore_files(restored, str(tree / "out")).count() == 3
    for name, content in CONTENTS.items():
        assert (tree / "out" / name).read_bytes() == content and os.stat(tree / "out" / name).st_mtime == 1.6e9
    with pytest.raises(Exception, match="leads out"):
        sources.restore_files(restored.withColumn("pth", F.lit("../x")), str(tree / "out")).count()


def test_sinks(spark, tmp_path):
    ids = spark.createDataFrame([("b",), ("a",), ("b",)], "blobid string")
    sources.write_ids(ids, str(tmp_path / "ids"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "ids")).collect()] == ["a", "b"] and sources.id_list(spark, str(tmp_path / "ids")).count() == 2
    sources.write_metrics(ids, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["blobid"]
    for _ in range(2):
        sources.append_log(ids, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 6
    one = spark.createDataFrame([("p", "d1"), ("q", "d2")], "file_path string, dataset string")
    sources.write_dataset(one, str(tmp_path / "set"))
    sources.write_dataset(one.where("dataset = 'd1'").withColumn("file_path", F.lit("r")), str(tmp_path / "set"))
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "set")).collect()) == [("q", "d2"), ("r", "d1")]
    sources.bulk_insert(str(tmp_path / "files"), ids, "cs-1")
    assert spark.read.parquet(str(tmp_path / "files")).where("changeset_id = 'cs-1'").count() == 3
    log = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-05 00:00:00' AS operation_timestamp UNION ALL SELECT TIMESTAMP_NTZ'2024-02-05 00:00:00'")
    sources.write_monthly(log, str(tmp_path / "ops"))
    assert sorted(x for x in os.listdir(tmp_path / "ops") if x.startswith("month")) == ["month=2024-01", "month=2024-02"]


def test_catalogue_metadata(spark):
    spark.range(1).createOrReplaceTempView("some_ids")
    assert sources.table_exists(spark, "some_ids") and not sources.table_exists(spark, "no_ids")
    assert [tuple(r)[:2] for r in sources.column_types(spark, "some_ids").collect()] == [("id", "bigint")]
    listing = spark.createDataFrame([("t/back-1/x",), ("t/back-1/y",), ("t/none",)], "pth string")
    assert [r[0] for r in sources.backup_folders(listing).collect()] == ["t/back-1"]


def test_legacy_documents_and_file_types(spark):
    import base64
    import json

    import pyarrow as pa

    whole = base64.b64encode(pa.Codec("lz4").compress(b"A" * 5000, asbytes=True)).decode()
    meta = {"size": 5000}
    forms = [{"content": whole, "metadata": meta}, {"content": {"chunks": [whole[:400], whole[400:]]}, "metadata": meta}, {"content": {"frames": blobs.frames(b"A" * 5000, 1000)}, "metadata": meta}]
    forms[1]["content"]["chunks"] = [base64.b64encode(base64.b64decode(whole)[:10]).decode(), base64.b64encode(base64.b64decode(whole)[10:]).decode()]
    assert [blobs.decode(json.dumps(f), 1000) for f in forms] == [b"A" * 5000] * 3
    rows = spark.createDataFrame([(b"\x89PNG\r\n\x1a\n..", "image/png"), (b"%PDF-1", "application/pdf"), (b"plain text", "text/plain"), (b"", "inode/x-empty"), (b"\x00\x01", "application/octet-stream"), (b"\x1f\x8b\x08", "application/gzip")], "c binary, kind string")
    assert rows.where(blobs.filetype(F.col("c")) != F.col("kind")).count() == 0
    heads = spark.createDataFrame([(b"{", b'"metadata"'), (b"{", b"cut"), (b"", b""), (None, None)], "h binary, t binary")
    assert [r[0] for r in heads.select(blobs.format_class(F.col("h"), F.col("t"))).collect()] == ["JSON", "BINARY", "ERROR", "MISSING"]


def test_stale_claims_time_out(spark, tmp_path):
    import datetime

    at = lambda m: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)
    rows = [("a", "claim", "w1", at(0)), ("b", "claim", "w1", at(0)), ("b", "done", "w1", at(5)), ("c", "claim", "w2", at(0)), ("c", "claim", "w3", at(20)), ("d", "claim", "w4", at(55)), ("z", "done", "w", at(60))]
    schema = "pth string, action string, worker string, ts timestamp"
    (tmp_path / "in").mkdir()
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for i, part in enumerate((rows, [("z", "done", "w", at(200))], [("z", "done", "w", at(201))])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if i == 0:
            query = streaming.stale_claims(events).writeStream.format("memory").queryName("stale").option("checkpointLocation", str(tmp_path / "cp")).start()
        query.processAllAvailable()
    query.stop()
    found = sorted((r["pth"], r["claimed_by"], r["claimed_at"]) for r in spark.table("stale").collect())
    assert [f[:2] for f in found] == [("a", "w1"), ("c", "w3"), ("d", "w4")] and found[1][2] == at(20)


def test_windowed_rates(spark):
    rows = spark.createDataFrame([("2024-01-01 00:01:00", "x", 1.0), ("2024-01-01 00:02:00", "x", 2.0), ("2024-01-01 00:11:00", "x", 4.0)], "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted((r["n"], r["total"]) for r in streaming.rates(rows).collect()) == [(1, 4.0), (2, 3.0)]


def test_words_and_variants(spark):
    row = spark.createDataFrame([("Jose Martinsburg mas_Que MARIA's, anos", "Dogs dont Franks a", "x–y")], "a string, b string, c string")
    got = row.select(spelling.replace_words(F.col("a"), spelling.spanish()), spelling.apostrophe_variants(F.col("b")), paths.variants(F.col("c"))).first()
    assert got[0] == "José Martinsburg mas_Que MARÍA's, años"
    assert got[1] == ["Dogs dont Franks a", "Dogs don't Franks a", "Dog's dont Frank's a", "Dog's don't Frank's a"] and "x-y" in got[2]
    assert row.select(paths.fix_backslashes(F.lit("a\\b"))).first()[0] == "ab"
    diff = row.select(spelling.differing_code_points(F.lit("ab"), F.lit("aé!"))).first()[0]
    assert [tuple(x) for x in diff] == [(1, "U+0062", "U+00E9"), (2, None, "U+0021")]


def test_similar_names_and_collisions(spark):
    disk = spark.createDataFrame([("p", "holiday photo.jpg"), ("p", "other")], "parent string, name string")
    wanted = spark.createDataFrame([("p", "holiday phoro.jpg"), ("p", "zzz"), ("q", "other")], "parent string, db_name string")
    assert [(r["db_name"], r["name"]) for r in paths.similar(wanted, disk).collect()] == [("holiday phoro.jpg", "holiday photo.jpg")]
    mapping = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "pth string, repaired string")
    assert [tuple(r) for r in paths.collisions(mapping).collect()] == [("x", 2)]


def test_rename_leaves_taken_names(spark):
    fs = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "pth string, cantfind boolean")
    mapping = spark.createDataFrame([("a", "c"), ("b", "d"), ("z", "e"), ("c", None)], "pth string, repaired string")
    change, bad = catalogue.rename(fs, mapping)
    assert sorted(map(tuple, change.state.collect())) == [("a", True), ("c", False), ("d", False)] and [tuple(r) for r in bad.collect()] == [("a", "c")]


def test_chain_names_its_predecessors(spark):
    found = reconcile.chain([("one", "m1"), ("two", "m2")])
    first = hashlib.sha256(b"m1").hexdigest()
    assert found == [("one", first, None), ("two", hashlib.sha256(b"m2" + first.encode()).hexdigest(), first)]
    rows = spark.createDataFrame([(i, p) for _, i, p in [*found, ("x", "id", "gone")]], "id string, previous_id string")
    assert [r["id"] for r in reconcile.broken_links(rows).collect()] == ["id"]


def test_small_functions(spark):
    row = spark.range(1)
    assert row.select(metrics.eta_seconds(F.lit(10.0), F.lit(4.0)), metrics.effect(F.lit(0.8), F.lit(1.0)), metrics.backoff(F.lit(3)), metrics.backoff(F.lit(20))).first()[:] == (2.5, "much worse", 8.0, 300.0)
    evolved = catalogue.evolve(spark.range(2), {"id": "string", "flag": "boolean"})
    assert evolved.dtypes == [("id", "string"), ("flag", "boolean")]
    many = spark.range(1000).selectExpr("CAST(id AS STRING) AS pth", "CAST(NULL AS TIMESTAMP_NTZ) AS claimed_at")
    part = queue.sample_unclaimed(many, 0.1, 3)
    assert 50 < part.count() < 150 and part.exceptAll(queue.sample_unclaimed(many, 0.1, 3)).isEmpty()
    assert queue.claim_random(many, 1).first() == queue.claim_random(many, 1).first() != queue.claim_random(many, 2).first()
    estimate = metrics.extrapolate(many, F.col("pth").cast("int") < 500, "pth", 200).first()
    assert estimate["total"] == 1000 and 380 < estimate["estimate"] < 620


def test_walk_equals_a_search_of_the_tree(spark):
    import unicodedata

    plain = lambda x: "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn")
    tree = [("", "é"), ("é", "Ñ"), ("é", "x"), ("é/Ñ", "ü.txt"), ("é/x", "a’b")]
    wanted = ["e/N/u.txt", "é/Ñ/ü.txt", "e/x/a'b", "e/missing/ü.txt", "é/x"]
    disk = spark.createDataFrame(tree, "parent string, name string")
    found = {r["pth"]: r["repaired"] for r in paths.walk(spark.createDataFrame([(w,) for w in wanted], "pth string"), disk, 3).collect()}
    for w in wanted:
        at = ""
        for part in w.split("/"):
            fits = [n for p, n in tree if p == at and plain(n).replace("’", "'") == plain(part)]
            at = f"{at}/{fits[0]}".strip("/") if fits else None
            if at is None:
                break
        assert found[w] == at
