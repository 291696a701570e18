"""Committed tables: races, dead writers, versions, buckets."""

import threading

import pytest
from pyspark.sql import functions as F

from tallystone import fixtures as fx
from tallystone.operators import queue
from tallystone.sources.snapshots import Conflict, Rows, SnapshotTable

SMALL = "/root/testdata/sf0.001"


def table_of(spark, root, n=100, buckets=8):
    rows = spark.range(n).selectExpr("concat('k', id) AS k", "id AS v", "CAST(NULL AS STRING) AS note")
    return SnapshotTable.create(rows, str(root / "t"), "k", buckets)


def content(df):
    return {r["k"]: r["v"] for r in df.collect()}


def test_versions(spark, tmp_path):
    table = table_of(spark, tmp_path)
    first = content(table.read())
    assert first == {f"k{i}": i for i in range(100)}
    put = spark.createDataFrame([("k5", 500, "x"), ("new", 7, None)], "k string, v long, note string")
    assert table.transact(lambda df: Rows(put, spark.createDataFrame([("k6",), ("never",)], "k string"))) == 1
    second = {**first, "k5": 500, "new": 7}
    del second["k6"]
    assert content(table.read()) == second and content(table.read(0)) == first
    assert content(table.read_keys(["k5", "k6", "k7"])) == {"k5": 500, "k7": 7}
    old, new = table.manifest(0)["folders"], table.manifest(1)["folders"]
    assert {b for b in new if new[b] != old.get(b)} <= set(map(str, table.manifest(1)["touched"]))
    assert any(new[b] == old[b] for b in new)  # buckets that weren't touched weren't written
    assert table.transact(lambda df: None) is None and table.transact(lambda df: Rows(put.limit(0))) is None and table.latest() == 1
    assert [(h["version"], h["operation"]) for h in SnapshotTable(spark, table.root).history()] == [(0, "create"), (1, "change")]
    with pytest.raises(Conflict):
        table_of(spark, tmp_path)
    for bad in ([("a", 1, None), ("a", 2, None)], [(None, 1, None)]):
        with pytest.raises(ValueError, match="once"):
            table.transact(lambda df, bad=bad: Rows(spark.createDataFrame(bad, "k string, v long, note string")))
    everything = table.transact(lambda df: Rows(drop=df))
    assert table.read().count() == 0 and content(table.read(everything - 1)) == second


def test_of_two_racing_claims_one_is_made_again(spark, tmp_path):
    table = table_of(spark, tmp_path)
    calls = []

    def claim(df):
        calls.append(df)
        if len(calls) == 1:  # another driver commits between this one's read and its put
            other = SnapshotTable(spark, table.root)
            assert other.transact(lambda d: Rows(d.where("note IS NULL").orderBy("v").limit(10).withColumn("note", F.lit("b")))) == 1
        return Rows(df.where("note IS NULL").orderBy("v").limit(10).withColumn("note", F.lit("a")))

    assert table.transact(claim) == 2 and len(calls) == 2
    found = {r["note"]: r["vs"] for r in table.read().where("note IS NOT NULL").groupBy("note").agg(F.sort_array(F.collect_list("v")).alias("vs")).collect()}
    assert found == {"b": list(range(10)), "a": list(range(10, 20))}


def test_changes_of_other_buckets_go_on_top(spark, tmp_path):
    table = table_of(spark, tmp_path, buckets=16)
    where = {r["k"]: r["b"] for r in table.read().select("k", F.pmod(F.xxhash64("k"), F.lit(16)).alias("b")).collect()}
    mine = "k0"
    far = next(k for k, b in where.items() if b != where[mine])
    near = next(k for k, b in where.items() if b == where[mine] and k != mine)

    for other, calls_wanted in ((far, 1), (near, 2)):
        calls = []

        def change(df, calls=calls, other=other):
            calls.append(1)
            if len(calls) == 1:
                SnapshotTable(spark, table.root).transact(lambda d: Rows(d.where(F.col("k") == other).withColumn("v", F.lit(-1).cast("long"))))
            return Rows(df.where(F.col("k") == mine).withColumn("v", F.col("v") + 1000))

        before = content(table.read())
        table.transact(change, reads_all=False)
        assert len(calls) == calls_wanted
        assert content(table.read()) == {**before, other: -1, mine: before[mine] + 1000}


def test_a_dead_writer_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    before = content(table.read())
    put = spark.createDataFrame([("k5", 500, "x")], "k string, v long, note string")

    def dies(meta):
        raise KeyboardInterrupt

    monkeypatch.setattr(table, "_put", dies)
    with pytest.raises(KeyboardInterrupt):
        table.transact(lambda df: Rows(put))
    other = SnapshotTable(spark, table.root)
    assert content(other.read()) == before and other.latest() == 0
    assert other.transact(lambda df: Rows(put)) == 1 and content(other.read()) == {**before, "k5": 500}
    assert other.vacuum(keep=2) == []  # too young
    assert len(other.vacuum(keep=2, older_than_s=0)) == 1
    assert content(other.read()) == {**before, "k5": 500} and content(other.read(0)) == before
    other.vacuum(keep=1, older_than_s=0)
    assert content(other.read()) == {**before, "k5": 500}
    with pytest.raises(Exception, match="versions"):
        other.read(0)


def test_threads_that_claim_at_once_share_the_queue(spark, tmp_path):
    fs = fx.catalogue(spark, SMALL).cache()
    work = fx.work_queue(fs)
    table = SnapshotTable.create(work, str(tmp_path / "queue"), "pth")
    now, done = fx.at(fx.AS_OF), []

    def run(name):
        done.append((name, queue.commit_claim(SnapshotTable(spark, table.root), fs, name, now, 7)))

    threads = [threading.Thread(target=run, args=(f"driver{i}",)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(v for _, v in done) == [1, 2, 3]
    claimed = table.read().where("startswith(claimed_by, 'driver')")
    assert {r["claimed_by"]: r["n"] for r in claimed.groupBy("claimed_by").agg(F.count("*").alias("n")).collect()} == {f"driver{i}": 7 for i in range(3)}
    free = work.where("claimed_at IS NULL").join(fs.select("pth", "size"), "pth").orderBy("size", "pth").limit(21)
    assert {r["pth"] for r in claimed.collect()} == {r["pth"] for r in free.collect()}
    version = queue.commit_finished(table, claimed.where("claimed_by = 'driver0'"))
    assert table.read(version).count() == work.count() - 7


def test_one_file_at_a_time_is_marked_as_processed(spark, tmp_path):
    fs = fx.catalogue(spark, SMALL)
    table = SnapshotTable.create(fs, str(tmp_path / "fs"), "pth", 4)
    before = {r["pth"] for r in fs.where("processing_started IS NOT NULL").collect()}
    for seed in (1, 2):
        assert queue.commit_processing(table, seed, fx.at(fx.AS_OF)) is not None
    after = {r["pth"] for r in table.read().where("processing_started IS NOT NULL").collect()}
    assert len(after - before) == 2 and before <= after
    none = SnapshotTable.create(fs.where("NOT main"), str(tmp_path / "none"), "pth", 4)
    assert queue.commit_processing(none, 1, fx.at(fx.AS_OF)) is None
