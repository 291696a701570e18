import pytest

from tallystone.operators import blobs, catalogue, queue, reconcile
from tallystone import fixtures as fx

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size", [0, 1, 1300, 100, 101, 250])
def test_round_trip(size):
    content = bytes(i % 251 for i in range(size))
    document = blobs.encode(content, 1.0, "text/plain", chunk=100)
    assert blobs.decode(document, chunk=100) == content
    assert len(blobs.frames(content, 100)) == -(-size // 100)


def test_restore_verifies_against_the_name(spark):
    rows = spark.createDataFrame([("a", bytearray(b"x" * 24000), 1.0), ("b", bytearray(b""), 2.0)], "path string, content binary, mtime double")
    found = {r["path"]: r for r in blobs.restore(blobs.create(rows)).collect()}
    assert found["a"]["verified"] and bytes(found["a"]["content"]) == b"x" * 24000
    assert found["b"]["verified"] and bytes(found["b"]["content"]) == b""
    broken = spark.createDataFrame([("0" * 64, "no json")], "blobid string, document string")
    assert blobs.restore(broken).first()["verified"] is False


def test_propagation_is_idempotent(spark):
    fs = fx.catalogue(spark, SMALL)
    now = fx.at(fx.AS_OF)
    once = catalogue.propagate_all(fs, now).state
    assert catalogue.propagate_all(once, now).delta.count() == 0
    assert once.count() == fs.count()


def test_queue_invariants(spark):
    fs = fx.catalogue(spark, SMALL)
    q, now = fx.work_queue(fs), fx.at(fx.AS_OF)
    added = queue.add_eligible(q, fs, now).state
    assert added.select("pth").distinct().count() == added.count()
    assert queue.add_eligible(added, fs, now).delta.count() == 0
    one = queue.claim(q, fs, "a", now, 1000, workers=2, number=0).delta
    two = queue.claim(q, fs, "b", now, 1000, workers=2, number=1).delta
    assert one.join(two, "pth").count() == 0
    assert queue.reset_stale(q, now).delta.where("claimed_at IS NULL").count() == 0


def test_replay_equals_the_new_manifest(spark):
    from pyspark.sql import functions as F

    old, new = fx.manifests(fx.catalogue(spark, SMALL))
    diff = reconcile.manifest_diff(old, new)
    assert diff.where("action = 'REMOVE'").join(new, "pth").count() == 0
    log = old.select(F.lit(0).alias("seq"), "pth", F.lit("WRITE").alias("action"), "blobid").unionByName(diff.select(F.lit(1).alias("seq"), "pth", "action", "blobid"))
    assert reconcile.replay(log).count() == new.count()
