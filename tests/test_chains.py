"""Changeset chains: folds, tampering, replay from checkpoints and pruning."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallystone.operators import chains

LOG = "dataset string, seq int, pth string, action string, blobid string"


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(6)
    rows = []
    for dataset in ("a", "b", None):
        for seq in range(40):
            for p in rng.sample(range(60), 12):
                remove = rng.random() < 0.3
                rows.append((dataset or "c", seq, f"p{p}", "REMOVE" if remove else "WRITE", None if remove else f"blob{rng.randint(0, 999)}"))
    return spark.createDataFrame(rows, LOG).cache(), rows


def replayed(rows, upto):
    state = {}
    for dataset, seq, pth, action, blobid in sorted(rows, key=lambda r: r[1]):
        if seq < upto.get(dataset, 10**9):
            if action == "WRITE":
                state[dataset, pth] = blobid
            else:
                state.pop((dataset, pth), None)
    return state


def test_manifests_ignore_order_and_keep_lines_apart(spark, log):
    actions, rows = log
    one = {(r["dataset"], r["seq"]): r["manifest"] for r in chains.manifests(actions).collect()}
    shuffled = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), LOG)
    assert one == {(r["dataset"], r["seq"]): r["manifest"] for r in chains.manifests(shuffled).collect()}
    two = spark.createDataFrame([("a", 0, "x:1", "WRITE", "b"), ("b", 0, "x", "1:WRITE", "b"), ("c", 0, None, "WRITE", None)], LOG)
    assert len({r["manifest"] for r in chains.manifests(two, 1).collect()}) == 3


def test_chain_is_a_fold(spark, log):
    actions, _ = log
    made = chains.manifests(actions)
    found = chains.extend(made).collect()
    by = {(r["dataset"], r["seq"]): r for r in found}
    for dataset in "abc":
        previous = None
        for seq in range(40):
            r = by[dataset, seq]
            assert r["previous_id"] == previous and r["id"] == hashlib.sha256((r["manifest"] + (previous or "")).encode()).hexdigest()
            previous = r["id"]
    heads = spark.createDataFrame([(d, by[d, 24]["id"]) for d in "abc"], "dataset string, id string")
    late = {(r["dataset"], r["seq"]): r for r in chains.extend(made.where("seq > 24"), heads).collect()}
    assert late == {k: r for k, r in by.items() if k[1] > 24}
    assert chains.extend(made.limit(0)).collect() == []


def test_damage_is_found(spark, log):
    actions, rows = log
    whole = chains.extend(chains.manifests(actions)).cache()
    assert {r["status"] for r in chains.verify(whole, actions).collect()} == {"ok"}

    def broken(chain, own=actions):
        return {(r["dataset"], r["seq"], r["status"]) for r in chains.verify(chain, own).where("status <> 'ok'").collect()}

    assert broken(whole.where("NOT (dataset = 'a' AND seq = 5)")) == {("a", 6, "missing")}
    assert broken(whole.where("NOT (dataset = 'a' AND seq = 0)")) == {("a", 1, "missing")}
    assert broken(whole.where("NOT (dataset = 'a' AND seq = 39)")) == set()
    changed = actions.withColumn("blobid", F.expr("IF(dataset = 'b' AND seq = 7 AND action = 'WRITE', 'evil', blobid)"))
    assert broken(whole, changed) == {("b", 7, "manifest")}
    assert broken(whole, actions.where("NOT (dataset = 'b' AND seq = 8)")) == {("b", 8, "manifest")}
    # manifest and actions changed together: the id tells
    forged = chains.manifests(changed).select("dataset", "seq", F.col("manifest").alias("m"))
    assert broken(whole.join(forged, ["dataset", "seq"]).withColumn("manifest", F.col("m")).drop("m"), changed) == {("b", 7, "id")}
    again = whole.withColumn("previous_id", F.expr("IF(dataset = 'c' AND seq = 3, NULL, previous_id)"))
    again = again.withColumn("id", F.expr("IF(dataset = 'c' AND seq = 3, sha2(manifest, 256), id)"))
    assert broken(again) == {("c", 3, "genesis"), ("c", 4, "missing")}
    fork = whole.unionByName(whole.where("dataset = 'a' AND seq = 9").withColumn("seq", F.lit(100)))
    assert ("a", 9, "fork") in broken(fork)


def test_replay_from_a_checkpoint(spark, log):
    actions, rows = log
    marks = chains.checkpoint(actions, F.lit(11)).unionByName(chains.checkpoint(actions, F.lit(22)).where("dataset <> 'b'"))
    found = {(r["dataset"], r["pth"]): r["blobid"] for r in chains.restore(actions, marks).collect()}
    assert found == replayed(rows, {})
    links = spark.createDataFrame([("a", 5, "id"), ("a", 30, "missing"), ("b", 9, "id"), ("c", 23, "manifest")], "dataset string, seq int, status string")
    found = {(r["dataset"], r["pth"]): r["blobid"] for r in chains.restore(actions, marks, links).collect()}
    assert found == replayed(rows, {"a": 30, "c": 23})
    none = {(r["dataset"], r["pth"]): r["blobid"] for r in chains.restore(actions, marks.limit(0), links).collect()}
    assert none == replayed(rows, {"a": 5, "b": 9, "c": 23})


def test_replay_reads_only_what_follows(spark, log, tmp_path):
    actions, rows = log
    path = str(tmp_path / "log")
    chains.write_log(actions.where("seq < 20"), path)
    chains.write_log(actions.where("seq >= 20"), path)
    stored = chains.read_log(spark, path)
    marks = chains.checkpoint(actions, F.lit(33))
    state = chains.restore(stored, marks)
    assert {(r["dataset"], r["pth"]): r["blobid"] for r in state.collect()} == replayed(rows, {})
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    # the folders of changesets before the checkpoint may be gone
    for folder in (tmp_path / "log").glob("dataset=*/block=[01]"):
        for f in folder.iterdir():
            f.unlink()
    left = chains.restore(chains.read_log(spark, path), marks)
    assert {(r["dataset"], r["pth"]): r["blobid"] for r in left.collect()} == replayed(rows, {})
