"""Scans of trees against os.walk: deep, wide, odd; rounds that deal folders out again; the data source."""

import os
import tracemalloc

import pytest
from pyspark.sql import functions as F

from tallystone import sources
from tallystone.sources import trees


def _walked(root):
    return sorted((os.path.join(at, f), os.lstat(os.path.join(at, f)).st_size) for at, _, files in os.walk(root) for f in files if not os.path.islink(os.path.join(at, f)))


def _found(rows):
    return sorted((r["path"], r["size"]) for r in rows.collect())


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    deep = root
    for k in range(300):  # a chain of folders
        deep = deep / "d"
        deep.mkdir()
        if k % 50 == 0:
            (deep / f"f{k}").write_bytes(b"x" * k)
    for k in range(120):  # many beside each other
        (root / "wide" / f"w{k}" / "in").mkdir(parents=True)
        (root / "wide" / f"w{k}" / "in" / "a b'é.txt").write_bytes(b"y" * k)
    (root / "flat").mkdir()
    for k in range(2000):
        (root / "flat" / f"{k}").touch()
    (root / "none").mkdir()
    (root / "link").symlink_to(root)
    (root / "broken").symlink_to(root / "nothing")
    return str(root)


def test_a_scan_finds_what_a_walk_finds(spark, tree):
    assert _found(trees.scan(spark, f"file://{tree}")) == _walked(tree)


def test_rounds_deal_folders_out_again(spark, tree, monkeypatch):
    """With little for each task, folders go through many rounds, and none is lost or listed twice."""
    rounds, written = [], trees.scratch.written
    monkeypatch.setattr(trees.scratch, "written", lambda rows, name: rounds.append(written(rows, name)) or rounds[-1])
    monkeypatch.setattr(trees, "STACK", 20)
    assert _found(trees.scan(spark, tree, budget=60, width=4)) == _walked(tree)
    assert len(rounds) > 3
    sizes = [r.count() for r in rounds]
    assert max(sizes[1:]) <= 4 * 60 + 2000 + 20


def test_a_chain_of_a_thousand_folders_is_one_round(tmp_path):
    here = os.getcwd()
    try:
        os.chdir(tmp_path)
        for _ in range(1000):
            os.mkdir("d")
            os.chdir("d")
        open("last", "wb").close()
    finally:
        os.chdir(here)
    found = list(trees.walk(None, iter([str(tmp_path)]), trees.BUDGET))
    assert [p for p, _, _ in found] == [str(tmp_path) + "/d" * 1000 + "/last"]


def test_a_large_folder_is_not_held(tmp_path):
    for k in range(30_000):
        (tmp_path / f"file-with-a-name-{k:08d}").touch()
    tracemalloc.start()
    try:
        assert sum(1 for _ in trees.walk(None, iter([str(tmp_path)]), trees.BUDGET)) == 30_000
        assert tracemalloc.get_traced_memory()[1] < 1_000_000
    finally:
        tracemalloc.stop()


def test_the_source_plans_partitions(spark, tree):
    trees.register(spark)
    rows = spark.read.format("tree").option("partitions", 8).load(tree)
    assert _found(rows) == _walked(tree)
    assert rows.rdd.getNumPartitions() == 8
    assert _found(spark.read.format("tree").option("planned", 1).load(f"file://{tree}")) == _walked(tree)
    assert spark.read.format("tree").load(f"{tree}/none").collect() == []
    with pytest.raises(Exception, match="root is missing"):
        spark.read.format("tree").load().collect()


def test_folders_beyond_the_stack_are_read_by_the_source(spark, tree, monkeypatch):
    monkeypatch.setattr(trees, "STACK", 2)
    reader = trees._TreeReader(tree, 3, 1)
    assert sorted((p, s) for part in reader.partitions() for p, s, _ in reader.read(part)) == _walked(tree)


def test_arrow_file_systems_list_the_same(tree):
    from pyarrow import fs

    local = fs.LocalFileSystem()
    found = {p: s for p, s, _ in trees.walk(local, iter([tree]), 1 << 62) if "/link" not in p and "/broken" not in p}
    assert sorted(found.items()) == _walked(tree)


def test_roots_that_are_none(spark, tree, tmp_path):
    for root in (f"{tree}/no-such", f"{tree}/flat/1", f"{tree}/none"):
        assert trees.scan(spark, root).collect() == [] and trees.scan(spark, root).columns == ["path", "size", "mtime"]
    got = sources.scan_tree(spark, f"{tree}/flat").agg(F.min("mtime").alias("m")).first()["m"]
    assert got is not None


def test_by_folder(spark, tree):
    found = {r["folder"]: (r["files"], r["bytes"]) for r in trees.by_folder(trees.scan(spark, tree), tree).collect()}
    assert found["flat"] == (2000, 0) and found["wide/w7/in"] == (1, 7) and found["/".join("d" * 51)] == (1, 50)
