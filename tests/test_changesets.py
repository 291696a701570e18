"""Content hashes of changesets: any ids, in order, and what the plan carries."""

import hashlib
import random

from pyspark.sql import functions as F

from tallystone import fixtures as fx
from tallystone.operators import library

SMALL = "/root/testdata/sf0.001"


def test_any_ids_in_the_order_of_strings(spark):
    pick = random.Random(5)
    whole = [hashlib.sha256(bytes([i])).hexdigest() for i in range(60)] + ["0" * 64, "f" * 64, "9" + "f" * 63, "a" + "0" * 63]
    odd = ["", "-", "~", ":", "ñ", "00", "ff", "A" * 64, "a:", "9g", *("".join(pick.choices("09:Aaf g-é", k=pick.randint(1, 5))) for _ in range(300))]
    odd += [w[: pick.randint(1, 64)] + end for w in whole for end in ("", "-", ":", "A", "z", "\n", "0" * 9)]
    ids = [*whole, *odd]
    rows = [("x", i) for i in ids] + [("y", i) for i in whole[:9] * 3] + [("z", None), (None, "b"), (None, "a"), ("y", None)]
    pick.shuffle(rows)
    found = {r["changeset_id"]: r for r in library.changesets(spark.createDataFrame(rows, "changeset_id string, file_id string").repartition(5)).collect()}
    expect = {"x": set(ids), "y": set(whole[:9]), "z": set(), None: {"a", "b"}}
    assert {k: r["content_hash"] for k, r in found.items()} == {k: hashlib.sha256(",".join(sorted(v)).encode()).hexdigest() for k, v in expect.items()}
    assert found["x"]["name"] == "changeset x" and found[None]["name"] is None and found["z"]["status"] == "pending"


def test_many_changesets_of_one_task(spark):
    rows = spark.range(30_000).select((F.col("id") % 12_000).cast("string").alias("changeset_id"), F.sha2(F.col("id").cast("string"), 256).alias("file_id"))
    found = {r["changeset_id"]: r["content_hash"] for r in library.changesets(rows.coalesce(1)).collect()}
    ids = lambda k: sorted(hashlib.sha256(str(i).encode()).hexdigest() for i in range(k, 30_000, 12_000))
    assert found == {str(k): hashlib.sha256(",".join(ids(k)).encode()).hexdigest() for k in range(12_000)}


def test_no_task_holds_a_changeset_and_files_are_dealt_out_once(spark):
    plan = library.changesets(fx.files(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and plan.count("Exchange hashpartitioning") == 2
