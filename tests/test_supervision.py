"""Batches by count or time and the watchdog: streams against replays in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tallystone.streaming import batches, watchdog


def replayed(rows, count, wait):
    """Batches of one lane whose rows come in order of time: ``(reason, ids)``, and what still waits."""
    out, held = [], []
    for ts, id_ in sorted(rows):
        if held and ts > held[0][0] + wait:
            out.append(("time", [x for _, x in held]))
            held = []
        held.append((ts, id_))
        if len(held) == count:
            out.append(("count", [x for _, x in held]))
            held = []
    return out, [x for _, x in held]


def drained(spark, stream, name, tmp_path, put, parts):
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        for part in parts:
            put(part)
            query.processAllAvailable()
        return spark.table(name).collect()
    finally:
        query.stop()


def test_a_batch_leaves_at_n_rows_or_after_t_seconds(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([], "id string, ms long").write.parquet(source)
    rows = spark.readStream.schema("id string, ms long").parquet(source).select("id", F.timestamp_millis("ms").alias("ts"))
    base = 1_700_000_000_000
    # seven at once, a gap that is noticed by the watermark alone, and rows after it
    first = [(f"a{i}", base + 500 * i) for i in range(7)]
    parts = [first, [("gap", base + 60_000)], [("late gap", base + 120_000), ("b1", base + 121_000)], [("c", base + 500_000)], [("d", base + 900_000)]]
    sent = [(ms, id_) for part in parts for id_, ms in part]
    found = drained(
        spark, batches.batched(rows, number=1, count=3, wait_ms=5000, late="1 second"), "leaving", tmp_path, lambda p: spark.createDataFrame(p, "id string, ms long").write.mode("append").parquet(source), parts
    )
    want, waiting = replayed(sent, 3, 5000)
    found = sorted(found, key=lambda r: r["batch"])
    assert [(r["reason"], r["ids"]) for r in found] == want[: len(found)] and [r["batch"] for r in found] == list(range(len(found)))
    assert want[0] == ("count", ["a0", "a1", "a2"]) and ("time", ["gap"]) in want and ("time", ["late gap", "b1"]) in want
    assert len(want) - len(found) <= 1 and waiting == ["d"]  # the last wait ends with the next row's watermark
    assert found[2]["due_ms"] == base + 3000 + 5000


def test_every_row_is_in_one_batch(spark, tmp_path):
    rng = random.Random(3)
    source, base = str(tmp_path / "in"), 1_700_000_000_000
    spark.createDataFrame([], "id string, ms long").write.parquet(source)
    rows = spark.readStream.schema("id string, ms long").parquet(source).select("id", F.timestamp_millis("ms").alias("ts"))
    clock, parts = base, []
    for k in range(3):
        part = []
        for i in range(60):
            clock += rng.choice([10, 100, 3000, 9000])
            part.append((f"{k}-{i}", clock))
        parts.append(part)
    parts.append([("end", clock + 10**6)])
    found = drained(spark, batches.batched(rows, number=4, count=5, wait_ms=5000, late="1 second"), "one", tmp_path, lambda p: spark.createDataFrame(p, "id string, ms long").write.mode("append").parquet(source), parts)
    sent = [(ms, id_) for part in parts for id_, ms in part]
    lane = {r["id"]: r["lane"] for r in spark.createDataFrame([(i,) for _, i in sent], "id string").select("id", batches.lanes(F.col("id"), 4).alias("lane")).collect()}
    for n in range(4):
        want, _ = replayed([x for x in sent if lane[x[1]] == n and x[1] != "end"], 5, 5000)
        rest = replayed([x for x in sent if lane[x[1]] == n and x[1] != "end"], 5, 5000)[1]
        want += [("time", rest)] if rest else []
        got = sorted((r for r in found if r["lane"] == n), key=lambda r: r["batch"])
        assert [(r["reason"], r["ids"]) for r in got] == want


def test_processing_time_lets_a_batch_go_by_the_clock(spark, tmp_path):
    import time

    source = str(tmp_path / "in")
    spark.createDataFrame([("x", 0), ("y", 10**9)], "id string, ms long").write.parquet(source)
    rows = spark.readStream.schema("id string, ms long").parquet(source).select("id", F.timestamp_millis("ms").alias("ts"))
    stream = batches.batched(rows, number=1, count=3, wait_ms=1500, clock="processingTime")
    query = stream.writeStream.format("memory").queryName("clock").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="500 milliseconds").start()
    try:
        deadline = time.time() + 60
        while not (found := spark.table("clock").collect()) and time.time() < deadline:
            time.sleep(0.5)
        assert [(r["reason"], sorted(r["ids"])) for r in found] == [("time", ["x", "y"])]
    finally:
        query.stop()


SAMPLES = "worker string, us long, id long, cpu double, status string, progress boolean"
START = 1_700_000_000_000_000


@pytest.fixture(scope="module")
def log():
    rng = random.Random(8)
    rows, n = [], 0
    for w in range(4):
        now = START
        for _ in range(150):
            now += rng.choice([20, 60, 60, 120, 400]) * 1_000_000
            n += 1
            cpu = None if rng.random() < 0.05 else rng.choice([0.0, 0.2, 0.5, 30.0]) if rng.random() < 0.9 else 99.0
            rows.append((f"w{w}", now, n, cpu, rng.choice(["running"] * 12 + ["sleeping", "zombie", "disk-sleep", None]), rng.random() < 0.08))
    return rows


def replay(rows, idle=1.0, stalled=15, cooldown=5):
    """The rules, written again over whole histories instead of folded state."""
    out = []
    for w in sorted({r[0] for r in rows}):
        own = sorted((r for r in rows if r[0] == w), key=lambda r: (r[1], r[2]))
        begin, restarts = 0, []
        for i, (_, ts, _, _, status, _) in enumerate(own):
            life = own[begin : i + 1]
            loads = [r[3] for r in life if r[3] is not None][-5:]
            progress = [r[1] for r in life if r[5]]
            quiet = ts - (progress[-1] if progress else life[0][1]) > stalled * 60_000_000
            gone = status in ("zombie", "disk-sleep", "dead")
            if not (gone or (len(loads) == 5 and sum(loads) < 5 * idle and quiet)):
                continue
            reason = "unresponsive" if gone else "stalled"
            if restarts and ts - restarts[-1] <= cooldown * 60_000_000:
                out.append((w, ts, "cooldown", reason, len(restarts)))
                continue
            restarts.append(ts)
            begin = i + 1
            out.append((w, ts, "restart", reason, len(restarts)))
    return out


def events(rows):
    return sorted((r["worker"], int(r["us"]), r["event"], r["reason"], r["restarts"]) for r in rows.select("worker", F.unix_micros("ts").alias("us"), "event", "reason", "restarts").collect())


def test_watchdog_over_a_log(spark, log):
    df = spark.createDataFrame([*log, (None, START, 0, 1.0, "zombie", True)], SAMPLES).withColumn("ts", F.timestamp_micros("us"))
    for limits in ({}, {"idle": 20.0, "stalled": 3, "cooldown": 30}):
        found = events(watchdog.supervise(df, watchdog.Limits(**limits)))
        assert found == sorted(replay(log, **limits))
    assert {e[2:4] for e in found} == {(a, b) for a in ("restart", "cooldown") for b in ("stalled", "unresponsive")}
    assert events(watchdog.supervise(df.limit(0))) == []


def test_watchdog_over_a_stream(spark, log, tmp_path):
    """Checks come out of order, in several micro-batches."""
    rng = random.Random(2)
    source = str(tmp_path / "in")
    spark.createDataFrame([], SAMPLES).write.parquet(source)
    stream = watchdog.supervise_stream(spark.readStream.schema(SAMPLES).parquet(source).withColumn("ts", F.timestamp_micros("us")), watchdog.Limits(20.0, 5, 3, 30), late="1 minute")
    ordered = sorted(log, key=lambda r: r[1])
    end = ("end", ordered[-1][1] + 3_600_000_000, 0, 50.0, "running", True)
    cut = len(ordered) // 2
    parts = [rng.sample(ordered[:cut], cut), rng.sample(ordered[cut:], len(ordered) - cut), [end]]
    name = "watched"
    drained(spark, stream, name, tmp_path, lambda p: spark.createDataFrame(p, SAMPLES).write.mode("append").parquet(source), parts)
    assert events(spark.table(name)) == sorted(replay(log, 20.0, 3, 30))
