"""Rates, percentiles, trends and diagnoses over an operations log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.operators import ranks


def window_throughput(rows: DataFrame, time: str, start: Column, stop: Column) -> DataFrame:
    """Count within a closed window, and per hour of the window."""
    hours = F.timestamp_diff("SECOND", start, stop) / 3600.0
    return rows.where(F.col(time).between(start, stop)).agg(F.count("*").alias("n")).select("n", F.round(F.try_divide(F.col("n"), hours), 6).alias("per_hour"))


def recent(rows: DataFrame, time: str, as_of: Column, minutes: int) -> DataFrame:
    newer = rows.where(F.col(time) > as_of - F.make_dt_interval(mins=F.lit(minutes)))
    return newer.agg(F.count("*").alias("n"), F.min(time).alias("oldest"), F.max(time).alias("newest"))


def percentiles(rows: DataFrame, by: str, value: str) -> DataFrame:
    """By linear interpolation."""
    found = ranks.quantiles(rows, by, value, {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return found.select(by, *(F.round(p, 6).alias(p) for p in ("p50", "p95", "p99")), "n")


def nearest_rank(rows: DataFrame, by: str, value: str) -> DataFrame:
    """The element at floor(n/2), and at floor(0.95 n), or the largest if there are up to 20; counted from 0."""
    n = F.col("total")
    high = F.when(n > 20, F.floor(n * 0.95)).otherwise(n - 1)
    return ranks.at_places(rows, by, value, {"median": F.floor(n / 2), "p95": high})


def thrashing(rows: DataFrame, by: str, value: str) -> DataFrame:
    """p95 / p50 above 5, severe above 10, from 20 samples on."""
    found = ranks.quantiles(rows, by, value, {"a": 0.5, "b": 0.95})
    ratio = F.round(F.try_divide(F.col("b"), F.col("a")), 6)
    state = F.when(F.col("n") < 20, "unknown").when(ratio > 10, "severe").when(ratio > 5, "thrashing").otherwise("normal")
    return found.select(by, ratio.alias("ratio"), state.alias("state"))


def latest(rows: DataFrame, by: str, time: str, tie: str, n: int) -> DataFrame:
    """The last ``n`` rows of each group: a ring buffer.

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` rows (1000) Spark keeps only ``n`` of each group and task
    before it shuffles, so a group of any size sends a few.
    """
    w = Window.partitionBy(by).orderBy(F.desc(time), F.desc(tie))
    return rows.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def idle_workers(samples: DataFrame, threshold: float = 40.0) -> DataFrame:
    """``samples(worker, ts, id, cpu)``: the mean of each worker's last five samples; idle if below; null before five."""
    five = latest(samples.select("worker", "ts", "id", "cpu"), "worker", "ts", "id", 5)
    last = five.groupBy("worker").agg(F.avg("cpu").alias("mean"), F.count("*").alias("n"))
    mean = F.when(F.col("n") == 5, F.round("mean", 6))
    return last.select("worker", mean.alias("mean_cpu"), (mean < threshold).alias("idle"))


def hung_workers(samples: DataFrame, as_of: Column, stalled_minutes: int = 15, threshold: float = 40.0) -> DataFrame:
    """Hung: idle and without progress for so long."""
    last = samples.where("progress").groupBy("worker").agg(F.max("ts").alias("last_progress"))
    stalled = F.col("last_progress").isNull() | (F.col("last_progress") < as_of - F.make_dt_interval(mins=F.lit(stalled_minutes)))
    return idle_workers(samples, threshold).join(last, "worker", "left").select("worker", "idle", stalled.alias("stalled"), F.coalesce(F.col("idle") & stalled, F.lit(False)).alias("hung"))


def dead_workers(tracked: DataFrame, current: DataFrame) -> DataFrame:
    return tracked.select("worker").distinct().join(current.select("worker"), "worker", "left_anti")


def trend(points: DataFrame) -> DataFrame:
    """``points(series, ts, rate)``: the last against the one two before: up or down by more than a tenth."""
    w = Window.partitionBy("series").orderBy("ts")
    before = F.lag("rate", 2).over(w)
    label = F.when(before.isNull(), "unknown").when(F.col("rate") > before * 1.1, "improving").when(F.col("rate") < before * 0.9, "degrading").otherwise("stable")
    return points.select("series", "ts", "rate", label.alias("trend"))


def rates(counters: DataFrame) -> DataFrame:
    """``counters(series, ts, total)``: change per second since the row before."""
    w = Window.partitionBy("series").orderBy("ts")
    seconds = F.timestamp_diff("SECOND", F.lag("ts").over(w), F.col("ts"))
    return counters.select("series", "ts", F.round(F.try_divide((F.col("total") - F.lag("total").over(w)).cast("double"), seconds), 6).alias("per_second"))


def diagnosis(shm_mb: Column, hash_queue: Column, compress_queue: Column, cpu: Column, disk_busy: Column) -> Column:
    """The order of the arms is the meaning."""
    return (
        F.when(shm_mb > 3.5, "shared memory pressure")
        .when(compress_queue > 80, "compression bottleneck")
        .when((hash_queue > 80) & (disk_busy > 80), "disk bottleneck")
        .when(cpu > 90, "cpu bottleneck")
        .when((hash_queue == 0) & (compress_queue == 0), "idle")
        .otherwise("balanced")
    )


def stage_averages(rows: DataFrame, stages: list[str]) -> DataFrame:
    """Mean of each stage's milliseconds, files per second, and the slowest stage."""
    means = rows.agg(*(F.round(F.avg(s), 6).alias(s) for s in stages), F.count("*").alias("files"))
    total = sum((F.col(s) for s in stages[1:]), F.col(stages[0]))
    slowest = F.array_max(F.array(*(F.struct(F.col(s).alias("ms"), F.lit(s).alias("stage")) for s in stages)))["stage"]
    return means.withColumn("files_per_second", F.round(F.try_divide(F.lit(1000.0), total), 6)).withColumn("bottleneck", slowest)


def success_summary(rows: DataFrame, by: str) -> DataFrame:
    good = F.col("ok")
    return rows.groupBy(by).agg(F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"), F.round(F.avg(F.when(good, F.col("ms"))), 6).alias("avg_ms"))


def eta_seconds(remaining: Column, per_second: Column) -> Column:
    return F.try_divide(remaining, per_second)


def effect(value: Column, before: Column) -> Column:
    """Of an action, from the rate before and after it."""
    r = F.try_divide(value, before)
    return F.when(r.isNull(), "unknown").when(r > 1.05, "better").when(r < 0.90, "much worse").when(r < 0.95, "worse").otherwise("neutral")


def backoff(attempt: Column, base: float = 1.0, cap: float = 300.0, jitter: Column | None = None) -> Column:
    """Seconds to wait: doubling up to a cap, within a fifth either way by ``jitter`` in 0..1."""
    plain = F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(cap))
    return plain if jitter is None else plain * (0.8 + 0.4 * jitter)


def benchmark_summary(rows: DataFrame) -> DataFrame:
    """Of ``rows(original_bytes, blob_bytes, ms)``: totals, rates, and both the mean of ratios and the ratio of sums."""
    total = rows.agg(
        F.count("*").alias("files"),
        F.sum("original_bytes").alias("original_bytes"),
        F.sum("blob_bytes").alias("blob_bytes"),
        F.sum("ms").alias("ms"),
        F.round(F.avg(F.try_divide(F.col("blob_bytes").cast("double"), F.col("original_bytes"))), 6).alias("mean_ratio"),
    )
    per = lambda a, b: F.round(F.try_divide(a, b), 6)
    return total.select(
        "files", "original_bytes", "blob_bytes", "mean_ratio",
        per(F.col("blob_bytes").cast("double"), F.col("original_bytes")).alias("total_ratio"),
        per(F.col("files") * 1000.0, F.col("ms")).alias("files_per_second"),
        per(F.col("original_bytes") / 1000.0, F.col("ms")).alias("megabytes_per_second"),
        per(F.col("ms"), F.col("files")).alias("ms_per_file"),
    )


def extrapolate(rows: DataFrame, test: Column, key: str, sample: int) -> DataFrame:
    """How many rows pass ``test``, from the ``sample`` rows with the smallest hash of ``key``: whole numbers, rounded down."""
    few = rows.orderBy(F.xxhash64(key), key).limit(sample).agg(F.count("*").alias("sampled"), F.count_if(test).alias("passed"))
    whole = rows.agg(F.count("*").alias("total"))
    return few.join(F.broadcast(whole)).selectExpr("sampled", "passed", "total", "CASE WHEN sampled = 0 THEN 0 ELSE passed * total DIV sampled END AS estimate")


def idle_percent(wait: Column, work: Column) -> Column:
    """Share of waiting in all time; 0 if there is none."""
    return F.coalesce(F.round(F.try_divide(100.0 * wait, wait + work), 6), F.lit(0.0))


def worker_totals(rows: DataFrame) -> DataFrame:
    """Over ``rows(worker, hashed, hits)``: sums of all workers, and the share of hits in percent of at least one."""
    total = rows.agg(F.countDistinct("worker").alias("workers"), F.coalesce(F.sum("hashed"), F.lit(0)).alias("hashed"), F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"))
    return total.withColumn("hit_percent", F.round(100.0 * F.col("hits") / F.greatest("hashed", F.lit(1)), 6))


def mean_of_latest(rows: DataFrame, by: str, value: str, ts: str, tie: str) -> DataFrame:
    """Mean over groups of each group's last value."""
    last = rows.groupBy(by).agg(F.max_by(value, F.struct(ts, tie)).alias("v"))
    return last.agg(F.count("*").alias("groups"), F.round(F.avg("v"), 6).alias("mean"))


def memory_action(memory: Column, own: Column, limit: Column, used: Column) -> Column:
    """What to do with a shared-memory limit; null for nothing. Percent of the machine's memory in use, and of our own.

    The urgent arm can't be reached, as the one before it holds whenever it does; it stays as the rule's table has it.
    """
    return (
        F.when((memory < 50) & (own < 20), F.when((limit < 2_000_000_000) & (used > 0.8 * limit), "increase_aggressive"))
        .when((memory < 70) & (own < 30), F.when((limit < 1_500_000_000) & (used > 0.9 * limit), "increase_moderate"))
        .when((memory > 85) | (own > 40), "decrease")
        .when((memory > 90) | (own > 50), "decrease_urgent")
    )


def queue_label(size: Column) -> Column:
    """-1: the platform doesn't tell."""
    return F.when(size == -1, "[?]").when(size > 80, "[HIGH]").when(size > 50, "[MED]").otherwise("[LOW]")


def stage_label(staged: Column) -> Column:
    return F.when(staged > 500, "[BACKLOG]").when(staged > 200, "[BUSY]").otherwise("[OK]")


def bottleneck_label(queue: Column, staged: Column, claimed: Column, hashers: Column, compressors: Column, cpu: Column, memory: Column) -> Column:
    inferred = F.when((compressors < hashers) & (cpu < 50), "[C-SLOW]").when(staged > 500, "[U-SLOW]").otherwise("[OK]")
    return (
        F.when(queue == -1, inferred)
        .when(queue > 70, "[C-SLOW]")
        .when(staged > 500, "[U-SLOW]")
        .when(claimed < 2 * hashers, "[DB-LAG]")
        .when(cpu > 90, "[CPU-MAX]")
        .when(memory > 85, "[MEM-HIGH]")
        .otherwise("[OK]")
    )
