"""Logs by month (what a scan reads), time zones at the edges of summer time, conditions over odd names."""

import datetime
import re
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tallystone import sources
from tallystone.functions import zones
from tallystone.operators import filters


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("log") / "ops")
    rows = spark.range(0, 24 * 400).selectExpr("id", "TIMESTAMP_NTZ'2023-01-01 00:30:00' + make_dt_interval(0, CAST(id AS INT)) AS operation_timestamp")
    sources.write_monthly(rows.unionByName(spark.sql("SELECT -1L AS id, CAST(NULL AS TIMESTAMP_NTZ) AS operation_timestamp")), root)
    return root


def _ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_a_range_reads_its_months(spark, log):
    rows = sources.read_monthly(spark, log, _ntz("2023-02-27 12:00:00"), _ntz("2023-04-01 00:00:00"))
    assert "PartitionFilters: [isnotnull(month" in rows._jdf.queryExecution().executedPlan().toString()
    got = rows.select(F.input_file_name().alias("f"), "id").collect()
    assert {re.search("month=([^/]*)", r["f"]).group(1) for r in got} == {"2023-02", "2023-03"}
    start = datetime.datetime(2023, 1, 1, 0, 30)
    expected = [k for k in range(24 * 400) if datetime.datetime(2023, 2, 27, 12) <= start + datetime.timedelta(hours=k) < datetime.datetime(2023, 4, 1)]
    assert sorted(r["id"] for r in got) == expected


def _scanned(rows):
    """Partitions that the scan of a collected plan read, by its own counter."""
    plan = rows._jdf.queryExecution().executedPlan()
    todo, found = [plan], []
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith(("ShuffleQueryStage", "BroadcastQueryStage")):
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet") and node.metrics().contains("numPartitions"):
            found.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        todo.extend(children.apply(k) for k in range(children.size()))
    return found


def test_counted_partitions(spark, log):
    rows = sources.read_monthly(spark, log, _ntz("2023-02-27 12:00:00"), _ntz("2023-04-01 00:00:00")).select("id")
    rows.collect()
    assert max(_scanned(rows)) <= 3  # April's first instant is not in the range, its month is a bound
    whole = sources.read_monthly(spark, log)
    assert whole.count() == 24 * 400 + 1


def test_windows_prune_months_when_they_are_known(spark, log):
    windows = spark.createDataFrame(
        [("a", "2023-03-30 00:00:00", "2023-04-02 00:00:00"), ("b", "2023-04-01 00:00:00", "2023-04-01 06:00:00"), ("empty", "2023-05-02 00:00:00", "2023-05-02 00:00:00"), ("none", None, "2023-05-02 00:00:00")],
        "label string, start string, stop string",
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "stop")})
    rows = sources.during(spark.read.parquet(log), windows)
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()
    found = rows.groupBy("label").count()
    assert sorted(tuple(r) for r in found.collect()) == [("a", 72), ("b", 6)]


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
def test_zones_at_the_edges_of_summer_time(spark, session):
    zone = ZoneInfo("America/New_York")
    edges = [datetime.datetime(2024, 3, 10), datetime.datetime(2024, 11, 3), datetime.datetime(1995, 10, 29), datetime.datetime(1969, 12, 31, 20)]
    times = [e + datetime.timedelta(minutes=20 * k, microseconds=k) for e in edges for k in range(24)]
    utc = datetime.timezone.utc
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        rows = spark.createDataFrame([(t.isoformat(" "),) for t in times] + [(None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
        got = rows.select(zones.to_utc(F.col("t"), "America/New_York").alias("u"), zones.in_zone(F.col("t"), F.lit("America/New_York")).alias("z"), F.unix_micros(zones.as_utc(F.col("t"))).alias("m")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    epoch = datetime.datetime(1970, 1, 1)
    for t, r in zip(times, got, strict=False):
        assert r["u"] == t.replace(tzinfo=zone, fold=0).astimezone(utc).replace(tzinfo=None)
        assert r["z"] == t.replace(tzinfo=utc).astimezone(zone).replace(tzinfo=None)
        assert r["m"] == (t - epoch) // datetime.timedelta(microseconds=1)
    assert tuple(got[-1]) == (None, None, None)


def test_conditions_over_odd_names(spark):
    names = ["José's 100% x_y", "jose", "JOSEFA", "a.b", "axb", "ÑANDÚ und", "", None]
    rows = spark.createDataFrame([(n,) for n in names], "n string")

    def met(test):
        return [r["n"] for r in rows.where(test).collect()]

    n = F.col("n")
    assert met(filters.has_word(n, ["JOSÉ", "Und"])) == ["José's 100% x_y", "ÑANDÚ und"]
    assert met(filters.has_part(n, ["0%", "a.b"])) == ["José's 100% x_y", "a.b"]
    assert met(filters.has_part_without_accents(n, ["josé", "ñan"])) == ["José's 100% x_y", "jose", "JOSEFA", "ÑANDÚ und"]
    assert met(filters.has_word(n, [])) == met(filters.has_part(n, [])) == met(filters.has_part_without_accents(n, [])) == []
    paths = spark.createDataFrame([("a/b",), ("ab/c",), ("a",), (None,)], "p string")
    assert [r[0] for r in paths.where(filters.below(F.col("p"), "a/")).collect()] == ["a/b"]
    assert paths.where(filters.in_trees(F.col("p"), ["a"])).count() == 1 and paths.where(~filters.in_trees(F.col("p"), ["a"])).count() == 3
    lists = spark.createDataFrame([(["x", None, "x", "y"],), (None,), ([],)], "l array<string>")
    assert [r[0] for r in lists.select(filters.listed(F.col("l"))).collect()] == [["x", "y"], None, []]
