"""Quantiles over groups of any size against numpy, and what last-n rows send over the network."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystone.operators import metrics, ranks
from tallystone.sources import scratch


def _groups():
    rng = np.random.default_rng(5)
    return {
        "hot": rng.normal(0, 1e6, 20_000).round(3).tolist(),
        "copies": [7.5] * 5000 + [8.0],
        "skewed": (10.0 ** rng.uniform(-200, 200, 999)).tolist(),
        "one": [3.0],
        "two": [1.0, 2.0],
        "nulls": [None, 4.0, None],
        "none": [None, None],
        None: [1.0, 5.0, 9.0],
    }


@pytest.fixture(scope="module")
def samples(spark):
    rows = [(k, v) for k, values in _groups().items() for v in values]
    np.random.default_rng(6).shuffle(rows)
    return spark.createDataFrame([(k, None if v is None else float(v)) for k, v in rows], "g string, v double").repartition(6)


def test_quantiles_equal_those_of_numpy(samples):
    points = {"a": 0.0, "b": 0.37, "c": 0.5, "d": 0.95, "e": 1.0}
    found = {r["g"]: r for r in ranks.quantiles(samples, "g", "v", points).collect()}
    assert found.keys() == _groups().keys()
    for key, values in _groups().items():
        own = [v for v in values if v is not None]
        assert found[key]["n"] == len(values)
        for name, q in points.items():
            expected = float(np.quantile(own, q)) if own else None
            got = found[key][name]
            assert got is None and expected is None or math.isclose(got, expected, rel_tol=1e-9), (key, name)


def test_ranks_number_every_row(samples):
    found = ranks.ranked(samples, "g", "v").where("v IS NOT NULL").collect()
    for key, values in _groups().items():
        own = sorted(v for v in values if v is not None)
        rows = sorted((r["v"], r["n"], r["before"], r["total"]) for r in found if r["g"] == key)
        assert rows == [(v, own.count(v), own.index(v), len(own)) for v in sorted(set(own))] if len(own) < 6000 else len(rows) == len(set(own))


def test_a_hot_group_is_not_one_task(spark, monkeypatch):
    """All rows of one group: the ranges that number them have a share each."""
    kept, written = [], scratch.written
    monkeypatch.setattr(scratch, "written", lambda rows, name: kept.append(written(rows, name)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = ranks.ranked(spark.range(40_000).select(F.lit("x").alias("g"), F.xxhash64("id").alias("v")), "g", "v")
        assert found.agg(F.max("before"), F.countDistinct("before")).first()[:] == (39_999, 40_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shares = [r["count"] for r in kept[0].groupBy("part").count().collect()]
    assert len(shares) == 4 and max(shares) < 15_000


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert ranks.quantiles(empty, "g", "v", {"a": 0.5}).collect() == [] and metrics.nearest_rank(empty, "g", "v").collect() == []
    whole = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2)], "g string, v long")
    assert [tuple(r) for r in metrics.nearest_rank(whole, "g", "v").collect()] == [("a", 2, 3)]
    assert [tuple(r) for r in metrics.percentiles(whole, "g", "v").collect()] == [("a", 2.0, 2.9, 2.98, 3)]


def test_last_rows_are_cut_before_the_shuffle(spark):
    rows = spark.range(0, 100_000, 1, 8).select((F.col("id") < 0).alias("g"), F.col("id").alias("ts"), "id")
    kept = metrics.latest(rows, "g", "ts", "id", 1000)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert [r["ts"] for r in kept.orderBy("position").collect()] == list(range(99_999, 98_999, -1))
