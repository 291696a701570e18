"""Exact ranks and quantiles by group, where one group may hold most rows: no task holds a group.

Equal values of a group are counted first, before anything is shuffled. The counts are dealt out by ranges of (group, value)
and written down with the number of their range. A range's rows are numbered by the task that has it, and each range
begins where those before it end: of a group, one row a range. A quantile is then the one or two values
whose places cover it.

Cases: null values have no rank, but are rows of their group; a null group is a group; NaN is larger than all numbers; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.sources import scratch


def ranked(rows: DataFrame, by: str, value: str) -> DataFrame:
    """``by, value, n, before, total, size``: the different values of each group, how many rows have one and how many a
    smaller one; how many rows of the group have a value, and how many there are. Null values come last."""
    order = [F.asc(by), F.asc_nulls_last(value)]
    counts = rows.groupBy(by, value).agg(F.count("*").alias("n"))
    dealt = counts.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    kept = scratch.written(dealt, "ranks")
    known = F.when(F.col(value).isNotNull(), F.col("n")).otherwise(0)
    parts = kept.groupBy(by, "part").agg(F.sum("n").alias("rows"), F.sum(known).alias("known"))
    group = Window.partitionBy(by)
    ahead = F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select(
        F.col(by).alias("_by"), F.col("part").alias("_part"), F.coalesce(ahead, F.lit(0)).alias("_start"),
        F.sum("known").over(group).alias("total"), F.sum("rows").over(group).alias("size"),
    )
    inside = F.sum("n").over(Window.partitionBy(by, "part").orderBy(F.asc_nulls_last(value)))
    numbered = kept.withColumn("_inside", inside - F.col("n"))
    met = numbered.join(starts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("part") == F.col("_part")))
    return met.select(by, value, "n", (F.col("_start") + F.col("_inside")).alias("before"), "total", "size")


def _at(place: Column, value: str) -> Column:
    """Of a group's rows of ``ranked``, the value at a place counted from 0."""
    covered = (F.col("before") <= place) & (place < F.col("before") + F.col("n")) & (place < F.col("total"))
    return F.max(F.when(covered, F.col(value)))


def quantiles(rows: DataFrame, by: str, value: str, points: dict[str, float]) -> DataFrame:
    """``by``, a column for each of ``points`` (by linear interpolation, null without values) and ``n``, the group's rows."""
    found = ranked(rows, by, value)
    place = {name: F.lit(q) * (F.col("total") - 1) for name, q in points.items()}
    ends = [e for name in points for e in (_at(F.floor(place[name]), value).alias(f"_low_{name}"), _at(F.ceil(place[name]), value).alias(f"_high_{name}"))]
    got = found.groupBy(by).agg(*ends, F.max("total").alias("total"), F.max("size").alias("n"))

    def between(name: str) -> Column:
        low, high = F.col(f"_low_{name}").cast("double"), F.col(f"_high_{name}").cast("double")
        part = place[name] - F.floor(place[name])
        return F.when(low == high, low).otherwise(low * (1 - part) + high * part).alias(name)

    return got.select(by, *map(between, points), "n")


def at_places(rows: DataFrame, by: str, value: str, places: dict[str, Column]) -> DataFrame:
    """``by`` and the values at ``places``: expressions over ``total``, counted from 0. Groups without values are left out."""
    return ranked(rows.where(F.col(value).isNotNull()), by, value).groupBy(by).agg(*(_at(p, value).alias(name) for name, p in places.items()))
