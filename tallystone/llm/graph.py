"""Connected components over edge tables, without collecting anything to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm.storage import adopt, discard, materialize


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the component is its smallest node.

    Alternating large-star and small-star steps: each keeps an edge table of at most the same size whose nodes point
    to ever smaller neighbours, until no edge changes. The number of rounds is about the logarithm of the longest
    chain. Hot nodes cost partial aggregates and joins of plain exchanges, which can be split. Loops and nulls are ignored.
    """
    links = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(rounds):
        if _stars(links):
            break
        # large star: every larger neighbour, and the node itself, to the smallest of the neighbourhood
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
        large = materialize(both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")), "large")
        # small star: smaller neighbours, and the node itself, to the smallest of them
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").select(F.col("b").alias("x"), "a", "m")
        small = small.select(F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        before, links = links, materialize(small.select("e.*").where("a <> b").distinct(), "links")
        discard(before, least, large, low)
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return adopt(links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots), links)


def _stars(links: DataFrame) -> bool:
    """Whether every node either has one smaller neighbour and no larger one, or only larger ones."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("low")).where("ups > 1 OR ups = 1 AND low = 0").isEmpty()
