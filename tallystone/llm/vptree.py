"""Nearest neighbours by inner product with vantage-point trees per shard.

Inner product becomes distance by one more coordinate: with M the largest norm of a shard, a vector x is placed at
(x, sqrt(M^2 - |x|^2)) and a query q at (q, 0); then |q - x|^2 = |q|^2 + M^2 - 2 q.x, so the nearest have the
largest products and the triangle inequality holds. A shard is a run of at most ``shard_rows`` rows of a partition;
its distinct vectors form one tree: each node has a vantage point and the median distance to it, each leaf up to
``LEAF`` vectors. All queries go down together; a child is skipped for a query if ``factor`` times the least
distance that the triangle inequality allows there is more than the query's k-th best distance. ``factor`` 1 is exact
search, larger factors skip more.

Trees are built once, by the tasks that read the vectors, and written to the shared folder. Shards are dealt out to
groups of about ``group_rows`` rows, queries to blocks of at most ``block_rows``; every block goes to every group, where a
task holds the group's trees and one block at a time and returns the k best of the group for each query of the block.
A window keeps the k best of all groups. Nothing is collected or broadcast. Scores are sums in double precision over the
original components, first to last. Ties go to the smaller vec_id: queries whose k-th best may tie with vectors that
a tree did not keep are compared with its whole shard.

Cases: vectors that are null, zero, of another length than most, or that hold null or non-finite components take no
part, as candidates or queries; null vec_ids neither; candidates of a query are all rows of other vec_ids; repeated
rows are candidates each; a repeated query row is one query; fewer candidates than k are all returned; an empty table
gives no rows; other columns are ignored. Scores beyond the largest double are infinite and tie; sums of both
infinities are no number and come last, as minus infinity would.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.llm import text as tx
from tallystone.llm.storage import discard, materialize

LEAF = 64
SHARD_ROWS = 8192
#: Rows of the shards that one task holds as trees while it searches them.
GROUP_ROWS = 32_768
#: Queries that a task searches for at once.
BLOCK_ROWS = 4096
#: Partitions for each group of shards, so that few of them get several groups.
SPREAD = 4
#: Vectors kept beyond k while products come from matrix multiplication, whose last bits vary.
SPARE = 12
#: Queries at once of those whose k-th best ties with vectors beyond the kept ones.
TIED = 64
#: Components within these powers of two have squares and products in range.
USUAL = 400
_SLACK = 1e-9

_FOUND = "q long, query_id long, vec_id long, score double"


def _power(vectors: np.ndarray) -> np.ndarray:
    """Of each matrix or vector, the power of two to divide by: 0 where the largest component is of usual size."""
    power = np.frexp(np.abs(vectors).reshape(len(vectors), -1).max(1))[1]
    return np.where(np.abs(power) > USUAL, power, 0)


class Tree:
    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        """``points``: distinct vectors of one shard."""
        # numbers whose squares would overflow or vanish are searched for as multiples of a power of two
        self.power = int(_power(points[None])[0])
        self.original = points if self.power else None
        points = np.ldexp(points, -self.power) if self.power else points
        squares = np.einsum("ij,ij->i", points, points)
        self.top = float(squares.max())
        self.points = np.hstack([points, np.sqrt(np.maximum(0.0, self.top - squares))[:, None]])
        self.leaf = leaf
        self.root = self._build(np.arange(len(points)))

    @property
    def vectors(self) -> np.ndarray:
        return self.points[:, :-1] if self.original is None else self.original

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        # the point farthest from the middle sees the others at the most varied distances
        own = self.points[rows]
        centre = int(np.argmax(((own - own.mean(0)) ** 2).sum(1)))
        distance = np.sqrt(((own - own[centre]) ** 2).sum(1))
        half = float(np.median(distance))
        near = distance <= half
        if near.sum() > len(rows) * 15 // 16:  # many at one distance: splits would be too lopsided to help
            return rows
        return rows[centre], half, self._build(rows[near]), self._build(rows[~near])

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the ``k`` best vectors for each query (-1: none), and their products, in no order.

        ``queries`` and products: multiples of powers of two, by query and of the tree."""
        self.q = np.hstack([queries, np.zeros((len(queries), 1))])
        self.norms = np.einsum("ij,ij->i", queries, queries) + self.top
        self.rows = np.full((len(queries), k), -1, np.int64)
        self.best = np.full((len(queries), k), -np.inf)
        self.factor = factor
        self._visit(self.root, np.arange(len(queries)), np.zeros(len(queries)))
        return self.rows, self.best

    def _reach(self, active: np.ndarray) -> np.ndarray:
        """Distance of the k-th best so far."""
        return np.sqrt(np.maximum(0.0, self.norms[active] - 2 * self.best[active].min(1)))

    def _visit(self, node, active: np.ndarray, least: np.ndarray) -> None:
        """``least``: the smallest distance that the node's points can have."""
        keep = self.factor * least * (1 - _SLACK) <= self._reach(active) + _SLACK
        active = active[keep]
        if not len(active):
            return
        if not isinstance(node, tuple):
            products = self.q[active, :-1] @ self.points[node, :-1].T
            k = self.best.shape[1]
            values = np.hstack([self.best[active], products])
            rows = np.hstack([self.rows[active], np.broadcast_to(node, products.shape)])
            top = np.argpartition(-values, k - 1, axis=1)[:, :k]
            self.best[active] = np.take_along_axis(values, top, 1)
            self.rows[active] = np.take_along_axis(rows, top, 1)
            return
        centre, half, inside, outside = node
        distance = np.sqrt(((self.q[active] - self.points[centre]) ** 2).sum(1))
        to_inside, to_outside = np.maximum(0.0, distance - half), np.maximum(0.0, half - distance)
        first = distance <= half
        self._visit(inside, active[first], to_inside[first])
        self._visit(outside, active[~first], to_outside[~first])
        self._visit(outside, active[first], to_outside[first])
        self._visit(inside, active[~first], to_inside[~first])


def _shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids, vectors, n = [], [], 0
    for batch in batches:
        for k in range(0, batch.num_rows, limit):
            part = batch.slice(k, limit)
            own = part.column("vec_id").to_numpy(zero_copy_only=False)
            if n + len(own) > limit and n:
                yield np.concatenate(ids), np.concatenate(vectors)
                ids, vectors, n = [], [], 0
            ids.append(own)
            vectors.append(part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1).astype(np.float64))
            n += len(own)
    if n:
        yield np.concatenate(ids), np.concatenate(vectors)


class Shard:
    """The rows of one shard: ids by distinct vector, smallest first, and the tree of these vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, *vectors.T[::-1]))
        self.ids, vectors = ids[order], vectors[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (vectors[1:] != vectors[:-1]).any(1)
        self.first = np.flatnonzero(fresh)
        self.copies = np.diff(np.append(self.first, len(ids)))
        self.tree = Tree(vectors[self.first])

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, which: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of pairs of a query and a distinct vector: query, id and score of each query's k best rows."""
        distinct, first, copies = self.tree.vectors, self.first, self.copies
        score = np.zeros(len(which))
        for step in range(0, len(which), 50_000):
            part = slice(step, step + 50_000)
            with np.errstate(over="ignore", invalid="ignore"):
                score[part] = np.cumsum(queries[which[part]] * distinct[vector[part]], axis=1)[:, -1] + 0.0  # no negative zero
        # of equal vectors, the k + 1 smallest ids (one may be the query's own)
        many = np.minimum(copies[vector], k + 1)
        item = np.repeat(np.arange(len(which)), many)
        found = self.ids[np.repeat(first[vector] - np.cumsum(many) + many, many) + np.arange(len(item))]
        which, score = which[item], score[item]
        other = found != query_ids[which]
        return top(which[other], found[other], score[other], k)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        distinct = self.tree.vectors
        kept = min(k + 1 + SPARE, len(distinct))
        power = _power(queries)
        scaled = np.ldexp(queries, -power[:, None]) if power.any() else queries
        power = power + self.tree.power
        rows, products = self.tree.search(scaled, kept, factor)
        which, at = np.nonzero(rows >= 0)
        parts = [self.best(query_ids, queries, k, which, rows[which, at])]
        if kept < len(distinct):
            # queries whose k-th best may tie with vectors that were not kept: all vectors that reach it
            which, found, score = parts[0]
            size = distinct.shape[1]
            slack = 8 * size * np.finfo(float).eps * np.sqrt(self.tree.top * np.einsum("ij,ij->i", scaled, scaled))
            low = np.full(len(queries), np.inf)
            np.minimum.at(low, which, np.where(np.isnan(score), -np.inf, score))
            full = np.bincount(which, minlength=len(queries)) == k
            last = np.full(len(queries), -np.inf)
            # scores beyond the largest number are equal, as are those that differ by less than the smallest
            with np.errstate(over="ignore", under="ignore"):
                last[full] = np.ldexp(np.minimum(low[full], np.finfo(float).max), -power[full])
                slack += np.ldexp(size * np.finfo(float).smallest_subnormal, -power)
            tied = last <= products.min(1) + slack
            parts[0] = tuple(x[~tied[which]] for x in parts[0])
            again = np.flatnonzero(tied)
            for step in range(0, len(again), TIED):
                own = again[step : step + TIED]
                q, vector = np.nonzero(scaled[own] @ self.tree.points[:, :-1].T >= (last[own] - slack[own])[:, None])
                parts.append(self.best(query_ids, queries, k, own[q], vector))
        return tuple(map(np.concatenate, zip(*parts, strict=True)))


def top(which: np.ndarray, found: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k rows of highest score, ties to the smaller id."""
    order = np.lexsort((found, np.where(np.isnan(score), np.inf, -score), which))
    which, score, found = which[order], score[order], found[order]
    keep = np.arange(len(which)) - np.searchsorted(which, which) < k
    return which[keep], found[keep], score[keep]


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64)


def _build(batches: Iterator[pa.RecordBatch], shard_rows: int) -> Iterator[pa.RecordBatch]:
    for ids, vectors in _shards(batches, shard_rows):
        yield pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int64()), pa.array([pickle.dumps(Shard(ids, vectors), 5)], pa.binary())], names=["n", "shard"])


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, limit):
            part = batch.slice(k, limit)
            data = part.column("vec_id").to_numpy(zero_copy_only=False), part.column("q").to_numpy(zero_copy_only=False), _matrix(part.column("embedding"), part.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(data, 5)], pa.binary())], names=["block"])


def _search(batches: Iterator[pa.RecordBatch], k: int, factor: float) -> Iterator[pa.RecordBatch]:
    """Rows come group by group, a group's shards before the query blocks."""
    group, held = None, []
    for batch in batches:
        for own, is_block, data in zip(batch.column("g").to_pylist(), batch.column("is_block").to_pylist(), batch.column("data"), strict=True):
            if own != group:
                group, held = own, []
            item = pickle.loads(data.as_buffer())
            if not is_block:
                held.append(item)
                continue
            query_ids, numbers, queries = item
            found = [shard.search(query_ids, queries, k, factor) for shard in held]
            if found:
                which, ids, score = top(*map(np.concatenate, zip(*found, strict=True)), k)
                yield pa.RecordBatch.from_arrays([pa.array(numbers[which]), pa.array(query_ids[which]), pa.array(ids), pa.array(score)], names=["q", "query_id", "vec_id", "score"])
    tx.release()


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & (F.size("embedding") > 0)
        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return rows.where(F.size("embedding") == (sizes[0]["d"] if sizes else 0))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = 1.0, shard_rows: int = SHARD_ROWS, group_rows: int = GROUP_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of ``vectors`` for each row of ``queries`` (both vec_id, embedding)."""
    shards = materialize(tx.map_arrow(vectors, lambda b: _build(b, shard_rows), "n long, shard binary"), "trees")
    total, many = shards.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    groups = max(1, -(-total // group_rows), min(many, vectors.sparkSession.sparkContext.defaultParallelism))
    # several rows of one id are several queries: two hashes tell them apart
    asked = queries.distinct().withColumn("q", F.xxhash64("vec_id", "embedding"))
    blocks = materialize(tx.map_arrow(asked.coalesce(max(1, min(groups, asked.sparkSession.sparkContext.defaultParallelism))), lambda b: _blocks(b, block_rows), "block binary"), "queries")
    # shards are dealt in turn, each file of them beginning one group further
    row = F.monotonically_increasing_id()
    turn = F.shiftright(row, 33) + row.bitwiseAND(F.lit((1 << 33) - 1))
    held = shards.select(F.pmod(turn, F.lit(groups)).cast("int").alias("g"), F.lit(0).alias("is_block"), F.col("shard").alias("data"))
    asks = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("is_block"), F.col("block").alias("data"))
    met = held.unionByName(asks).repartition(SPREAD * groups, "g").sortWithinPartitions("g", "is_block")
    found = materialize(tx.map_arrow(met, lambda b: _search(b, k, factor), _FOUND), "found")
    discard(shards, blocks)
    place = F.when(F.isnan("score"), F.lit(float("-inf"))).otherwise(F.col("score"))
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc(place), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
