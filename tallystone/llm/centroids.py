"""Lloyd's clustering with exact integer results: float32 products screen, integers decide.

Each component x becomes the integer floor(2**bits * x). The centroids start as the ``k`` vectors with the smallest
SHA-256 of ``<seed>:<vec_id>``. Each of ``rounds`` rounds assigns every vector to its nearest centroid (squared
Euclidean distance, ties to the smaller number) and moves every centroid that has vectors to the componentwise
floor(sum / count) of these. Then all vectors are assigned once more.

Nearest is found from |c|^2 - 2 x.c, which orders centroids as the distance does. The products x.c are one float32
matrix product a batch. A float32 product of d terms is off by at most g |x||c| where g = (d+2) u / (1 - (d+2) u) and
u = 2**-24, whatever the order of its sums, so each value is known to lie in an interval. Centroids whose interval
overlaps that of the best are compared again by exact integers. Integers beyond 2**40 are left to Python's own.

Each task sums its vectors a centroid and sends, for each, count and sums in limbs of 31 bits, which Spark adds up;
the driver sees k x (d + 1) numbers a round, whatever the number of vectors. Nothing else is broadcast or collected.

Cases: vectors of another length, or with null, NaN or infinite components take no part and give no row; an empty table
gives none; rows of one vec_id are vectors of their own (for starting, in the order of their components); a null vec_id
starts a centroid only if others don't suffice; with fewer than ``k`` vectors there are that many centroids; distances
and inertias beyond 64 bits are null. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.llm import text as tx
from tallystone.llm.storage import adopt, materialize

SIZE = 64
K = 8
ROUNDS = 10
BITS = 10
SEED = "3"
#: Integers below this are int64 in numpy, and their float32 products are finite.
NARROW = 1 << 40
#: Rows of one matrix product.
ROWS = 8192
_LIMB = 31


def usable(vectors: DataFrame, size: int = SIZE) -> DataFrame:
    """``vec_id, embedding`` of the vectors that take part; the embedding as doubles."""
    found = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return found.where((F.size("embedding") == size) & finite)


def integers(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(2**bits * x) as int64, and the rows with a number too large for that, which are zero there."""
    with np.errstate(over="ignore"):
        scaled = np.floor(np.ldexp(values, bits))
    wide = ~(np.abs(scaled) < NARROW).all(axis=1)
    return np.where(wide[:, None], 0.0, scaled).astype(np.int64), wide


def exact(row: np.ndarray, bits: int) -> list[int]:
    """The integers of one vector, of any size: a double is a whole number over a power of two."""
    pairs = (float(x).as_integer_ratio() for x in row)
    return [(over << bits) // under for over, under in pairs]


def distance(one: list[int], two: list[int]) -> int:
    return sum((a - b) * (a - b) for a, b in zip(one, two, strict=True))


class Nearest:
    """The nearest of some centroids, given as lists of integers."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = centroids
        largest = [max(map(abs, c), default=0) for c in centroids]
        # nothing is nearest to a centroid this far off while one is near
        near = [i for i, m in enumerate(largest) if m < NARROW << 36]
        usable_ = [i for i, m in enumerate(largest) if m < NARROW << 40]
        self.screened = np.array(usable_ if near else [], np.int64)
        self.narrow = all(largest[i] < NARROW for i in self.screened)
        if len(self.screened):
            kept = [centroids[i] for i in self.screened]
            self.float32 = np.array([[float(x) for x in c] for c in kept], np.float32).T
            self.squares = np.array([float(sum(x * x for x in c)) for c in kept])
            self.norms = np.sqrt(self.squares) * (1 + 1e-9)
            self.ints = np.array(kept, np.int64 if self.narrow else object)
            self.size = max((max(map(abs, c), default=0) for c in kept), default=0)
        d = len(centroids[0])
        self.slack = (d + 2) * 2.0**-24 / (1 - (d + 2) * 2.0**-24)

    def shortlist(self, rows: np.ndarray) -> np.ndarray:
        """For each row, which of the screened centroids may be nearest."""
        floats = rows.astype(np.float64)
        norms = np.sqrt((floats * floats).sum(axis=1)) * (1 + 1e-9)
        dots = (rows.astype(np.float32) @ self.float32).astype(np.float64)
        scale = norms[:, None] * self.norms
        value = self.squares - 2 * dots
        error = 2 * self.slack * scale + 2.0**-50 * (self.squares + 2 * scale)
        return value - error <= (value + error).min(axis=1)[:, None]

    def _distances(self, rows: np.ndarray, of: np.ndarray, to: np.ndarray) -> np.ndarray:
        fits = self.narrow and max(int(np.abs(rows).max(initial=0)), self.size) < 1 << 27 and rows.shape[1] <= 128
        kind = np.int64 if fits else object
        apart = rows[of].astype(kind) - self.ints[to].astype(kind)
        return (apart * apart).sum(axis=1)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By row of int64 the number of its centroid and the exact squared distance."""
        if not len(self.screened):
            found = [self.of_one([int(x) for x in row]) for row in rows]
            return np.array([c for c, _ in found], np.int64), np.array([x for _, x in found], object)
        short = self.shortlist(rows)
        best = short.argmax(axis=1)
        open_ = np.flatnonzero(short.sum(axis=1) > 1)
        if len(open_):
            at, to = np.nonzero(short[open_])
            far = self._distances(rows, open_[at], to)
            order = np.lexsort((to, far, at)) if far.dtype != object else np.array(sorted(range(len(at)), key=lambda i: (at[i], far[i], to[i])))
            first = np.flatnonzero(np.diff(at[order], prepend=-1))
            best[open_] = to[order][first]
        return self.screened[best], self._distances(rows, np.arange(len(rows)), best)

    def of_one(self, row: list[int]) -> tuple[int, int]:
        far, number = min((distance(row, c), i) for i, c in enumerate(self.centroids))
        return number, far


def _parts(batch: pa.RecordBatch, size: int, bits: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for start in range(0, batch.num_rows, ROWS):
        part = batch.slice(start, ROWS)
        values = part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        rows, wide = integers(values, bits)
        yield part, values, rows, np.flatnonzero(wide)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    place = 0
    while not -(1 << _LIMB) <= value < 1 << _LIMB:
        yield place, value & ((1 << _LIMB) - 1)
        value >>= _LIMB
        place += 1
    yield place, value


def _sums(batches: Iterator[pa.RecordBatch], centroids: list[list[int]], size: int, bits: int) -> Iterator[pa.RecordBatch]:
    nearest, k = Nearest(centroids), len(centroids)
    counts, sums = [0] * k, np.zeros((k, size), object)
    for batch in batches:
        for _, values, rows, wide in _parts(batch, size, bits):
            number, _ = nearest.of(rows)
            number[wide] = -1
            for c in range(k):
                own = number == c
                counts[c] += int(own.sum())
                sums[c] += rows[own].sum(axis=0)
            for i in wide:
                row = exact(values[i], bits)
                c, _ = nearest.of_one(row)
                counts[c] += 1
                sums[c] += np.array(row, object)
    out = [(c, d, place, x) for c in range(k) if counts[c] for d, v in enumerate([counts[c], *sums[c]]) for place, x in _limbs(int(v))]
    columns = list(zip(*out, strict=True)) or [[], [], [], []]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["cluster", "dim", "place", "value"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: list[list[int]], size: int, bits: int) -> Iterator[pa.RecordBatch]:
    nearest = Nearest(centroids)
    for batch in batches:
        for part, values, rows, wide in _parts(batch, size, bits):
            number, far = nearest.of(rows)
            far = far.tolist()
            for i in wide:
                number[i], far[i] = nearest.of_one(exact(values[i], bits))
            far = [x if x < 1 << 63 else None for x in far]
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(number, pa.int32()), pa.array(far, pa.int64())], names=["vec_id", "cluster", "distance"])


def moved(found: list, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after a round, from ``(cluster, dim, place, value)`` rows; dim 0 is the count."""
    totals: dict[tuple[int, int], int] = {}
    for cluster, dim, place, value in found:
        totals[cluster, dim] = totals.get((cluster, dim), 0) + (int(value) << (_LIMB * place))
    return [[totals[c, d + 1] // totals[c, 0] for d in range(len(old))] if totals.get((c, 0)) else old for c, old in enumerate(centroids)]


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, bits: int = BITS, seed: str = SEED) -> list[list[int]]:
    """The centroids, k x d integers, after ``rounds`` rounds over ``usable`` vectors."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(name.asc_nulls_last(), "embedding").limit(k).select("embedding").collect()
    centroids = [exact(r["embedding"], bits) for r in first]
    for _ in range(rounds if centroids else 0):
        now = centroids
        sums = tx.map_arrow(vectors, lambda b, now=now: _sums(b, now, size, bits), "cluster int, dim int, place int, value long")
        before, centroids = centroids, moved(sums.groupBy("cluster", "dim", "place").agg(F.sum("value").alias("value")).collect(), centroids)
        if before == centroids:  # so are all later rounds
            break
    return centroids


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, bits: int = BITS, seed: str = SEED) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for each vector that takes part."""
    spark = vectors.sparkSession
    kept = usable(vectors, size)
    centroids = fit(kept, k, rounds, size, bits, seed)
    schema = T.StructType([kept.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not centroids:
        return spark.createDataFrame([], T.StructType([*schema, T.StructField("cluster_inertia", T.LongType()), T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())]))
    rows = materialize(tx.map_arrow(kept, lambda b: _assigned(b, centroids, size, bits), schema), "assigned")
    wide = F.col("distance").cast("decimal(38,0)")
    sums = rows.groupBy("cluster").agg(F.sum(wide).alias("s"), F.max(F.col("distance").isNull()).alias("over")).collect()
    total = {r["cluster"]: None if r["over"] else int(r["s"]) for r in sums}
    inertia = None if None in total.values() else sum(total.values())

    def fits(x: int | None) -> int | None:
        return x if x is not None and x < 1 << 63 else None

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    # k rows
    facts = spark.createDataFrame([(c, fits(x), fits(inertia), digests[c]) for c, x in total.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return adopt(rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), rows)
