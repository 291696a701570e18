"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased, everything but letters and digits becomes one space, and the features are the distinct
character n-grams (``SIZES``) that hold no space except at their ends. From a bounded sample of labelled rows (at
most ``sample`` of each class, those with the smallest hash of doc_id) the number of documents of each class that
have an n-gram gives its log-count ratio; n-grams of at least ``least`` documents whose ratio stands out of chance by
``deviations`` are kept, at most ``features`` of them (1, 0 and None: all). A logistic regression over these, each scaled by its ratio, is fitted on the sample and
its intercept moved to the classes' shares among all labelled rows. Scoring reads every whole text once.

Cases: null or empty texts get the score of a text without features; repeated rows get equal scores; an id with several
labels is toxic if one of them says so; of several documents with one id that with the smallest hash of its text
teaches; labels that are null, or of documents that don't exist, teach nothing; without both classes every score is the share of toxic
rows (0 if there are no labels); an empty table gives no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallystone.llm import text as tx
from tallystone.llm.storage import materialize

SIZES = (3, 4, 5)
SAMPLE = 2000
FEATURES = 40_000
DEVIATIONS = 3.0
LEAST = 3
#: Texts are handled in slices of about so many bytes: every character starts up to three n-grams of 12 bytes.
SLICE_BYTES = 1_500_000

_U = np.uint64


def fold(key: Column, parts: int) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(parts))


def _grams(column: pa.Array, wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every n-gram occurrence, or of those that ``wanted`` marks."""
    points, offsets = tx.code_points(column)
    word = tx.letters()[points] | ((points >= 48) & (points <= 57))
    chars = np.where(word, tx.lower()[points], 32)
    # one space for each run of other characters, and one at each end of a text
    n = len(chars)
    counts = np.diff(offsets)
    place = np.arange(n) + 2 * np.repeat(np.arange(len(counts)), counts) + 1
    padded = np.full(n + 2 * len(counts), 32, np.uint32)
    padded[place] = chars
    owner = np.repeat(np.arange(len(counts)), counts + 2)
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != 32) | (padded[:-1] != 32) | (owner[1:] != owner[:-1])
    padded, owner = padded[keep], owner[keep].astype(np.int32)
    space = padded == 32
    owners, found = [], []
    value = tx.mix(padded.astype(_U) + _U(0x51ED270B))
    code = value
    inner = np.zeros(len(padded), bool)
    for size in range(2, max(SIZES) + 1):
        # code[i]: hash of padded[i:i+size]; inner[i]: whether a space is within it
        if len(padded) < size:
            break
        code = code[:-1] * _U(0x9E3779B97F4A7C15) + value[size - 1 :]
        if size > 2:
            inner = inner[: len(code)] | space[size - 2 : size - 2 + len(code)]
        if size in SIZES:
            good = np.flatnonzero(~inner[: len(code)])
            if wanted is not None:
                good = good[wanted(code[good])]
            owners.append(owner[good])
            found.append(code[good])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, _U)
    return np.concatenate(owners), np.concatenate(found)


@dataclass
class Model:
    hashes: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.shift = _U(64 - 22)
        self.filter = np.zeros(1 << 22, bool)
        self.filter[self._slot(self.hashes)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _U(0xBF58476D1CE4E5B9)) >> self.shift).astype(np.int64)

    def features(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of text number and feature number."""
        owner, code = _grams(column, lambda code: self.filter[self._slot(code)])
        owner = owner.astype(np.int64)
        if not len(code) or not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, code), len(self.hashes) - 1)
        exact = self.hashes[at] == code
        pairs = np.unique(owner[exact] * len(self.hashes) + at[exact])
        return pairs // len(self.hashes), pairs % len(self.hashes)

    def scores(self, column: pa.Array) -> np.ndarray:
        owner, feature = self.features(column)
        margin = self.bias + np.bincount(owner, self.weights[feature], len(column))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, "text", SLICE_BYTES):
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            owner, code = _grams(batch.column("text"))
            order = np.lexsort((owner, code))
            owner, code = owner[order], code[order]
            fresh = np.ones(len(code), bool)
            fresh[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
            owner, code = owner[fresh], code[fresh]
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
            both = np.diff(np.append(first, len(code)))
            bad = np.add.reduceat(toxic[owner], first) if len(code) else first
            yield pa.RecordBatch.from_arrays([pa.array(code[first].view(np.int64)), pa.array(bad), pa.array(both - bad)], names=["gram", "bad", "good"])


def _vectors(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, "text", SLICE_BYTES):
            owner, feature = model.value.features(batch.column("text"))
            edge = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), lists], names=["doc_id", "toxic", "features"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int | None = FEATURES, deviations: float = DEVIATIONS, least: int = LEAST) -> Model:
    """Fit on ``labels(doc_id, toxic)`` and the texts of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # labels may cover more than these documents: only those that have one are drawn from, and count for the shares
    known = materialize(known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi"), "toxicity-labels")
    shares = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    nothing = np.zeros(0, _U), np.zeros(0)
    if len(shares) < 2:
        return Model(*nothing, 500.0 if shares.get(1) else -500.0)
    picked = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    chosen = picked[0].unionByName(picked[1])  # at most 2 * sample ids: small enough to broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # one row an id, chosen by hashes before any text is shuffled
    first = rows.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("h"))
    texts = rows.join(F.broadcast(first), "doc_id").where(F.xxhash64("text") == F.col("h")).drop("h").dropDuplicates(["doc_id"])
    texts = texts.repartition(2 * spark.sparkContext.defaultParallelism)
    texts = materialize(texts, "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = float(np.log(shares[1] / shares[0]))
    if len(sizes) < 2:
        return Model(*nothing, prior)
    bad, good = (F.col("bad") + 1) / (sizes[1] + 2), (F.col("good") + 1) / (sizes[0] + 2)
    counted = tx.map_arrow(texts, _count, "gram long, bad long, good long").groupBy("gram").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    ratio = counted.where(F.col("bad") + F.col("good") >= least).select("gram", F.log(bad / good).alias("ratio"), (F.log(bad / good) / F.sqrt(1 / (F.col("bad") + 1) + 1 / (F.col("good") + 1))).alias("z"))
    best = ratio.where(F.abs("z") >= deviations).orderBy(F.abs("z").desc(), "gram")
    best = (best if features is None else best.limit(features)).select("gram", "ratio").collect()
    if not best:
        return Model(*nothing, prior)
    hashes = np.array([r[0] for r in best], np.int64).view(_U)
    ratios = np.array([r[1] for r in best])
    order = np.argsort(hashes)
    model = Model(hashes[order], ratios[order], 0.0)
    shared = spark.sparkContext.broadcast(model)
    rows = tx.map_arrow(texts, lambda b: _vectors(b, shared), "doc_id long, toxic int, features array<int>").orderBy("doc_id").toPandas()
    target = rows["toxic"].to_numpy(float)
    lengths = rows["features"].map(len).to_numpy()
    column = np.concatenate([np.zeros(0, np.int64), *rows["features"]]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), lengths)
    weights, bias = _logistic(row, column, model.weights, target)
    # the sample holds the classes in other shares than all labelled rows
    bias += prior - float(np.log(sizes[1] / sizes[0]))
    return Model(model.hashes, weights * model.weights, bias)


def _logistic(row: np.ndarray, column: np.ndarray, scale: np.ndarray, target: np.ndarray, strength: float = 0.5, steps: int = 400) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression by Adam on all rows; ``scale`` multiplies the features."""
    n, k = len(target), len(scale)
    x = scale[column]
    w, b = np.zeros(k), 0.0
    m, v, mb, vb = np.zeros(k), np.zeros(k), 0.0, 0.0
    for t in range(1, steps + 1):
        margin = b + np.bincount(row, x * w[column], n)
        error = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - target
        g = np.bincount(column, x * error[row], k) / n + strength / n * w
        gb = error.mean()
        rate = 0.05 * (1 - t / (steps + 1))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, float(b)


def _score(batches: Iterator[pa.RecordBatch], model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, "text", SLICE_BYTES):
            scores = model.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=schema.names)


def score(docs: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` behind its columns."""
    schema = T.StructType([*docs.schema.fields, T.StructField(f"{prefix}score", T.DoubleType()), T.StructField(f"{prefix}predicted", T.IntegerType())])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return tx.map_arrow(docs, lambda b: _score(b, shared, arrow), schema)
