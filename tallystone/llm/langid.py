"""Language identification: scripts narrow the candidates, Viterbi labels spans of mixed-language text.

Words are runs of letters. Each word's script (the range of its first letter) leaves as candidates the languages
that were seen to use it for more than ``script_share`` of their words (0: for any word); no other can label it. A word's score under a candidate is the mean-free sum of the log-probabilities of its
character n-grams (naive Bayes over ``SIZES``, word ends marked, hashed into ``BUCKETS``). A Viterbi pass over the
words of a document finds the labelling that is best after ``penalty`` for each change of language; equal labels in a
row make a span. The document's language is that with most letters, its score that share of all letters.

N-gram counts are learned from a bounded sample: at most ``sample`` documents of each language, those with the
smallest hash of doc_id.

Cases: text that is null or has no letter is ``und`` with score 0; words in a script that no language was learned
for are neutral, and text of only such words is ``und`` with score 0 if no language was learned, else the language
that Viterbi prefers (the first in order); documents of null language teach nothing; repeated rows get equal results;
an empty table gives no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallystone.llm import text as tx
from tallystone.llm.storage import materialize

SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 16
SAMPLE = 1000
PENALTY = 6.0
#: Stray words of other scripts are in texts of any language.
SCRIPT_SHARE = 0.01
#: A worker keeps the scores of words until they are more than these.
CACHE = 100_000
UNKNOWN = "und"

#: First code points of script ranges (fixed values of the Unicode standard's blocks); a range ends where the next starts.
SCRIPTS = [
    ("latin", 0x0000), ("greek", 0x0370), ("cyrillic", 0x0400), ("armenian", 0x0530), ("hebrew", 0x0590), ("arabic", 0x0600),
    ("syriac", 0x0700), ("arabic", 0x0750), ("thaana", 0x0780), ("other", 0x07C0), ("devanagari", 0x0900), ("bengali", 0x0980),
    ("gurmukhi", 0x0A00), ("gujarati", 0x0A80), ("oriya", 0x0B00), ("tamil", 0x0B80), ("telugu", 0x0C00), ("kannada", 0x0C80),
    ("malayalam", 0x0D00), ("sinhala", 0x0D80), ("thai", 0x0E00), ("lao", 0x0E80), ("tibetan", 0x0F00), ("myanmar", 0x1000),
    ("georgian", 0x10A0), ("hangul", 0x1100), ("ethiopic", 0x1200), ("other", 0x13A0), ("latin", 0x1E00), ("greek", 0x1F00),
    ("other", 0x2000), ("kana", 0x3040), ("other", 0x3100), ("han", 0x3400), ("other", 0xA000), ("hangul", 0xAC00),
    ("other", 0xD7B0), ("han", 0xF900), ("other", 0xFB00), ("arabic", 0xFB50), ("other", 0xFE00), ("han", 0x20000), ("other", 0x32000),
]
_NAMES = sorted({name for name, _ in SCRIPTS})
_STARTS = np.array([start for _, start in SCRIPTS])
_SCRIPT_OF = np.array([_NAMES.index(name) for name, _ in SCRIPTS])

_U = np.uint64


def script_of(points: np.ndarray) -> np.ndarray:
    return _SCRIPT_OF[np.searchsorted(_STARTS, points, side="right") - 1]


def _words(column: pa.Array) -> tx.Words:
    points, offsets = tx.code_points(column)
    return tx.Words(tx.lower()[points], offsets, tx.letters())


def _grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the word, and bucket, of each n-gram of the words (UTF-32)."""
    lengths = np.array([len(w) // 4 for w in words], np.int64)
    place = tx.ragged(np.cumsum(lengths + 2) - lengths - 1, lengths)
    chars = np.zeros(int((lengths + 2).sum()), np.uint32)
    chars[place] = np.frombuffer(b"".join(words), np.uint32)
    owner = np.repeat(np.arange(len(words)), lengths + 2)
    value = tx.mix(chars.astype(_U) + _U(0x2545F491))
    code, owners, buckets = value, [], []
    for size in range(1, max(SIZES) + 1):
        if size > 1:
            code = code[:-1] * _U(0x9E3779B97F4A7C15) + value[size - 1 :]
        good = owner[: len(code)] == owner[size - 1 :]
        if size == 1:
            good = chars != 0
        owners.append(owner[: len(code)][good])
        buckets.append(tx.mix(code[good] + _U(size)) & _U(BUCKETS - 1))
    return np.concatenate(owners), np.concatenate(buckets).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    #: By bucket and language: log-probability less the languages' mean.
    weights: np.ndarray
    #: By script and language: whether the language uses the script.
    uses: np.ndarray
    penalty: float = PENALTY

    def __post_init__(self):
        #: Scores of words seen before, by their place in ``scores``.
        self.known: dict[bytes, int] = {}
        self.scores = np.zeros((0, len(self.languages)))

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "scores": self.scores[:0]}

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """Each word's score under every language; minus infinity where its script excludes one, 0 if it excludes all."""
        scores = np.zeros((len(words), len(self.languages)))
        if not words:
            return scores
        script = script_of(np.array([int.from_bytes(w[:4], "little") for w in words]))
        for s in np.unique(script):
            own = np.flatnonzero(script == s)
            languages = np.flatnonzero(self.uses[s])
            if not len(languages):
                continue
            owner, bucket = _grams([words[i] for i in own])
            scores[own] = -np.inf
            scores[np.ix_(own, languages)] = np.stack([np.bincount(owner, self.weights[bucket, k], len(own)) for k in languages], 1)
        return scores

    def label(self, words: tx.Words) -> np.ndarray:
        """The language of each word."""
        coded = words.array().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > CACHE:
            self.known.clear()
            self.scores = self.scores[:0]
        fresh = [w for w in distinct if w not in self.known]
        if fresh:
            self.known.update(zip(fresh, range(len(self.scores), len(self.scores) + len(fresh)), strict=True))
            self.scores = np.concatenate([self.scores, self.word_scores(fresh)])
        place = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return viterbi(self.scores, place[coded.indices.to_numpy()], words.first, self.penalty)


def viterbi(table: np.ndarray, index: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each item; sequences ``first[i]:first[i+1]`` go in step, the longest first, so few steps see few of them."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, left = first[:-1][order], counts[order]
    order = None
    labels = table.shape[1]
    out = np.zeros(len(index), np.int64)
    if not len(index):
        return out
    longest = int(left[0])
    active = np.searchsorted(-left, -np.arange(1, longest + 1), side="right")  # sequences with more than t items
    came = np.zeros((len(index), labels), np.int8 if labels < 128 else np.int16 if labels < 32768 else np.int32)
    stay = np.arange(labels)
    value = table[index[begin[: active[0]]]].copy()
    final = np.zeros((active[0], labels))
    for t in range(1, longest):
        n = active[t]
        final[n : len(value)] = value[n:]
        value = value[:n]
        best = value.argmax(1)
        change = value[np.arange(n), best] - penalty
        keep = value >= change[:, None]
        came[begin[:n] + t] = np.where(keep, stay, best[:, None])
        value = np.where(keep, value, change[:, None]) + table[index[begin[:n] + t]]
    final[: len(value)] = value
    state = final.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        out[at] = state[:n]
        if t:
            state[:n] = came[at, state[:n]]
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            words = _words(batch.column("text"))
            if not len(words):
                continue
            langs = batch.column("lang").dictionary_encode()
            n_langs = len(langs.dictionary)
            lang = langs.indices.to_numpy()[words.text_of()]
            coded = words.array().dictionary_encode()
            word = coded.indices.to_numpy()
            used, number = np.unique(word * n_langs + lang, return_counts=True)
            own = coded.dictionary.to_pylist()
            owner, bucket = _grams(own)
            edge = np.searchsorted(owner[np.argsort(owner, kind="stable")], np.arange(len(own) + 1))
            bucket = bucket[np.argsort(owner, kind="stable")]
            w, k = used // n_langs, used % n_langs
            size = edge[w + 1] - edge[w]
            at = bucket[tx.ragged(edge[w], size)]
            sums = np.bincount(np.repeat(k, size) * (BUCKETS + 64) + at, np.repeat(number, size), n_langs * (BUCKETS + 64))
            script = script_of(np.array([int.from_bytes(x[:4], "little") for x in own]))
            sums += np.bincount(k * (BUCKETS + 64) + BUCKETS + script[w], number, len(sums))
            hit = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(hit // (BUCKETS + 64))).cast(pa.string()), pa.array((hit % (BUCKETS + 64)).astype(np.int32)), pa.array(sums[hit].astype(np.int64))],
                names=["lang", "bucket", "n"],
            )


def train(docs: DataFrame, sample: int = SAMPLE, penalty: float = PENALTY, script_share: float = SCRIPT_SHARE) -> Model:
    """Fit on the texts of ``docs(doc_id, text, lang)``."""
    spark = docs.sparkSession
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text", F.xxhash64("text").alias("_h"))
    # a share of each language that holds about four samples of its different documents, then the smallest hashes of that
    different = F.approx_count_distinct(F.xxhash64("doc_id", "_h"), 0.02)
    shares = known.groupBy("lang").agg(F.least(F.lit(1.0), 4.0 * sample / different).alias("_share"))
    draw = F.pmod(F.xxhash64("doc_id", "_h"), F.lit(1 << 30)) / float(1 << 30)
    few = known.select("doc_id", "lang", "_h").join(F.broadcast(shares), "lang").where(draw < F.col("_share")).dropDuplicates(["doc_id", "lang", "_h"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(draw, "doc_id", "_h"))
    chosen = few.withColumn("_r", rank).where(F.col("_r") <= sample).select("doc_id", "lang", "_h")  # at most ``sample`` ids a language
    texts = known.join(F.broadcast(chosen), ["doc_id", "lang", "_h"]).select("lang", "text")
    texts = materialize(texts.repartition(2 * spark.sparkContext.defaultParallelism), "langid-sample")
    counts = tx.map_arrow(texts, _count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    table = np.zeros((len(languages), BUCKETS + 64))
    number = {x: i for i, x in enumerate(languages)}
    table[counts["lang"].map(number).to_numpy(int), counts["bucket"].to_numpy(int)] = counts["n"]
    grams, scripts = table[:, :BUCKETS] + 0.5, table[:, BUCKETS : BUCKETS + len(_NAMES)]
    weights = np.log(grams / grams.sum(1, keepdims=True)).T if len(languages) else np.zeros((BUCKETS, 0))
    if len(languages):
        weights -= weights.mean(1, keepdims=True)
    uses = (scripts > script_share * scripts.sum(1, keepdims=True)).T
    return Model(languages, weights.astype(np.float32), uses, penalty)


def _predict(batches: Iterator[pa.RecordBatch], model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    model = model.value
    names = np.array([*model.languages, UNKNOWN], object)
    k = len(model.languages)
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            words = _words(batch.column("text"))
            n = batch.num_rows
            best, share, spans = np.full(n, k), np.zeros(n), [[] for _ in range(n)]
            if len(words) and k:
                label = model.label(words)
                size = words.ends - words.starts
                owner = words.text_of()
                mass = np.bincount(owner * k + label, size, n * k).reshape(n, k)
                some = words.counts() > 0
                best = np.where(some, mass.argmax(1), k)
                share = np.where(some, mass.max(1) / np.maximum(mass.sum(1), 1), 0.0)
                fresh = np.ones(len(label), bool)
                fresh[1:] = (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])
                begin = np.flatnonzero(fresh)
                end = np.append(begin[1:], len(label)) - 1
                base = words.offsets[owner[begin]]
                for t, a, b, lang in zip(owner[begin], words.starts[begin] - base, words.ends[end] - base, names[label[begin]], strict=True):
                    spans[t].append({"start": int(a), "stop": int(b), "lang": lang})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[best], pa.string()), pa.array(share), pa.array(spans, schema.field(len(schema) - 1).type)], names=schema.names
            )


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("lang", T.StringType())]))


def identify(docs: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``lang_spans`` (code points) behind its columns."""
    added = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("lang_spans", SPANS)]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(prefix + n, t) for n, t in added)])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return tx.map_arrow(docs, lambda b: _predict(b, shared, arrow), schema)
