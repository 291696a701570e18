r"""Benchmark decontamination with one FM-index per training shard.

Texts are lower-cased (A-Z only) and cut into words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``. A window is ``window``
consecutive words of a benchmark item; an item of fewer words, but not none, is one window. Each shard (a slice of
a partition) is indexed over the words that the benchmark knows: maximal runs of such words, at least as long as
the shortest window, are the indexed text, as no other word lies in an occurrence. All windows are searched at once,
backwards, through the ranks of a wavelet matrix over the Burrows-Wheeler transform; the rows found are located by
walking to sampled suffix positions; the word ranges they cover are merged into removal spans.

A benchmark of at most ``block_bytes`` of text is one broadcast, and documents are read once. A larger one is taken in
blocks of that size: for each in turn the documents' texts are searched, what is found is written (by hash of the
text), and the block is given up; then hits and items of all blocks are merged. So neither the driver nor an executor
holds more than one block (or one longer item) at once.

Cases: null or wordless texts have no words, no hits and no items, and are not contaminated; null item ids are not
listed among items, but their windows count as hits; repeated items count once; repeated documents each get their
row; empty tables give no rows or no hits. Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallystone.llm import text as tx
from tallystone.llm.storage import discard, materialize

WINDOW = 13
#: Texts of one FM-index.
SHARD_BYTES = 6_000_000
BLOCK_BYTES = 8_000_000
RESULT = [
    ("n_words", T.LongType()),
    ("n_hit", T.LongType()),
    ("n_items", T.LongType()),
    ("items_sha256", T.StringType()),
    ("contaminated", T.BooleanType()),
    ("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
]


class WaveletMatrix:
    """Ranks of any symbol in a sequence, by one bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.zeros, self.ones = [], []
        for level in reversed(range(self.bits)):
            bit = (symbols >> level) & 1
            ranks = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ranks[1:])
            self.ones.append(ranks)
            self.zeros.append(len(symbols) - int(ranks[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbols: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the position beside it."""
        low, high = np.zeros_like(positions), positions
        for level, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros, strict=True):
            bit = ((symbols >> level) & 1).astype(bool)
            low = np.where(bit, zeros + ones[low], low - ones[low])
            high = np.where(bit, zeros + ones[high], high - ones[high])
        return high - low

    def access(self, positions: np.ndarray) -> np.ndarray:
        found = np.zeros_like(positions)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            bit = ones[positions + 1] - ones[positions]
            found = found * 2 + bit
            positions = np.where(bit == 1, zeros + ones[positions], positions - ones[positions])
        return found


class FMIndex:
    """Index of runs of symbols 1..sigma-1; a run never matches into the next."""

    def __init__(self, symbols: np.ndarray, run_starts: np.ndarray, run_lengths: np.ndarray, sigma: int, sample: int = 8):
        runs = len(run_starts)
        n = len(symbols) + runs
        first = run_starts + np.arange(runs)  # where each run starts once every run has a separator behind it
        text = np.zeros(n, np.int64)
        where = tx.ragged(first, run_lengths)
        text[where] = symbols[tx.ragged(run_starts, run_lengths)]
        self.source = np.full(n, -1, np.int64)
        self.source[where] = np.arange(len(where))
        # separators sort before all words and among themselves by place: every suffix differs within its run
        rank = text + runs - 1
        rank[text == 0] = np.arange(runs)
        step, longest = 1, int(run_lengths.max()) + 1
        while step < longest:
            key = rank * (n + sigma + runs)
            key[: n - step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            fresh = np.empty(n, np.int64)
            fresh[0] = 0
            np.cumsum(sorted_key[1:] != sorted_key[:-1], out=fresh[1:])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            step *= 2
            if fresh[-1] == n - 1:
                break
        suffixes = np.argsort(rank, kind="stable")
        transform = text[suffixes - 1]
        self.before = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=sigma), out=self.before[1:])
        self.wavelet = WaveletMatrix(transform, sigma)
        # sampled rows: each run's start, and every few words of it
        kept = np.zeros(n, bool)
        kept[first] = True
        kept[where[(where - np.repeat(first, run_lengths)) % sample == 0]] = True
        self.sampled = kept[suffixes]
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = suffixes[self.sampled]
        self.n = n

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that start with each of the patterns (all of one length)."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n, np.int64)
        for k in reversed(range(patterns.shape[1])):
            c = patterns[:, k]
            low, high = self.before[c] + self.wavelet.rank(c, low), self.before[c] + self.wavelet.rank(c, high)
            high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places, in the symbols given, of the suffixes in these rows."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.sampled[rows])
        while len(todo):
            at = rows[todo]
            c = self.wavelet.access(at)
            rows[todo] = self.before[c] + self.wavelet.rank(c, at)
            steps[todo] += 1
            todo = todo[~self.sampled[rows[todo]]]
        return self.source[self.samples[self.sample_rank[rows]] + steps]


class Patterns:
    """The distinct windows of a block of benchmark items over the block's own vocabulary."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        names = [None if i is None else str(i) for i, _ in items]
        words = tx.Words(*_lower(pa.array([t for _, t in items], pa.string())), tx.ALNUM)
        coded = words.array().dictionary_encode()
        self.vocabulary = coded.dictionary
        ids = coded.indices.to_numpy().astype(np.int64) + 1
        counts = words.counts()
        by_length: dict[int, tuple[list, list]] = {}
        for k in np.flatnonzero(counts):
            own = ids[words.first[k] : words.first[k + 1]]
            length = min(window, len(own))
            rows, of = by_length.setdefault(length, ([], []))
            rows.append(np.lib.stride_tricks.sliding_window_view(own, length))
            of.append(np.full(len(own) - length + 1, k))
        self.names = np.array(sorted({x for x in names if x is not None}), object)
        number = {x: i for i, x in enumerate(self.names)}
        item = np.array([number.get(x, -1) for x in names], np.int64)
        #: By length: distinct windows; and the items of each, as offsets and item numbers.
        self.groups = []
        for rows, of in by_length.values():
            unique, inverse = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([inverse.reshape(-1), item[np.concatenate(of)]], 1), axis=0)
            self.groups.append((unique, np.searchsorted(pairs[:, 0], np.arange(len(unique) + 1)), pairs[:, 1]))

    def items_of(self, windows: np.ndarray) -> np.ndarray:
        """Sorted names of the items that hold any of these windows (numbered through all groups)."""
        found, base = [np.zeros(0, np.int64)], 0
        for unique, offsets, item in self.groups:
            own = windows[(windows >= base) & (windows < base + len(unique))] - base
            found.append(np.unique(item[tx.ragged(offsets[own], offsets[own + 1] - offsets[own])]))
            base += len(unique)
        numbers = np.unique(np.concatenate(found))
        return self.names[numbers[numbers >= 0]]

    def shortest(self) -> int:
        return min((unique.shape[1] for unique, _, _ in self.groups), default=0)


def _lower(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = tx.utf8(column)
    return tx.ascii_lower(raw), offsets


def find(words: tx.Words, patterns: Patterns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences in a shard: first word and length of each, and the distinct pairs (text, window number) they make."""
    none = np.zeros(0, np.int64)
    if not len(words) or not patterns.groups:
        return none, none, np.zeros((0, 2), np.int64)
    import pyarrow.compute as pc

    known = pc.fill_null(pc.index_in(words.array(), value_set=patterns.vocabulary), -1).to_numpy() + 1
    inside = known > 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    starts_text = words.first[:-1][words.counts() > 0]
    opens[starts_text] = inside[starts_text]
    closes = np.ones(len(inside), bool)
    closes[:-1] = opens[1:] | ~inside[1:]
    starts = np.flatnonzero(opens)
    lengths = np.flatnonzero(inside & closes) + 1 - starts
    keep = lengths >= patterns.shortest()
    starts, lengths = starts[keep], lengths[keep]
    if not len(starts):
        return none, none, np.zeros((0, 2), np.int64)
    place = tx.ragged(starts, lengths)
    index = FMIndex(known[place].astype(np.int64), np.cumsum(lengths) - lengths, lengths, len(patterns.vocabulary) + 1)
    text_of = words.text_of()
    at, size, pairs = [none], [none], [np.zeros((0, 2), np.int64)]
    base = 0
    for unique, _, _ in patterns.groups:
        low, high = index.search(unique)
        count = high - low
        found = place[index.locate(tx.ragged(low, count))]
        at.append(found)
        size.append(np.full(len(found), unique.shape[1], np.int64))
        pairs.append(np.unique(np.stack([text_of[found], base + np.repeat(np.arange(len(unique)), count)], 1), axis=0))
        base += len(unique)
    pairs = np.concatenate(pairs)
    return np.concatenate(at), np.concatenate(size), pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]


def hits(words: tx.Words, patterns: Patterns) -> tuple[np.ndarray, list[np.ndarray]]:
    """Whether each word of a shard is hit; and the item names of each text (one array for texts with equal windows)."""
    at, size, pairs = find(words, patterns)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    edge = np.searchsorted(pairs[:, 0], np.arange(len(words.first)))
    seen: dict[bytes, np.ndarray] = {}
    names = []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        own = np.ascontiguousarray(pairs[a:b, 1])
        key = own.tobytes()
        if key not in seen:
            seen[key] = patterns.items_of(own)
        names.append(seen[key])
    return np.cumsum(change[:-1]) > 0, names


def _result(words: tx.Words, hit: np.ndarray, names: list, spans: pa.DataType) -> list[pa.Array]:
    total = np.concatenate([[0], np.cumsum(hit)])
    n_words = words.counts()
    n_hit = total[words.first[1:]] - total[words.first[:-1]]
    found = [_spans(hit[a:b]) if k else [] for a, b, k in zip(words.first[:-1], words.first[1:], n_hit, strict=True)]
    digest = {id(x): hashlib.sha256(",".join(x).encode()).hexdigest() for x in {id(x): x for x in names}.values()}
    return [
        pa.array(n_words, pa.int64()),
        pa.array(n_hit, pa.int64()),
        pa.array([len(x) for x in names], pa.int64()),
        pa.array([digest[id(x)] for x in names], pa.string()),
        pa.array((n_hit > 0) & (20 * n_hit >= n_words), pa.bool_()),
        pa.array(found, spans),
    ]


def _scan(batches: Iterator[pa.RecordBatch], column: str, block, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, column, SHARD_BYTES):
            words = tx.Words(*_lower(batch.column(column)), tx.ALNUM)
            hit, names = hits(words, block.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, *_result(words, hit, names, schema.field(len(schema) - 1).type)], names=schema.names)


def _scan_block(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    """Of the texts that hold windows of one block: their hash, spans of hit words, and item names."""
    for whole in batches:
        for batch in tx.slices(whole, "text", SHARD_BYTES):
            words = tx.Words(*_lower(batch.column("text")), tx.ALNUM)
            hit, names = hits(words, block.value)
            total = np.concatenate([[0], np.cumsum(hit)])
            some = np.flatnonzero(total[words.first[1:]] > total[words.first[:-1]])
            spans = [_spans(hit[words.first[i] : words.first[i + 1]]) for i in some]
            yield pa.RecordBatch.from_arrays(
                [batch.column("th").take(pa.array(some)), pa.array(spans, _SPANS), pa.array([names[i].tolist() for i in some], pa.list_(pa.string()))], names=["th", "spans", "items"]
            )


def _merge(batches: Iterator[pa.RecordBatch], column: str, spans: str, items: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, column, SHARD_BYTES):
            words = tx.Words(*_lower(batch.column(column)), tx.ALNUM)
            change = np.zeros(len(words) + 1, np.int64)
            names = []
            for first, own, listed in zip(words.first[:-1], batch.column(spans).to_pylist(), batch.column(items).to_pylist(), strict=True):
                for s in own or ():
                    change[first + s["start"]] += 1
                    change[first + s["stop"]] -= 1
                names.append(sorted(set(listed or ())))
            kept = [batch.column(i) for i, f in enumerate(batch.schema) if f.name not in (spans, items)]
            yield pa.RecordBatch.from_arrays([*kept, *_result(words, np.cumsum(change[:-1]) > 0, names, schema.field(len(schema) - 1).type)], names=schema.names)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _spans(hit: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [{"start": int(a), "stop": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _patterns(items: DataFrame, window: int):
    return items.sparkSession.sparkContext.broadcast(Patterns([tuple(r) for r in items.toLocalIterator()], window))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, prefix: str = "") -> DataFrame:
    """``docs`` with the columns of ``RESULT`` behind its own; ``prefix`` goes before their names where they would clash."""
    items = benchmark.select("item_id", "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-total // block_bytes))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(prefix + k, t) for k, t in RESULT)])
    arrow = to_arrow_schema(schema)
    if count == 1:
        block = _patterns(items, window)
        return tx.map_arrow(docs, lambda batches: _scan(batches, "text", block, arrow), schema)
    parts = []
    texts = docs.select(F.md5("text").alias("th"), "text")
    for b in range(count):
        block = _patterns(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b), window)
        found = tx.map_arrow(texts, lambda batches, block=block: _scan_block(batches, block), "th string, spans array<struct<start:long,stop:long>>, items array<string>")
        parts.append(materialize(found, "hits"))
        block.destroy()
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    # repeated texts find the same in a block, so a set of each keeps one
    own = tx.unclashing(docs.columns, ["th", "spans", "items"])
    merged = union.groupBy(F.col("th").alias(f"{own}th")).agg(F.flatten(F.collect_set("spans")).alias(f"{own}spans"), F.flatten(F.collect_set("items")).alias(f"{own}items"))
    merged = materialize(merged, "merged-hits")
    discard(*parts)
    joined = docs.join(merged, F.md5(docs["text"]) == merged[f"{own}th"], "left").drop(f"{own}th")
    return tx.map_arrow(joined, lambda batches: _merge(batches, "text", f"{own}spans", f"{own}items", arrow), schema)
