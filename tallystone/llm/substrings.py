r"""Substring deduplication by seed and extend.

Words are ``[^\x20\x09-\x0D]+``, unchanged. A window is ``window`` (50) consecutive words of one document; a word goes
if a window over it has a word sequence that also starts in a document with a smaller doc_id.

Seeds: every window has one anchor, the smallest hash among its runs of ``anchor_words`` words (winnowing; the
leftmost on ties), so documents that share a window share its anchor. Consecutive windows with one anchor make one
*occurrence*, whose *region* is all words of these windows: the anchor extended to both sides as far as any of its
windows reaches. Documents are joined on anchors that at least two documents have.

Extension: an anchor is extended to the left by every number of words that a window allows, and by the rest of the
window to the right. Extensions are compared by hash, so that all documents of an anchor are compared at once instead
of in pairs. Occurrences of equal regions form a class, whose windows all repeat in the class's smallest document; that
settles the inside of every repeat. Only for anchors with several classes does one occurrence of each class (that of
its smallest document) list its windows, which are matched one by one: what matches there is where a maximal repeat
ends. Work and output grow with the number of occurrences, never with pairs. A document's overlapping matches are
merged into its maximal repeats (``repeats``: ranges of words, each of ``window`` words at least).

Cases: null or short texts have no window and lose nothing; rows with null doc_id neither remove nor lose words;
rows of one doc_id do not remove each other's words, and repeated rows get the same result each; an empty table gives
no rows; other columns pass through, whatever their names (added names get ``prefix``).
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

WINDOW = 50
ANCHOR_WORDS = 12
#: Bits that stand for all windows of an occurrence.
ALL = -1

_OCCURRENCE = "doc_id long, th long, start int, many int, anchor long, region long"
_WINDOW = "doc_id long, anchor long, region long, bit int, content long"


def occurrences(words: tx.Words, window: int, anchor_words: int) -> tuple[np.ndarray, ...]:
    """text, start (word within the slice), number of windows, anchor hash, region hash; and the rolling hashes."""
    hashes = words.hashes()
    n = len(hashes)
    counts = words.counts()
    rolling = tx.Rolling(hashes)
    none = np.zeros(0, np.int64)
    if not (counts >= window).any():
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), rolling
    grams = rolling.of(np.arange(n - anchor_words + 1), anchor_words)
    width = window - anchor_words + 1
    least, at, size = grams, np.arange(len(grams)), 1
    while size < width:
        step = min(size, width - size)
        a, b = least[:-step], least[step:]
        left = a <= b
        least, at = np.where(left, a, b), np.where(left, at[:-step], at[step:])
        size += step
    long = counts >= window
    starts = tx.ragged(words.first[:-1][long], counts[long] - window + 1)
    text = np.repeat(np.flatnonzero(long), counts[long] - window + 1)
    anchor = at[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(fresh)
    many = np.diff(np.append(begin, len(starts)))
    first = starts[begin]
    place = anchor[begin]
    shape = ((place - first) * 64 + many).astype(np.uint64)
    region = tx.mix(rolling.of(first, many + window - 1) ^ tx.mix(shape))
    return text[begin], first, many, grams[place], region, rolling


def _occur(batches: Iterator[pa.RecordBatch], window: int, anchor_words: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            words = tx.Words(*tx.utf8(batch.column("text")), tx.NON_SPACE)
            text, first, many, anchor, region, _ = occurrences(words, window, anchor_words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(text)),
                    batch.column("th").take(pa.array(text)),
                    pa.array((first - words.first[text]).astype(np.int32)),
                    pa.array(many.astype(np.int32)),
                    pa.array(anchor.view(np.int64)),
                    pa.array(region.view(np.int64)),
                ],
                names=["doc_id", "th", "start", "many", "anchor", "region"],
            )


def _windows(batches: Iterator[pa.RecordBatch], window: int, anchor_words: int) -> Iterator[pa.RecordBatch]:
    """The windows of the occurrences whose starts are listed beside each text."""
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            words = tx.Words(*tx.utf8(batch.column("text")), tx.NON_SPACE)
            text, first, many, anchor, region, rolling = occurrences(words, window, anchor_words)
            listed = batch.column("starts")
            owner = np.repeat(np.arange(batch.num_rows), listed.value_lengths().to_numpy(zero_copy_only=False))
            wanted = listed.flatten().to_numpy(zero_copy_only=False) + words.first[owner]
            pick = np.isin(first, wanted)
            text, first, many, anchor, region = text[pick], first[pick], many[pick], anchor[pick], region[pick]
            at = tx.ragged(first, many)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(np.repeat(text, many))),
                    pa.array(np.repeat(anchor, many).view(np.int64)),
                    pa.array(np.repeat(region, many).view(np.int64)),
                    pa.array((at - np.repeat(first, many)).astype(np.int32)),
                    pa.array(rolling.of(at, window).view(np.int64)),
                ],
                names=["doc_id", "anchor", "region", "bit", "content"],
            )


def keep_words(words: tx.Words, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of each text's words that stay, joined by one space: bytes and offsets."""
    raw = words.raw.copy()
    n = len(raw)
    stays = ~gone
    keep = words.inside.copy()
    keep[tx.ragged(words.starts[gone], (words.ends - words.starts)[gone])] = False
    kept = np.flatnonzero(stays)
    # a space behind each kept word but the last of its text; the byte there is a separator of the same text
    owner = words.text_of()[kept]
    inner = np.ones(len(kept), bool)
    if len(kept):
        inner[-1] = False
        inner[:-1] = owner[1:] == owner[:-1]
    space = words.ends[kept[inner]]
    raw[space] = 0x20
    keep[space] = True
    total = np.zeros(n + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    return raw[keep], total


def _strip(batches: Iterator[pa.RecordBatch], window: int, column: str, covers: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, column):
            raw, offsets = tx.utf8(batch.column(column))
            words = tx.Words(raw, offsets, tx.NON_SPACE)
            listed = batch.column(covers)
            sizes = listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            start, many, bits = (x.to_numpy(zero_copy_only=False) for x in listed.flatten().flatten())
            change = np.zeros(len(words) + 1, np.int64)
            base = words.first[owner] + start
            full = bits == ALL
            np.add.at(change, base[full], 1)
            np.add.at(change, base[full] + many[full] + window - 1, -1)
            for j in range(int(many[~full].max(initial=0))):
                on = ~full & ((bits >> j) & 1 == 1)
                np.add.at(change, base[on] + j, 1)
                np.add.at(change, base[on] + j + window, -1)
            gone = np.cumsum(change[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            removed = total[words.first[1:]] - total[words.first[:-1]]
            # repeats end with their document
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            firsts = words.first[:-1][words.counts() > 0]
            opens[firsts] = gone[firsts]
            closes = gone.copy()
            closes[:-1] &= ~gone[1:] | opens[1:]
            begin, stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
            at = np.searchsorted(begin, words.first)
            base = np.repeat(words.first[:-1], np.diff(at))
            spans = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(stop - base)], names=["start", "stop"])
            data, place = keep_words(words, gone)
            data = data.tobytes()
            texts = [data[a:b] for a, b in zip(place[offsets[:-1]], place[offsets[1:]], strict=True)]
            added = [
                pa.array(words.counts(), pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                pa.array(texts, pa.binary()).cast(pa.string()),
                pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), spans).cast(schema.field(len(schema) - 1).type),
            ]
            kept = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != covers]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=schema.names)


def covers(docs: DataFrame, window: int = WINDOW, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """``doc_id, th, _covers``: the repeated windows of each document (``th``: hash of its text)."""
    if not 0 < anchor_words <= window < anchor_words + 62:
        raise ValueError("an anchor must fit into a window, and an occurrence's windows into 62 bits")
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    found = tx.map_arrow(texts, lambda b: _occur(b, window, anchor_words), _OCCURRENCE)
    # seeds: anchors of at least two documents
    # tables of their own, so that both sides of the joins below are plain exchanges, whose hot keys can be split
    shared = found.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor")
    shared = materialize(shared, "anchors")
    seeds = materialize(found.join(shared, "anchor", "left_semi"), "seeds")
    classes = materialize(seeds.groupBy("anchor", "region").agg(F.min(F.struct("doc_id", "th", "start")).alias("rep")), "regions")
    several = materialize(classes.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "several")
    reps = classes.join(several, "anchor", "left_semi").groupBy("rep.doc_id", "rep.th").agg(F.collect_set("rep.start").alias("starts"))
    listed = texts.join(reps, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"]).select("doc_id", "text", "starts")
    windows = materialize(tx.map_arrow(listed, lambda b: _windows(b, window, anchor_words), _WINDOW), "windows")
    least = windows.groupBy("anchor", "content").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor", "content", "lo")
    least = materialize(least, "least")
    ends = (
        windows.join(least, ["anchor", "content"])
        .where("lo < doc_id")
        .groupBy("anchor", "region")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )
    settled = classes.select("anchor", "region", F.col("rep.doc_id").alias("lo")).join(ends, ["anchor", "region"], "left")
    settled = materialize(settled, "classes")
    discard(shared, classes, several, windows, least)
    found = (
        seeds.join(settled, ["anchor", "region"])
        .withColumn("bits", F.when(F.col("doc_id") > F.col("lo"), F.lit(ALL).cast("long")).otherwise(F.col("bits")))
        .where("bits IS NOT NULL")
        .groupBy("doc_id", "th")
        .agg(F.collect_set(F.struct("start", "many", "bits")).alias("_covers"))
    )
    found = materialize(found, "covers")
    discard(seeds, settled)
    return found


def dedup_substrings(docs: DataFrame, window: int = WINDOW, anchor_words: int = ANCHOR_WORDS, prefix: str = "") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``kept_sha256``, ``kept_text`` and ``repeats`` behind its columns."""
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    added = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_sha256", T.StringType()), ("kept_text", T.StringType()), ("repeats", spans)]
    own = tx.unclashing(docs.columns, ["doc", "th", "covers"])
    found = covers(docs, window, anchor_words).select(F.col("doc_id").alias(f"{own}doc"), F.col("th").alias(f"{own}th"), F.col("_covers").alias(f"{own}covers"))
    same = (docs["doc_id"] == found[f"{own}doc"]) & (F.xxhash64(docs["text"]) == found[f"{own}th"])
    joined = docs.join(found, same, "left").drop(f"{own}doc", f"{own}th")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(prefix + k, t) for k, t in added)])
    arrow = to_arrow_schema(schema)
    return tx.map_arrow(joined, lambda b: _strip(b, window, "text", f"{own}covers", arrow), schema)
