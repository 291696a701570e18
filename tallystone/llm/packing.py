r"""Harmonic packing of tokenized documents into sequences.

A document's ids are those of a byte-level BPE tokenizer, then ``end``. Piece lengths come from the reciprocals of
the capacity C only: floor(C / k) for k = 1, 2, 3, ... A document is cut greedily: the longest such length that fits
into what is left of it. Pieces of length floor(C / k) form class k, whose bins take exactly k pieces and are then
full up to C mod length. Every task fills its classes' bins on its own; the pieces of the bins that are unfinished
when its input ends (fewer than k of each class) share bins by first fit, the longest first.

Pre-tokens are found with numpy for whole slices of text: the tokenizer's pattern is a matter of character classes
and runs; the classes are the tokenizer's own. Only distinct pre-tokens go through the tokenizer's merges; a worker keeps them until they are more than ``CACHE``.

Added tokens of the tokenizer (``<|endoftext|>``) are found in a text first, as the tokenizer does; each is its one id.
Cases: null text is empty, which is the one id ``end``;
repeated rows are packed each; a null doc_id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm import text as tx

CAPACITY = 2048
END = 1
CACHE = 300_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_LETTER, _NUMBER, _OTHER, _SPACE = 0, 1, 2, 3


class Classes:
    r"""By code point: letter, number, white space or other, as the tokenizer's own Unicode tables have it.

    A code point is asked for when a text first holds it: behind ``a`` a letter starts no piece, behind ``1`` a number.
    """

    _UNKNOWN = 255

    def __init__(self, splitter):
        self.splitter = splitter
        self.kinds = np.full(0x110000, self._UNKNOWN, np.uint8)
        # white space doesn't change between versions of Unicode
        spaces = [c for c in range(0x3001) if c in (9, 10, 11, 12, 13, 0x85) or unicodedata.category(chr(c))[0] == "Z"]
        self.kinds[spaces] = _SPACE

    def _joined(self, lead: str, points: list[int]) -> np.ndarray:
        starts = {a for _, (a, _) in self.splitter.pre_tokenize_str("".join(f"{lead}{chr(c)}\n" for c in points))}
        return np.array([3 * i + 1 not in starts for i in range(len(points))], bool)

    def of(self, points: np.ndarray) -> np.ndarray:
        found = self.kinds[points]
        new = np.unique(points[found == self._UNKNOWN])
        if not len(new):
            return found
        asked = new.tolist()
        self.kinds[new] = np.where(self._joined("a", asked), _LETTER, np.where(self._joined("1", asked), _NUMBER, _OTHER))
        return self.kinds[points]


def pretokens(points: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
    r"""Starts of the pieces of ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``, by text. ``kind``: classes of the points."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    opens = np.zeros(n, bool)
    opens[offsets[:-1][np.diff(offsets) > 0]] = True
    closes = np.zeros(n, bool)
    closes[:-1] = opens[1:]
    closes[-1] = True
    before = np.empty(n, np.uint8)
    before[0] = 255
    before[1:] = kind[:-1]
    before[opens] = 255
    after = np.empty(n, np.uint8)
    after[:-1] = kind[1:]
    after[closes] = 255
    space = kind == _SPACE
    blank = points == 32
    led = np.zeros(n, bool)  # has a blank before it that belongs to its piece
    led[1:] = blank[:-1]
    led &= ~opens & ~space
    start = np.where(space, (before != _SPACE) | ((after != _SPACE) & (after != 255)), (before != kind) & ~led)
    # contractions: an apostrophe that starts a piece, and certain letters behind it
    quote = np.flatnonzero((points == 39) & start)
    if len(quote):
        ends = np.append(np.flatnonzero(opens), n)
        left = ends[np.searchsorted(ends, quote, side="right")] - quote
        ahead = np.concatenate([points, [0, 0]])
        a = np.where(left > 1, ahead[quote + 1], 0)
        b = np.where(left > 2, ahead[quote + 2], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        size = np.where(one, 2, np.where(two, 3, 0))
        start[quote[size > 0] + 1] = False
        follow = quote[size > 0] + size[size > 0]
        start[follow[(follow < n)]] = True
        fix = follow[follow < n]
        # a blank or other white space behind keeps its own rule; a run of letters goes on as a new piece
        start[fix[space[fix]]] = ((before[fix] != _SPACE) | ((after[fix] != _SPACE) & (after[fix] != 255)))[space[fix]]
    return np.flatnonzero(start)


@lru_cache(2)
def _tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of many texts at once, equal to those of ``tokenizers`` for each text."""

    def __init__(self, path: str):
        whole = _tokenizer(path)
        self.model = whole.model
        self.classes = Classes(whole.pre_tokenizer)
        added = whole.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError("added tokens of whole words, or that take white space with them, are not supported")
        self.added = {t.content: i for i, t in added.items()}
        #: Of added tokens that start at the same place, the longest.
        self.marks = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names, extra = {b: chr(b) for b in printable}, 256
        for b in range(256):
            if b not in names:
                names[b] = chr(extra)
                extra += 1
        #: The character that the merges know each byte by.
        self.alias = np.array([ord(names[b]) for b in range(256)], np.uint32)
        #: Of a piece, where its ids start in ``ids`` and how many they are: ``start << 16 | count``.
        self.known: dict[bytes, int] = {}
        self.ids = array("I")
        self.long: dict[bytes, tuple[int, int]] = {}

    def places(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """For each of some distinct pieces its place among, and the number of, ``ids``."""
        _, offsets, data = pieces.buffers()
        edge = np.frombuffer(offsets, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1].tolist()
        raw = data.to_pybytes()
        known, ids, tokenize = self.known, self.ids, self.model.tokenize
        if len(known) > CACHE:
            known.clear()
            self.long.clear()
            del ids[:]
        alias = None
        place = np.zeros(len(pieces), np.int64)
        for i, (a, b) in enumerate(zip(edge, edge[1:])):  # noqa: B905, RUF007
            piece = raw[a:b]
            found = known.get(piece)
            if found is None:
                if alias is None:
                    alias = self.alias[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-32-le")
                own = [t.id for t in tokenize(alias[a:b])]
                if len(own) > 0xFFFF:
                    # too long for the packed form: a place of its own, found again next time
                    self.long[piece] = len(ids), len(own)
                found = len(ids) << 16 | min(len(own), 0xFFFF)
                ids.extend(own)
                known[piece] = found
            place[i] = found
        size = place & 0xFFFF
        place >>= 16
        for i in np.flatnonzero(size == 0xFFFF):
            place[i], size[i] = self.long.get(raw[edge[i] : edge[i + 1]], (place[i], size[i]))
        return place, size

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and the offsets of the texts."""
        if not any(pc.any(pc.match_substring(column, t)).as_py() for t in self.added):
            return self._encode(column)
        parts, first, marks, at = [], [0], [], []
        for text in column.to_pylist():
            for i, part in enumerate(self.marks.split(text or "")):
                if i % 2:
                    marks.append(self.added[part])
                    at.append(len(parts))
                else:
                    parts.append(part)
            first.append(len(parts))
        ids, offsets = self._encode(pa.array(parts, pa.large_string()))
        # a mark comes before the part that follows it
        before = np.searchsorted(at, first)
        return np.insert(ids, offsets[at], np.array(marks, np.uint32)), offsets[first] + before

    def _encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of texts without added tokens."""
        raw, byte_offsets = tx.utf8(column)
        points, offsets = tx.code_points(column)
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        start = pretokens(points, offsets, self.classes.of(points))
        edge = np.append(lead[start], len(raw)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(edge), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = pieces.dictionary_encode()
        place, size = self.places(coded.dictionary)
        flat = np.array(self.ids, np.uint32)
        index = coded.indices.to_numpy()
        many = size[index]
        ids = flat[tx.ragged(place[index], many)]
        total = np.zeros(len(start) + 1, np.int64)
        np.cumsum(many, out=total[1:])
        return ids, total[np.searchsorted(start, offsets)]


@lru_cache(8)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


class Packer:
    """The bins of one task."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity = capacity
        self.lengths = np.unique([capacity // k for k in range(1, capacity + 1)])
        self.open: dict[int, list] = defaultdict(list)
        self.next_id = first_id
        self.out: list[tuple] = []

    def cut(self, n: int) -> list[int]:
        found = [self.capacity] * (n // self.capacity)
        n %= self.capacity
        while n:
            length = int(self.lengths[np.searchsorted(self.lengths, n, side="right") - 1])
            found.append(length)
            n -= length
        return found

    def add(self, piece: tuple, length: int) -> None:
        held = self.open[length]
        held.append(piece)
        if len(held) == self.capacity // length:
            self._close([(p, length) for p in held])
            held.clear()

    def _close(self, pieces: list[tuple[tuple, int]]) -> None:
        offset = 0
        for piece, length in pieces:
            self.out.append((*piece, self.next_id, offset))
            offset += length
        self.next_id += 1

    def finish(self) -> None:
        bins: list[list] = []
        room: list[int] = []
        for length in sorted(self.open, reverse=True):
            for piece in self.open[length]:
                for i, r in enumerate(room):
                    if r >= length:
                        break
                else:
                    i = len(bins)
                    bins.append([])
                    room.append(self.capacity)
                bins[i].append((piece, length))
                room[i] -= length
        self.open.clear()
        for b in bins:
            self._close(b)

    def take(self) -> list[tuple]:
        found, self.out = self.out, []
        return found


def _pack(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path)
    packer = Packer(capacity, TaskContext.get().partitionId() << 40)
    names = [c.split()[0] for c in PIECES.split(", ")]

    def rows() -> pa.RecordBatch:
        found = packer.take()
        columns = list(zip(*found, strict=True)) or [()] * (8 if with_ids else 7)
        arrays = [pa.array(columns[i], pa.int64()) for i in range(5)]
        arrays += [pa.array(columns[-2], pa.int64()), pa.array(columns[-1], pa.int64())]
        if with_ids:
            return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[5], pa.list_(pa.int32()))], names=[*names, "ids"])
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for whole in batches:
        for batch in tx.slices(whole, "text"):
            ids, offsets = encoder.encode(batch.column("text"))
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                own = np.append(ids[a:b], np.uint32(end)).astype("<u4")
                start = 0
                for length in packer.cut(len(own)):
                    part = own[start : start + length]
                    piece = (doc, start, length, zlib.crc32(part.tobytes()), len(own))
                    packer.add((*piece, part.astype(np.int32)) if with_ids else piece, length)
                    start += length
            yield rows()
    packer.finish()
    yield rows()


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece of each row of ``docs(doc_id, text)``; ``with_ids`` adds the piece's ids."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return tx.map_arrow(rows, lambda b: _pack(b, tokenizer, capacity, end, with_ids), PIECES + ", ids array<int>" * with_ids)
