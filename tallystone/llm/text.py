"""Vectorised work on batches of texts: bytes, words, hashes. Everything here is numpy over UTF-8 bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Texts are handled in slices of about so many bytes, which bounds a worker's memory; one longer text is a slice alone.
SLICE_BYTES = 2_000_000

_U = np.uint64
#: Odd, so it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)

_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32


def byte_class(test) -> np.ndarray:
    return np.array([bool(test(b)) for b in range(256)])


#: Bytes of words ``[^\x20\x09-\x0D]+``.
NON_SPACE = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower case.
ALNUM = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed memory back to the system: Spark keeps a worker for later tasks, and with it what its allocators hold."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


#: Bytes of one Arrow batch to a Python worker, unless the session has a size of its own. Spark's own default of 64 MB
#: costs the executor some 200 MB a running task (a growing vector, its stream, the worker's copy) that help nothing here.
BATCH_BYTES = 8 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` in batches bounded by ``BATCH_BYTES``; a longer row is a batch alone."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY, None) is None:
        conf.set(_BATCH_KEY, f"{BATCH_BYTES}b")
    return df.mapInArrow(function, schema)


def unclashing(columns: list[str], names: list[str], prefix: str = "_") -> str:
    """The shortest run of ``prefix`` before ``names`` that makes none of them one of ``columns`` (in any case)."""
    taken, found = {c.lower() for c in columns}, prefix
    while any((found + name).lower() in taken for name in names):
        found += prefix
    return found


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each with about ``limit`` bytes of text at most, never fewer than one row."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    release()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    filled = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    _, offsets, data = filled.buffers()
    off = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def ascii_lower(raw: np.ndarray) -> np.ndarray:
    return _ASCII_LOWER[raw]


class Words:
    """The words of many texts: byte ranges ``starts``/``ends`` and, by text, ``first`` (len n+1) into them."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        inside = kind[raw]
        n = len(raw)
        before = np.zeros(n, bool)
        after = np.zeros(n, bool)
        if n:
            before[1:] = inside[:-1]
            after[:-1] = inside[1:]
            edges = offsets[(offsets > 0) & (offsets < n)]
            before[edges] = False
            after[edges - 1] = False
        self.raw = raw
        self.offsets = offsets
        self.inside = inside
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def array(self) -> pa.LargeBinaryArray:
        """The words themselves, in order."""
        kept = np.ascontiguousarray(self.raw[self.inside])
        offsets = np.zeros(len(self) + 1, np.int64)
        np.cumsum((self.ends - self.starts) * kept.itemsize, out=offsets[1:])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, the same in every process."""
        if not len(self):
            return np.zeros(0, _U)
        coded = self.array().dictionary_encode()
        table = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), _U, len(coded.dictionary))
        return table[coded.indices.to_numpy()]

    def text_of(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Rolling:
    """Hashes of any runs of consecutive items, from prefix sums modulo 2**64."""

    def __init__(self, items: np.ndarray):
        n = len(items)
        powers = np.full(n + 1, _BASE, _U)
        inverse = np.full(n + 1, _BASE_INV, _U)
        powers[0] = inverse[0] = 1
        np.cumprod(powers, out=powers)
        np.cumprod(inverse, out=inverse)
        self.inverse = inverse
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(mix(items + _U(0x632BE59BD9B4E019)) * powers[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, lengths) -> np.ndarray:
        ends = starts + lengths
        value = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(value + np.asarray(lengths, _U) * _U(0xD6E8FEB86659FD93))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges ``[start, start+length)``, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - shift, lengths)


_tables: dict[str, np.ndarray] = {}


def _table(name: str, build) -> np.ndarray:
    if name not in _tables:
        _tables[name] = build()
    return _tables[name]


def letters() -> np.ndarray:
    """By code point: whether it is a letter."""
    return _table("letters", lambda: np.array([chr(c).isalpha() for c in range(0x110000)], bool))


def lower() -> np.ndarray:
    """By code point: its lower case, where that is one code point."""

    def one(c: int) -> int:
        low = chr(c).lower()
        return ord(low) if len(low) == 1 else c

    return _table("lower", lambda: np.array([one(c) for c in range(0x110000)], np.uint32))


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of a string column and the offsets of its rows; null counts as empty."""
    raw, offsets = utf8(column)
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    count = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=count[1:])
    return points, count[offsets]
