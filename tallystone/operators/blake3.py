"""BLAKE3 content ids: a Merkle tree over chunks of 1 KiB, all chunks of a batch compressed at once in numpy.

Chunks are independent, so a batch of contents of any lengths is one array of chunks, and each level of all their trees is
one array of parents. Pieces of ``2**k`` chunks are whole subtrees: frames of one file are hashed by different tasks, and a
file's id is folded from 32 bytes a piece (``pieces``, ``root``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the function: initial words, order of message words in the next round, flags.
IV = np.array([0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19], np.uint32)
PERMUTATION = [2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8]
START, END, PARENT, ROOT = 1, 2, 4, 8

CHUNK = 1024
BLOCK = 64
#: Bytes of a piece: any power of two of chunks will do; frames must be whole pieces.
PIECE = 2 << 20
#: Chunks compressed at once: their states stay in a core's cache.
SLAB = 4096


def _schedule() -> list[list[int]]:
    rounds = [list(range(16))]
    for _ in range(6):
        rounds.append([rounds[-1][i] for i in PERMUTATION])
    return rounds


_ROUNDS = [(np.array(r[0:8:2]), np.array(r[1:8:2]), np.array(r[8::2]), np.array(r[9::2])) for r in _schedule()]


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def _mix(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple:
    """Four quarters at once: each argument has a row for each."""
    a = a + b + x
    d = _turn(d ^ a, 16)
    c = c + d
    b = _turn(b ^ c, 12)
    a = a + b + y
    d = _turn(d ^ a, 8)
    c = c + d
    return a, _turn(b ^ c, 7), c, d


def _shift(x: np.ndarray, n: int) -> np.ndarray:
    return x[[(i + n) % 4 for i in range(4)]]


def compress(values: np.ndarray, words: np.ndarray, counters: np.ndarray, lengths: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """New chaining values (8, n) of n independent blocks: ``values`` (8, n), ``words`` (16, n), the rest (n)."""
    n = words.shape[1]
    a, b = values[:4], values[4:]
    c = np.repeat(IV[:4, None], n, axis=1)
    d = np.stack([counters.astype(np.uint32), (counters >> np.uint64(32)).astype(np.uint32), lengths.astype(np.uint32), flags.astype(np.uint32)])
    for one, two, three, four in _ROUNDS:
        a, b, c, d = _mix(a, b, c, d, words[one], words[two])
        # the diagonals, as columns
        a, b, c, d = _mix(a, _shift(b, 1), _shift(c, 2), _shift(d, 3), words[three], words[four])
        b, c, d = _shift(b, 3), _shift(c, 2), _shift(d, 1)
    return np.concatenate([a ^ c, b ^ d])


def _chunks(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, counters: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Chaining values (8, n) of chunks ``raw[start : start + size]``; ``last``: flag of the chunk's last block."""
    out = np.empty((8, len(starts)), np.uint32)
    for k in range(0, len(starts), SLAB):
        start, size, counter, root = starts[k : k + SLAB], sizes[k : k + SLAB], counters[k : k + SLAB], last[k : k + SLAB]
        n = len(start)
        padded = np.zeros((n, CHUNK), np.uint8)
        full = size == CHUNK
        padded[full] = raw[start[full][:, None] + np.arange(CHUNK)]
        for i in np.flatnonzero(~full):
            padded[i, : size[i]] = raw[start[i] : start[i] + size[i]]
        words = np.ascontiguousarray(padded.view("<u4").astype(np.uint32, copy=False).reshape(n, 16, 16).transpose(1, 2, 0))
        blocks = np.maximum(1, -(-size // BLOCK))
        values = np.repeat(IV[:, None], n, axis=1)
        for block in range(int(blocks.max())):
            on = slice(None) if block == 0 or full.all() else np.flatnonzero(blocks > block)
            ends = blocks[on] == block + 1
            flags = np.where(ends, END | root[on], 0) | (START if block == 0 else 0)
            lengths = np.where(ends, size[on] - BLOCK * block, BLOCK)
            values[:, on] = compress(values[:, on], words[block][:, on], counter[on], lengths, flags)
        out[:, k : k + SLAB] = values
    return out


def _parents(left: np.ndarray, right: np.ndarray, root: np.ndarray) -> np.ndarray:
    n = left.shape[1]
    values = np.repeat(IV[:, None], n, axis=1)
    return compress(values, np.concatenate([left, right]), np.zeros(n, np.uint64), np.full(n, BLOCK), PARENT | root)


def _folded(values: np.ndarray, counts: np.ndarray, rooted: np.ndarray) -> np.ndarray:
    """One value for each run of ``counts`` neighbours: pairs from the left, an odd one goes up as it is."""
    while (counts > 1).any():
        ends = np.cumsum(counts)
        starts = ends - counts
        place = np.arange(int(ends[-1])) - np.repeat(starts, counts)
        many = np.repeat(counts, counts)
        pairs = np.flatnonzero((place % 2 == 0) & (place + 1 < many))
        lone = np.flatnonzero((place % 2 == 0) & (place + 1 == many))
        root = np.where(np.repeat((counts == 2) & rooted, counts)[pairs], ROOT, 0)
        made = _parents(values[:, pairs], values[:, pairs + 1], root)
        order = np.argsort(np.concatenate([pairs, lone]), kind="stable")
        values = np.concatenate([made, values[:, lone]], axis=1)[:, order]
        counts = (counts + 1) // 2
    return values


def _trees(contents: list, counters: np.ndarray, rooted: np.ndarray) -> np.ndarray:
    """The top of each content's tree, (n, 32) bytes; ``counters``: number of its first chunk."""
    lengths = np.array([len(c) for c in contents], np.int64)
    raw = np.frombuffer(b"".join(contents), np.uint8)
    counts = np.maximum(1, -(-lengths // CHUNK))
    own = np.repeat(np.arange(len(contents)), counts)
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = (np.cumsum(lengths) - lengths)[own] + place * CHUNK
    sizes = np.minimum(CHUNK, lengths[own] - place * CHUNK)
    last = np.where((counts == 1) & rooted, ROOT, 0)[own]
    values = _folded(_chunks(raw, starts, sizes, (counters[own] + place).astype(np.uint64), last), counts, rooted)
    return np.ascontiguousarray(values.T).astype("<u4").view(np.uint8).reshape(-1, 32)


def digests(contents: list) -> list[bytes]:
    """The ids of some contents (bytes)."""
    if not contents:
        return []
    n = len(contents)
    return [x.tobytes() for x in _trees(contents, np.zeros(n, np.int64), np.ones(n, bool))]


def pieces_of(frames: list[tuple[bytes, int]], piece: int = PIECE) -> list[bytes]:
    """For each ``(frame, start)`` 32 bytes a piece; ``start`` is the frame's first byte in its file, a multiple of ``piece``."""
    if piece % CHUNK or (piece // CHUNK) & (piece // CHUNK - 1) or any(start % piece for _, start in frames):
        raise ValueError("frames must begin where a piece does, and a piece is a power of two of chunks")
    parts, counters, counts = [], [], []
    for frame, start in frames:
        view = memoryview(frame)
        own = [view[k : k + piece] for k in range(0, len(frame), piece)] or [view]
        parts += own
        counters += [(start + k * piece) // CHUNK for k in range(len(own))]
        counts.append(len(own))
    if not parts:
        return []
    found = _trees(parts, np.array(counters), np.zeros(len(parts), bool))
    ends = np.cumsum(counts)
    return [found[e - n : e].tobytes() for e, n in zip(ends, counts, strict=True)]


def pieces(frame: bytes, start: int, piece: int = PIECE) -> bytes:
    """The pieces of one frame."""
    return pieces_of([(frame, start)], piece)[0]


def root(values: bytes) -> bytes:
    """The id of a file of two or more pieces, from their values in order. A file of one piece needs its bytes."""
    found = np.frombuffer(values, "<u4").astype(np.uint32).reshape(-1, 8).T
    if found.shape[1] < 2:
        raise ValueError("a file of one piece has its id from its content")
    top = _folded(found, np.array([found.shape[1]]), np.array([True]))
    return np.ascontiguousarray(top.T).astype("<u4").tobytes()


#: Bytes of contents hashed at once.
BATCH = 4 << 20


@F.pandas_udf(T.StringType())
def blake3(contents: pd.Series) -> pd.Series:
    """Lower-case hex id of binary contents; null stays null."""
    out: list[str | None] = [None] * len(contents)
    held: list[tuple[int, bytes]] = []

    def settle() -> None:
        for (i, _), found in zip(held, digests([c for _, c in held]), strict=True):
            out[i] = found.hex()
        held.clear()

    size = 0
    for i, content in enumerate(contents):
        if content is not None:
            held.append((i, bytes(content)))
            size += len(content)
            if size > BATCH:
                settle()
                size = 0
    settle()
    return pd.Series(out, dtype=object)
