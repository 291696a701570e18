"""Large files as rows of frames: read by range, hashed and compressed frame by frame, and put together by an ordered writer.

A file is never one row. ``planned`` cuts a listing into ranges of ``chunk`` bytes; ``encoded`` reads a range, hashes it
(as pieces of the file's Merkle tree) and compresses it, in whichever task; ``ids`` folds 32 bytes a piece into each file's
id; ``write`` streams a document's frames, in order, to a temporary name and gives it the id's. Back, ``stored`` reads
a document frame by frame without parsing it whole, ``decoded`` expands and hashes each frame, and ``verified`` compares
the folded id with the name. A task holds some ``BATCH`` bytes of frames, or one larger
frame, and a row of each file's pieces.

Cases: an empty file has no frames, an id, and a document with an empty list; a frame that can't be expanded has null
content, and its document is not verified; a document cut short in its list gives the frames before, which don't add up
to its id.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.operators import blake3
from tallystone.operators.blobs import CHUNK, filetype

#: Read at once from a document.
BLOCK = 1 << 20
#: Bytes of frames that are hashed together.
BATCH = 4 << 20

_ENCODED = "path string, frame long, size long, pieces binary, whole binary, head binary, data string"
_DECODED = "blobid string, frame long, length long, pieces binary, whole binary, content binary"


def planned(listing: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``path, size, frame, start`` of the frames of ``listing(path, size)``."""
    count = F.ceil(F.col("size") / chunk).cast("long")
    rows = listing.select("path", F.col("size").cast("long").alias("size"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("frame"), count.alias("_n"))
    return rows.where("frame < _n AND frame >= 0").select("path", "size", "frame", (F.col("frame") * chunk).alias("start"))


class _Batch:
    """Frames hashed together: small ones in one go, large ones one by one."""

    def __init__(self, piece: int, names: list[str]):
        self.piece, self.names = piece, names
        self.rows: list[tuple] = []
        self.contents: list[tuple[bytes | None, int]] = []
        self.size = 0

    def add(self, content: bytes | None, start: int, row: tuple) -> Iterator[pd.DataFrame]:
        self.rows.append(row)
        self.contents.append((content, start))
        self.size += len(content or b"")
        if self.size >= BATCH:
            yield self.settle()

    def settle(self) -> pd.DataFrame:
        """``pieces`` of each frame, and in ``whole`` the id of a file that has this frame alone and no more than a piece."""
        known = [i for i, (c, _) in enumerate(self.contents) if c is not None]
        pieces, wholes = [b""] * len(self.rows), [None] * len(self.rows)
        for i, found in zip(known, blake3.pieces_of([self.contents[i] for i in known], self.piece), strict=True):
            pieces[i] = found
        small = [i for i in known if self.contents[i][1] == 0 and len(self.contents[i][0]) <= self.piece]
        for i, found in zip(small, blake3.digests([self.contents[i][0] for i in small]), strict=True):
            wholes[i] = found
        out = pd.DataFrame({n: pd.Series([r[k] for r in self.rows], dtype=object) for k, n in enumerate(self.names)})
        out = out.assign(pieces=pd.Series(pieces, dtype=object), whole=pd.Series(wholes, dtype=object))
        self.rows, self.contents, self.size = [], [], 0
        return out


def encoded(frames: DataFrame, root: str, chunk: int = CHUNK, piece: int = blake3.PIECE) -> DataFrame:
    """``path, frame, size, pieces, whole, head, data`` of ``planned`` frames of files in the file system of ``root``.

    ``data`` is the base64 of one LZ4 frame. A file that ends before its listed size raises an error.
    """
    from tallystone.sources import _file_system

    def one(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = _file_system(root)
        codec, batch = pa.Codec("lz4"), _Batch(piece, ["path", "frame", "size", "head", "data"])
        for part in parts:
            for path, size, frame, start in zip(part["path"], part["size"], part["frame"], part["start"], strict=True):
                with store.open_input_file(path) as source:
                    content = source.read_at(min(chunk, size - start), start)
                if len(content) != min(chunk, size - start):
                    raise ValueError(f"{path} is shorter than listed")
                data = base64.b64encode(codec.compress(content, asbytes=True)).decode()
                yield from batch.add(content, start, (path, frame, size, content[:8] if start == 0 else None, data))
        yield batch.settle()

    # as many tasks as frames allow, whatever the listing's partitions
    return frames.repartition("path", "frame").mapInPandas(one, _ENCODED)


@F.pandas_udf(T.StringType())
def _root(pieces: pd.Series, wholes: pd.Series) -> pd.Series:
    out = []
    for parts, whole in zip(pieces, wholes, strict=True):
        values = b"".join(bytes(p) for p in parts)
        if len(values) > 32:
            out.append(blake3.root(values).hex())
        else:
            out.append(bytes(whole).hex() if whole is not None else blake3.digests([b""])[0].hex() if not values else None)
    return pd.Series(out, dtype=object)


def ids(frames: DataFrame, key: str = "path") -> DataFrame:
    """``key, blobid``: the id of each file, folded from its frames' pieces."""
    parts = frames.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("frame", "pieces"))).alias("p"), F.max("whole").alias("whole"))
    return parts.select(key, _root(F.col("p.pieces"), F.col("whole")).alias("blobid" if key != "blobid" else "found"))


def write(frames: DataFrame, listing: DataFrame, root: str) -> DataFrame:
    """``path, blobid, target`` of the documents written below ``root``, a mount that all executors share.

    ``frames`` as ``encoded`` gives them, of files ``listing(path, size, mtime)``; it is read twice, so it is best
    a stored table. A document goes to a temporary name, frame by frame, and then gets its id's; the same content twice
    leaves one document.
    """
    known = listing.select("path", F.col("size").cast("long").alias("size"), F.col("mtime").cast("double").alias("mtime"))
    named = known.join(ids(frames), "path", "left").withColumn("blobid", F.coalesce("blobid", F.lit(blake3.digests([b""])[0].hex())))
    rows = named.join(frames.drop("size"), "path", "left").withColumn("filetype", F.when(F.col("frame") == 0, filetype(F.col("head"))))
    ordered = rows.repartition("path").sortWithinPartitions("path", "frame").select("path", "blobid", "size", "mtime", "filetype", "frame", "data")

    def put(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, path, done = None, None, None

        def close() -> pd.DataFrame:
            blobid, size, mtime, kind, temporary, target = done
            out.write("\n    ]\n  },\n  " + f'"metadata": {json.dumps({"size": int(size), "mtime": mtime, "filetype": kind, "encryption": False})}\n}}')
            out.close()
            os.replace(temporary, target)
            return pd.DataFrame({"path": [path], "blobid": [blobid], "target": [target]})

        for part in parts:
            for own, blobid, size, mtime, kind, frame, data in part.itertuples(index=False):
                if own != path:
                    if out is not None:
                        yield close()
                    target = os.path.join(root, blobid[:2], blobid[2:4], blobid)
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    temporary = f"{target}.{os.getpid()}.tmp"
                    out, path = open(temporary, "w"), own  # noqa: SIM115
                    out.write('{\n  "content": {\n    "encoding": "lz4-multiframe",\n    "frames": [\n')
                    done = (blobid, size, None if pd.isna(mtime) else mtime, kind if isinstance(kind, str) else "inode/x-empty", temporary, target)
                if data is not None:
                    out.write(("" if not frame else ",\n") + f'      "{data}"')
        if out is not None:
            yield close()

    return ordered.mapInPandas(put, "path string, blobid string, target string")


_LIST = re.compile(r'"frames"\s*:\s*\[')


def scan(stream) -> Iterator[str]:
    """The strings of a document's list of frames, one after the other, from a text stream; memory is one of them."""
    held = ""
    while not (found := _LIST.search(held)):
        more = stream.read(BLOCK)
        if not more:
            return
        held = held[-64:] + more if len(held) > 1 << 16 else held + more
    held = held[found.end() :]
    while True:
        start, end = held.find('"'), held.find("]")
        if end >= 0 and (start < 0 or end < start):
            return
        if start >= 0:
            parts = [held[start + 1 :]]
            while (stop := parts[-1].find('"')) < 0:
                more = stream.read(BLOCK)
                if not more:
                    return  # cut short
                parts.append(more)
            held = parts[-1][stop + 1 :]
            parts[-1] = parts[-1][:stop]
            yield "".join(parts)
            continue
        held = stream.read(BLOCK)
        if not held:
            return


def stored(paths: DataFrame, root: str) -> DataFrame:
    """``blobid, frame, data`` of the documents ``paths(blobid, target)`` in the file system of ``root``, a row a frame."""
    from tallystone.sources import _file_system

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        store, _ = _file_system(root)
        for part in parts:
            for blobid, target in zip(part["blobid"], part["target"], strict=True):
                with store.open_input_stream(target) as raw:
                    for number, data in enumerate(scan(io.TextIOWrapper(io.BufferedReader(raw, BLOCK), "utf-8"))):
                        yield pd.DataFrame({"blobid": [blobid], "frame": [number], "data": [data]})

    return paths.select("blobid", "target").mapInPandas(read, "blobid string, frame long, data string")


def expand(data: str) -> bytes | None:
    """One frame's content, whatever its size; null if it isn't one."""
    try:
        with pa.CompressedInputStream(pa.BufferReader(base64.b64decode("".join(data.split()), validate=True)), "lz4") as stream:
            return stream.read()
    except (ValueError, OSError):
        return None


def decoded(frames: DataFrame, chunk: int = CHUNK, piece: int = blake3.PIECE) -> DataFrame:
    """``blobid, frame, length, pieces, whole, content`` of ``frames(blobid, frame, data)``."""

    def one(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch = _Batch(piece, ["blobid", "frame", "length", "content"])
        for part in parts:
            for blobid, frame, data in zip(part["blobid"], part["frame"], part["data"], strict=True):
                content = None if data is None else expand(data)
                yield from batch.add(content, frame * chunk, (blobid, frame, None if content is None else len(content), content))
        yield batch.settle()

    return frames.mapInPandas(one, _DECODED)


def verified(frames: DataFrame, documents: DataFrame, name: Column | None = None) -> DataFrame:
    """``blobid, size, frames, verified`` of ``documents(blobid)``: whether the decoded ``frames`` have the id that the
    ``blobid`` is, or that ``name`` takes from it."""
    sums = frames.groupBy("blobid").agg(F.sum("length").alias("size"), F.count("*").alias("frames"), F.max(F.col("content").isNull()).alias("lost"))
    found = documents.select("blobid").distinct().join(sums.join(ids(frames, "blobid"), "blobid"), "blobid", "left")
    nothing = F.lit(blake3.digests([b""])[0].hex())
    right = (F.coalesce("found", nothing) == (F.col("blobid") if name is None else name)) & ~F.coalesce("lost", F.lit(False))
    return found.select("blobid", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("frames", F.lit(0)).alias("frames"), F.coalesce(right, F.lit(False)).alias("verified"))


def restore(frames: DataFrame, targets: DataFrame, root: str) -> DataFrame:
    """``pth, size`` of files written below ``root`` from decoded ``frames``, frame by frame; ``targets(blobid, pth, mtime)``.

    A file goes to a temporary name first; its time of change is set before it gets its own. Paths that lead out of
    ``root`` raise an error.
    """
    rows = targets.join(frames.select("blobid", "frame", "content"), "blobid", "left")
    ordered = rows.repartition("pth").sortWithinPartitions("pth", "frame").select("pth", F.col("mtime").cast("double").alias("mtime"), "content")

    def put(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = os.path.realpath(root)
        out, path, when, size = None, None, None, 0

        def close() -> pd.DataFrame:
            out.close()
            if not pd.isna(when):
                os.utime(out.name, (when, when))
            os.replace(out.name, os.path.join(base, path))
            return pd.DataFrame({"pth": [path], "size": [size]})

        for part in parts:
            for own, mtime, content in part.itertuples(index=False):
                if own != path:
                    if out is not None:
                        yield close()
                    target = os.path.realpath(os.path.join(base, own))
                    if not target.startswith(base + os.sep):
                        raise ValueError(f"{own!r} leads out of the folder")
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    out, path, when, size = open(f"{target}.{os.getpid()}.tmp", "wb"), own, mtime, 0  # noqa: SIM115
                if content is not None:
                    out.write(content)
                    size += len(content)
        if out is not None:
            yield close()

    return ordered.mapInPandas(put, "pth string, size long")
