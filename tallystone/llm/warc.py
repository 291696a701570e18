"""WARC archives: a deterministic sharded writer, and a reader.

Records are range-sorted by page_id. Shard bounds come from a histogram of payload bytes: the span of page_id is cut
into equal cells (four for each shard that its bytes would fill, at most ``CELLS``), every cell of more than half of
``shard_bytes`` is cut again in this way, and so on, until cells are small enough or hold one page_id; consecutive cells
fill shards of about ``shard_bytes``. Only the records of one page_id that alone are larger than a shard are divided
further, by a hash. So bounds and shards depend on the records only. The driver and a broadcast hold three numbers for
each cell, a few cells for a shard.

Each shard is sorted by (page_id, url, digest) and written by one task as files of gzip members, one member per
record, rolled when their compressed size passes ``file_bytes``. A task writes to temporary names of its own attempt
and renames each file when it is done, then commits the shard's manifest (file names, records, bytes, SHA-256) the
same way; a shard that has a manifest is complete, and a repeated attempt writes the same bytes again and puts them in
place of the first. The table ``_files`` holds all shards' manifests; a last rename puts ``_MANIFEST.json`` beside it, with
its totals and a digest of its rows. Readers compare both, and every file's SHA-256 and number of records. Files are
reached through Arrow file systems.

Records: ``response`` with HTTP headers made anew, or ``revisit`` of the response that has an equal payload. Of equal
payloads of at least ``MIN_REVISIT`` bytes the one with the smallest (page_id, url) is the response.

Cases: null html is an empty payload; a null page_id sorts first, is written as ``-``, reads back as null, and
is a response only if all its equals are null too; of repeated equal rows one is the response; a payload is held in
memory while it is written or read; an empty table gives
an empty manifest and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm import text as tx
from tallystone.llm.storage import discard, file_system, materialize, new_path, settle

MIN_REVISIT = 100
CELLS = 4096
SHARD_BYTES = 64_000_000
FILE_BYTES = 4_000_000
LEVEL = 6
#: Pages carry no time of their own.
DATE = "1970-01-01T00:00:00Z"

_FILES = "shard int, path string, records long, bytes long, sha256 string"
_READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_MISSING = "-"


def record_id(page_id: str, url: str, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join((page_id, url, digest, kind)).encode()).digest()[:16])}>"


def _one_line(text: str) -> str:
    """Header values hold no line ends or control characters: those are percent-encoded, as is the percent sign."""
    return "".join(c if c > "\x1f" and c not in "%\x7f\x85  " else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def _from_line(text: str) -> str:
    from urllib.parse import unquote

    return unquote(text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None, revisit: bool) -> bytes:
    """One record with its headers, not compressed."""
    name = _MISSING if page_id is None else str(page_id)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    kind = "revisit" if revisit else "response"
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(name, url or "", digest, kind)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _one_line(url or "")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("X-Page-ID", name),
        ("X-No-URI", "1" if url is None else "0"),
    ]
    if revisit:
        target = _MISSING if refers_to is None else str(refers_to)
        head += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(target, refers_url or "", digest, "response")),
            ("X-Refers-To-Page-ID", target),
        ]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """One gzip member without time or name."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


class Roller:
    """The files of one shard, each under a temporary name until it is done."""

    def __init__(self, root: str, shard: int, limit: int):
        self.fs, self.root = file_system(root)
        context = TaskContext.get()
        self.attempt = f"{context.stageId()}-{context.taskAttemptId()}" if context else "0"
        self.shard, self.limit = shard, limit
        self.done: list[dict] = []
        self.sink = None

    def _temporary(self, name: str) -> str:
        return f"{self.root}/_temporary/{self.attempt}-{name}"

    def put(self, data: bytes) -> None:
        if self.sink is None:
            self.name = f"shard-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.sink = self.fs.open_output_stream(self._temporary(self.name), compression=None)
            self.size, self.records, self.hash = 0, 0, hashlib.sha256()
        self.sink.write(data)
        self.size += len(data)
        self.records += 1
        self.hash.update(data)
        if self.size >= self.limit:
            self.roll()

    def roll(self) -> None:
        if self.sink is None:
            return
        self.sink.close()
        self.sink = None
        settle(self.fs, self._temporary(self.name), f"{self.root}/{self.name}")
        self.done.append({"shard": self.shard, "path": self.name, "records": self.records, "bytes": self.size, "sha256": self.hash.hexdigest()})

    def commit(self) -> list[dict]:
        self.roll()
        name = f"shard-{self.shard:06d}.manifest.json"
        with self.fs.open_output_stream(self._temporary(name)) as out:
            out.write(json.dumps(self.done, sort_keys=True).encode())
        settle(self.fs, self._temporary(name), f"{self.root}/{name}")
        return self.done


def _write(frames: Iterator[pd.DataFrame], root: str, limit: int, level: int) -> Iterator[pd.DataFrame]:
    """One partition may hold several shards, one after the other, each sorted; a record's mark comes right before it."""
    roller = before = mark = None
    for frame in frames:
        for row in frame.itertuples(index=False):
            page = None if pd.isna(row.page_id) else int(row.page_id)
            key = (page, row.url, row.digest)
            if row.is_mark:
                mark = (key, bool(row.chosen), None if pd.isna(row.refers_to) else int(row.refers_to), row.refers_url)
                continue
            if roller is None or roller.shard != row.shard:
                if roller is not None:
                    yield pd.DataFrame(roller.commit())
                roller, before = Roller(root, row.shard, limit), None
            _, chosen, to, to_url = mark if mark is not None and mark[0] == key else (None, True, None, None)
            shared = mark is not None and mark[0] == key
            # of equal rows, which lie side by side, the first is the response
            revisit = shared and (not chosen or key == before)
            roller.put(member(record(page, row.url, (row.html or "").encode(), row.digest, to, to_url, revisit), level))
            before = key
    if roller is not None:
        yield pd.DataFrame(roller.commit())


def _cells(pages: DataFrame, shard_bytes: int) -> list[tuple[int, int]]:
    """First page_id and bytes of cells that together hold all page_ids; in order."""
    weight = F.col("size") + 500
    known = pages.where("page_id IS NOT NULL").select("page_id", weight.alias("size"))
    low, high, total = known.agg(F.min("page_id"), F.max("page_id"), F.sum("size")).first()
    done: list[tuple[int, int]] = []
    spans = [] if low is None else [(low, high, total)]
    while spans:
        widths = [-(-(b - a + 1) // min(CELLS, max(2, -(-4 * size // shard_bytes)))) for a, b, size in spans]
        shared = pages.sparkSession.sparkContext.broadcast((np.array([a for a, _, _ in spans], np.int64), np.array([b for _, b, _ in spans], np.int64), np.array(widths, np.uint64)))

        def cut(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            """Number of the span and of the cell in it."""
            starts, ends, widths = shared.value
            for batch in batches:
                page = batch.column("page_id").to_numpy(zero_copy_only=False)
                span = np.searchsorted(starts, page, side="right") - 1
                inside = (span >= 0) & (page <= ends[np.maximum(span, 0)])
                page, span = page[inside], span[inside]
                cell = ((page - starts[span]).view(np.uint64) // widths[span]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(span.astype(np.int32)), pa.array(cell), batch.column("size").filter(pa.array(inside))], names=["span", "cell", "size"])

        counted = tx.map_arrow(known, cut, "span int, cell int, size long").groupBy("span", "cell").agg(F.sum("size").alias("bytes")).toArrow()
        again = []
        for span, cell, size in zip(*(counted[c].to_pylist() for c in ("span", "cell", "bytes")), strict=True):
            a = spans[span][0] + cell * widths[span]
            b = min(a + widths[span] - 1, spans[span][1])
            if 2 * size > shard_bytes and a < b:
                again.append((a, b, size))
            else:
                done.append((a, size))
        spans = sorted(again)
    return sorted(done)


def shards(pages: DataFrame, shard_bytes: int) -> Callable[[Column, Column, Column], Column]:
    """A function of page_id, url and digest that gives a shard, which rises with page_id; null page_ids come first."""
    nulls = pages.where("page_id IS NULL").agg(F.coalesce(F.sum(F.col("size") + 500), F.lit(0))).first()[0]
    shard, filled, first, parts = -1, shard_bytes, [], []
    cells = _cells(pages, shard_bytes)
    for _, size in [(None, nulls), *cells]:
        n = max(1, round(size / shard_bytes))
        if n > 1 or filled + size > shard_bytes:
            shard, filled = shard + 1, 0
        first.append(shard)
        parts.append(n)
        filled = shard_bytes if n > 1 else filled + size
        shard += n - 1
    shared = pages.sparkSession.sparkContext.broadcast((np.array([a for a, _ in cells], np.int64), np.array(first, np.int64), np.array(parts, np.int64)))

    @F.pandas_udf("int")
    def place(page_id: pd.Series, none: pd.Series, spread: pd.Series) -> pd.Series:
        starts, first, parts = shared.value
        cell = np.where(none, 0, np.searchsorted(starts, page_id.to_numpy(), side="right"))
        return pd.Series(first[cell] + spread.to_numpy() % parts[cell], dtype="int32")

    # beside nulls, numbers would reach pandas as floats
    return lambda page_id, url, digest: place(F.coalesce(page_id, F.lit(0)), page_id.isNull(), F.pmod(F.xxhash64(page_id, url, digest), F.lit(1 << 30)))


def write(pages: DataFrame, root: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, level: int = LEVEL) -> DataFrame:
    """Write ``pages(page_id, url, html)`` below ``root``; returns the manifest, one row per file."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    narrow = rows.drop("html")
    # null page_ids last, null urls first among equals: structs put nulls first, so a flag leads
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    repeated = (
        narrow.where(F.col("size") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(order).alias("w"))
        .where("n > 1")
        .select("digest", F.col("w.page_id").alias("refers_to"), F.col("w.url").alias("refers_url"))
    )
    repeated = materialize(repeated, "repeated")
    chosen = F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("url").eqNullSafe(F.col("refers_url"))
    shard = shards(narrow, shard_bytes)(F.col("page_id"), F.col("url"), F.col("digest")).alias("shard")
    # marks of repeated payloads travel as rows of their own, so each html goes through one exchange only
    marks = narrow.join(repeated, "digest").select("page_id", "url", "digest", "refers_to", "refers_url", chosen.alias("chosen")).dropDuplicates(["page_id", "url", "digest"])
    marks = marks.select("*", shard)
    columns = ("shard", "page_id", "url", "digest", "is_mark", "html", "chosen", "refers_to", "refers_url")
    records = rows.select("*", shard).select("shard", "page_id", "url", "digest", F.lit(False).alias("is_mark"), "html", F.lit(None).cast("boolean").alias("chosen"), F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_url"))
    marks = marks.withColumn("is_mark", F.lit(True)).withColumn("html", F.lit(None).cast("string")).select(*columns)
    spread = records.unionByName(marks).repartitionByRange("shard").sortWithinPartitions("shard", "page_id", "url", "digest", F.desc("is_mark"))
    files = spread.select(*columns).mapInPandas(lambda f: _write(f, root, file_bytes, level), _FILES)
    manifest = f"{root}/_files"
    files.write.mode("overwrite").parquet(manifest)
    found = spark.read.schema(files.schema).parquet(manifest)
    fs, path = file_system(root)
    fs.create_dir(path, recursive=True)
    temporary = f"{path}/_temporary-manifest-{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(json.dumps(_totals(found), sort_keys=True).encode())
    settle(fs, temporary, f"{path}/_MANIFEST.json")
    discard(repeated)
    return found


def _totals(files: DataFrame) -> dict:
    """What the top manifest says of the table of files."""
    row = F.xxhash64("shard", "path", "records", "bytes", "sha256")
    total = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("rows"))
    return total.first().asDict()


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a stream of gzip members."""
    buffered = io.BufferedReader(_Inflated(stream), 1 << 20)
    while True:
        line = buffered.readline()
        if not line:
            return
        if line.rstrip() != b"WARC/1.1":
            raise ValueError(f"no WARC record: {line[:60]!r}")
        head = {}
        while (line := buffered.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[key] = value
        block = buffered.read(int(head["Content-Length"]))
        if buffered.read(4) != b"\r\n\r\n":
            raise ValueError("a record doesn't end where its headers say")
        yield head, block


class _Digested:
    """A stream and the SHA-256 of what was read of it."""

    def __init__(self, stream):
        self.stream, self.hash = stream, hashlib.sha256()

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.hash.update(data)
        return data


class _Inflated(io.RawIOBase):
    """Concatenated gzip members as one stream."""

    def __init__(self, stream):
        self.stream, self.inflate, self.rest = stream, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            data = self.rest or self.stream.read(1 << 18)
            if not data:
                if self.inflate.eof or not self.inflate.unconsumed_tail and not self.started():
                    return 0
                raise ValueError("a gzip member is cut off")
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
            out = self.inflate.decompress(data, len(buffer))
            self.rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if out:
                buffer[: len(out)] = out
                return len(out)

    def started(self) -> bool:
        return bool(self.rest)


def _parse(head: dict[str, str], block: bytes) -> tuple:
    if head["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"block digest of {head['WARC-Record-ID']} is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    number = lambda x: None if x in (None, _MISSING) else int(x)
    url = None if head["X-No-URI"] == "1" else _from_line(head["WARC-Target-URI"])
    kind = head["WARC-Type"]
    digest = head["WARC-Payload-Digest"].partition(":")[2]
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"payload digest of {head['WARC-Record-ID']} is wrong")
    return number(head["X-Page-ID"]), url, kind, size, digest, number(head.get("X-Refers-To-Page-ID")), payload if kind == "response" else None


def _read(frames: Iterator[pd.DataFrame], root: str, with_payload: bool) -> Iterator[pd.DataFrame]:
    fs, base = file_system(root)
    names = [c.split()[0] for c in _READ.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        for c in ("page_id", "refers_to"):
            out[c] = out[c].astype("Int64")
        return out

    for paths in frames:
        for path, records, digest in zip(paths["path"], paths["records"], paths["sha256"], strict=True):
            rows, size, count = [], 0, 0
            with fs.open_input_stream(f"{base}/{path}", compression=None) as raw:
                stream = _Digested(raw)
                for head, block in read_records(stream):
                    row = _parse(head, block)
                    count += 1
                    rows.append(row if with_payload else (*row[:6], None))
                    size += len(block) if with_payload else 200
                    if size > 4_000_000:
                        yield frame(rows)
                        rows, size = [], 0
            if rows:
                yield frame(rows)
            if count != records or stream.hash.hexdigest() != digest:
                raise ValueError(f"{path} isn't the file that the manifest lists")


def read(spark: SparkSession, root: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives below ``root`` that their manifest lists, digests checked."""
    files = spark.read.schema(_FILES).parquet(f"{root}/_files")
    fs, path = file_system(root)
    with fs.open_input_stream(f"{path}/_MANIFEST.json") as top:
        if json.loads(top.read()) != _totals(files):
            raise ValueError(f"the table of files below {root} isn't the one that was committed")
    files = files.select("path", "records", "sha256")
    spread = files.repartition(4 * spark.sparkContext.defaultParallelism, "path")
    found = spread.mapInPandas(lambda f: _read(f, root, with_payload), _READ)
    return found if with_payload else found.drop("payload")


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a new folder in the shared store and read them back."""
    root = new_path(pages.sparkSession, "warc")
    write(pages, root, **options)
    return read(pages.sparkSession, root)
