"""BLAKE3 against its published vectors, and large files as rows of frames."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallystone.operators import blake3, blobs, frames
from tallystone.sources import scan_tree

#: Published vectors: the id of n bytes that count 0 to 250 over and over.
VECTORS = {
    0: "af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262",
    1: "2d3adedff11b61f14c886e35afa036736dcd87a74d27b5c1510225d0f592e213",
    63: "e9bc37a594daad83be9470df7f7b3798297c3d834ce80ba85d6e207627b7db7b",
    64: "4eed7141ea4a5cd4b788606bd23f46e212af9cacebacdc7d1f4c6dc7f2511b98",
    65: "de1e5fa0be70df6d2be8fffd0e99ceaa8eb6e8c93a63f2d8d1c30ecb6b263dee",
    1024: "42214739f095a406f3fc83deb889744ac00df831c10daa55189b5d121c855af7",
    1025: "d00278ae47eb27b34faecf67b4fe263f82d5412916c1ffd97c8cb7fb814b8444",
    2048: "e776b6028c7cd22a4d0ba182a8bf62205d2ef576467e838ed6f2529b85fba24a",
    2049: "5f4d72f40d7a5f82b15ca2b2e44b1de3c2ef86c426c95c1af0b6879522563030",
    3072: "b98cb0ff3623be03326b373de6b9095218513e64f1ee2edd2525c7ad1e5cffd2",
    8192: "aae792484c8efe4f19e2ca7d371d8c467ffb10748d8a5a1ae579948f718a2a63",
    31744: "62b6960e1a44bcc1eb1a611a8d6235b6b4b78f32e7abc4fb4c6cdcce94895c47",
    102400: "bc3e3d41a1146b069abffad3c0d44860cf664390afce4d9661f7902e7943e085",
}


def counting(n):
    return bytes(i % 251 for i in range(n))


def test_published_vectors():
    assert [d.hex() for d in blake3.digests([counting(n) for n in VECTORS])] == list(VECTORS.values())
    assert [blake3.digests([counting(n)])[0].hex() for n in VECTORS] == list(VECTORS.values())
    assert blake3.digests([]) == []


@pytest.mark.parametrize("piece", [1024, 4096])
def test_pieces_fold_to_the_id(piece):
    rng = random.Random(1)
    for n in (piece + 1, 3 * piece, 5 * piece + 7, 16 * piece, 23 * piece - 1):
        content = rng.randbytes(n)
        for frame in (piece, 2 * piece, 3 * piece):
            parts = [blake3.pieces(content[k : k + frame], k, piece) for k in range(0, n, frame)]
            assert blake3.root(b"".join(parts)) == blake3.digests([content])[0]
    with pytest.raises(ValueError, match="begin where a piece does"):
        blake3.pieces(b"x", 1, piece)


def test_any_chunk_size_gives_one_id():
    content = b"A" * (10 << 20) + b"end"
    whole = blake3.digests([content])[0]
    for frame, piece in ((1 << 20, 1 << 20), (10 << 20, 2 << 20)):
        assert blake3.root(b"".join(blake3.pieces(content[k : k + frame], k, piece) for k in range(0, len(content), frame))) == whole


def test_column_and_documents(spark):
    rows = [(str(n), bytearray(counting(n)), 1.0) for n in VECTORS] + [("null", None, 1.0)]
    df = spark.createDataFrame(rows, "path string, content binary, mtime double")
    found = {r["path"]: r["id"] for r in df.select("path", blake3.blake3("content").alias("id")).collect()}
    assert found == {str(n): v for n, v in VECTORS.items()} | {"null": None}
    made = blobs.create(df.where("content IS NOT NULL"), blake3.blake3)
    back = blobs.restore(made, blake3.blake3).collect()
    assert all(r["verified"] for r in back) and {r["path"]: r["blobid"] for r in back} == {str(n): v for n, v in VECTORS.items()}


@pytest.fixture
def tree(tmp_path):
    rng = random.Random(2)
    source = tmp_path / "in"
    source.mkdir()
    contents = {"empty": b"", "small": b"hello", "piece": rng.randbytes(4096), "more": rng.randbytes(4097), "frames": rng.randbytes(8192 * 5 + 3), "zeros": bytes(8192 * 150), "copy": b"hello"}
    for name, content in contents.items():
        (source / name).write_bytes(content)
    return source, contents


def test_round_trip_by_frames(spark, tmp_path, tree):
    """A file of 150 frames is never one row, and its document and id are those of the plain encoder."""
    source, contents = tree
    listing = scan_tree(spark, str(source)).withColumn("mtime", F.lit(1234.5))
    chunk, piece = 8192, 4096
    made = frames.encoded(frames.planned(listing, chunk), str(source), chunk, piece)
    made.write.parquet(str(tmp_path / "frames"))
    made = spark.read.parquet(str(tmp_path / "frames"))
    assert made.agg(F.max(F.length("data"))).first()[0] < 2 * chunk
    assert {r["path"]: r["n"] for r in made.groupBy("path").agg(F.count("*").alias("n")).collect()} == {str(source / k): -(-len(v) // chunk) for k, v in contents.items() if v}
    out = tmp_path / "out"
    written = {r["path"]: r for r in frames.write(made, listing, str(out)).collect()}
    want = {str(source / k): blake3.digests([v])[0].hex() for k, v in contents.items()}
    assert {p: r["blobid"] for p, r in written.items()} == want
    assert sorted(p.name for p in out.rglob("*") if p.is_file()) == sorted(set(want.values()))
    for name, content in contents.items():
        document = open(written[str(source / name)]["target"]).read()
        assert blobs.decode(document, chunk) == content
        meta = json.loads(document)["metadata"]
        assert meta["size"] == len(content) and meta["mtime"] == 1234.5 and meta["encryption"] is False

    documents = spark.createDataFrame([(r["blobid"], r["target"], p) for p, r in written.items()], "blobid string, target string, path string")
    distinct = documents.dropDuplicates(["blobid"])
    back = frames.decoded(frames.stored(distinct, str(out)), chunk, piece)
    checked = {r["blobid"]: r for r in frames.verified(back, documents).collect()}
    assert all(r["verified"] for r in checked.values()) and {b: r["size"] for b, r in checked.items()} == {want[str(source / k)]: len(v) for k, v in contents.items()}
    again = tmp_path / "again"
    targets = documents.select("blobid", F.element_at(F.split("path", "/"), -1).alias("pth"), F.lit(99.0).alias("mtime"))
    assert {r["pth"]: r["size"] for r in frames.restore(back, targets, str(again)).collect()} == {k: len(v) for k, v in contents.items()}
    assert {p.name: p.read_bytes() for p in again.iterdir()} == contents and (again / "small").stat().st_mtime == 99.0
    with pytest.raises(Exception, match="leads out"):
        frames.restore(back, targets.withColumn("pth", F.lit("../x")), str(again)).collect()


def test_damaged_documents_are_not_verified(spark, tmp_path, tree):
    source, contents = tree
    content, chunk = contents["frames"], 8192
    name = blake3.digests([content])[0].hex()
    document = blobs.encode(content, 1.0, "x", chunk=chunk)
    swapped = json.loads(document)
    swapped["content"]["frames"][1:3] = swapped["content"]["frames"][2:0:-1]
    cases = {"right": document, "pretty": json.dumps(json.loads(document), indent=3), "cut": document[: len(document) // 2], "swapped": json.dumps(swapped), "binary": "\x1f\x8b", "nothing": "", "broken": document.replace('"frames": ["', '"frames": ["!')}
    for case, text in cases.items():
        (tmp_path / case).write_text(text)
    for case in cases:
        at = spark.createDataFrame([(name, str(tmp_path / case))], "blobid string, target string")
        back = frames.decoded(frames.stored(at, str(tmp_path)), chunk, 4096)
        found = frames.verified(back, at).first()
        assert found["verified"] == (case in ("right", "pretty")), case
    one = blobs.encode(b"hello", 1.0, "x")
    (tmp_path / "long").write_text(one.replace('"content"', '"note": "' + "x" * 300_000 + '", "content"'))
    at = spark.createDataFrame([(blake3.digests([b"hello"])[0].hex(), str(tmp_path / "long"))], "blobid string, target string")
    assert frames.verified(frames.decoded(frames.stored(at, str(tmp_path))), at).first()["verified"]


def test_a_file_that_shrank_is_an_error(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"x" * 10)
    plan = frames.planned(spark.createDataFrame([(str(tmp_path / "f"), 20)], "path string, size long"))
    with pytest.raises(Exception, match="shorter than listed"):
        frames.encoded(plan, str(tmp_path)).collect()
