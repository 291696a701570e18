"""Empty tables, repeated rows, very long texts and clashing names, for the operators whose own tests hold none."""

import hashlib
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallystone.llm import decontam, htmltext, langid, packing, storage, substrings, toxicity, vptree, warc

CLASH = "doc_id long, text string, lang string, score string, predicted int, lang_pred int, lang_spans int, th int, _doc int, _th int, _covers int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 1, 2, 3, 4, 5, 6, 7) for i, t, g in rows], CLASH)


def test_toxicity(spark):
    long = "fine " * 300_000 + "vile"
    rows = [(i, "vile words here" if i % 2 else "fine words here", "en") for i in range(60)] + [(100, long, "en"), (101, None, None), (7, "vile words here", "en")]
    docs = clashing(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(3, 0), (3, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, least=1, deviations=1.0, features=None)
    out = toxicity.score(docs, model, prefix="x_").collect()
    assert len(out) == len(rows) and all(r["x_predicted"] == r["doc_id"] % 2 for r in out if 50 <= r["doc_id"] < 60)
    assert len({r["x_score"] for r in out if r["doc_id"] == 7}) == 1 and out[0]["score"] == "s"
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), labels), prefix="x_").count() == 0


def test_language_id(spark):
    rows = [(i, "the house of the king", "en") for i in range(30)] + [(i, "das haus von dem könig", "de") for i in range(30, 60)] + [(90, "das haus " * 120_000, "de"), (90, "мир", "en"), (1, "the house of the king", "en")]
    docs = clashing(spark, rows)
    model = langid.train(docs.where("doc_id < 90"))
    out = langid.identify(docs, model, prefix="x_").collect()
    assert len(out) == len(rows) and all(r["x_lang_pred"] == r["lang"] for r in out if r["text"] != "мир")
    empty = langid.train(docs.limit(0))
    assert {r["x_lang_pred"] for r in langid.identify(docs, empty, prefix="x_").collect()} == {"und"}
    assert langid.identify(docs.limit(0), model, prefix="x_").count() == 0


def test_scripts_exclude_languages_and_many_languages():
    import numpy as np

    uses = np.zeros((len(langid._NAMES), 200), bool)
    uses[langid._NAMES.index("latin"), :199] = True
    uses[langid._NAMES.index("cyrillic"), 199] = True
    weights = np.random.default_rng(1).normal(size=(langid.BUCKETS, 200)).astype(np.float32)
    model = langid.Model([f"l{i}" for i in range(200)], weights, uses)
    words = langid._words(pa.array(["abc мир def", "мир 你好"]))
    label = model.label(words)
    assert label[1] == label[3] == 199 and max(label[0], label[2]) < 199 and min(label) >= 0
    assert (model.label(words) == label).all()  # from the kept scores


def test_decontamination_of_long_texts_in_blocks(spark):
    text = " ".join(f"v{i % 5000}" for i in range(120_000))
    docs = spark.createDataFrame([(1, text, "a"), (2, text, "b"), (3, None, "c")], "doc_id long, text string, th string")
    bench = spark.createDataFrame([(i, " ".join(f"v{(k + 7 * i) % 5000}" for k in range(13))) for i in range(40)], "item_id long, text string")
    for block_bytes in (10**9, 400):
        out = {r["th"]: r for r in decontam.decontaminate(docs, bench, block_bytes=block_bytes).collect()}
        assert out["a"]["n_items"] == out["b"]["n_items"] == 40 and out["a"]["n_hit"] == (39 * 7 + 13) * 24 and out["c"]["n_words"] == 0


def test_substring_dedup_with_clashing_names(spark):
    words = " ".join(f"a{i}" for i in range(90))
    docs = clashing(spark, [(1, words, "x"), (2, "new " + words + " end", "y"), (3, None, "z")])
    out = {r["doc_id"]: r for r in substrings.dedup_substrings(docs).collect()}
    assert out[2]["kept_text"] == "new end" and [tuple(s) for s in out[2]["repeats"]] == [(1, 91)] and out[2]["_th"] == 6
    assert out[1]["repeats"] == [] and out[3]["n_words"] == 0


def test_packing_with_clashing_names(spark):
    import public_tokenizers

    docs = spark.createDataFrame([(1, "a b", 9, 9)], "doc_id long, text string, start int, ids int")
    assert packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).agg(F.sum("length")).first()[0] == 3


@pytest.mark.parametrize("page", ["<div>x" * 100_000, '<a "' * 150_000, '<a ">"' * 100_000, "<" * 500_000, "<b>x<p>" * 60_000, "<svg>" * 100_000, "<!--" * 100_000, "x &amp; " * 80_000])
def test_html_takes_linear_time(page):
    began = time.time()
    half = time.time()
    htmltext.leaf_blocks(page[: len(page) // 2])
    half = time.time() - half
    htmltext.leaf_blocks(page)
    assert time.time() - began < max(4.0, 8 * half)


def test_html_rows(spark):
    article = "<body><nav><a href=/>home</a></nav><article><h1>On tides</h1><p>The sea rises twice a day.</p><p>It falls <math><mi>as</mi></math> often, too.</p><video>No film.</video><svg><title>t</title><text>drawn</text></svg></article></body>"
    pages = spark.createDataFrame([(1, article, "a", 1), (1, article, "a", 1), (2, "<p>" * 50_000, "b", 2)], "page_id long, html string, text string, n_chars int")
    out = htmltext.extract(pages, prefix="x_").collect()
    assert out[0]["x_text"] == out[1]["x_text"] and out[0]["x_text"].startswith("On tides The sea rises twice a day. It falls as often, too.") and "drawn" not in out[0]["x_text"]
    assert htmltext.extract(pages.limit(0), prefix="x_").count() == 0


def test_archives_of_uneven_ids_are_sorted(spark):
    rows = [(i, f"u{i}", "x" * 300 + str(i)) for i in range(200)] + [(2**62, "far", "y" * 300), (-(2**62), "near", "z" * 300), (5, "u5b", "é" * 400_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, shard int")
    root = storage.new_path(spark, "warc-test")
    files = warc.write(pages, root, shard_bytes=5000, file_bytes=700).collect()
    assert len({f["shard"] for f in files}) > 10 and len(files) > len({f["shard"] for f in files})
    found = warc.read(spark, root, with_payload=True).collect()
    assert sorted((r["page_id"], bytes(r["payload"]).decode()) for r in found) == sorted((i, h) for i, _, h in rows)
    shard = warc.shards(pages.select("page_id", "url", F.sha2("html", 256).alias("digest"), F.octet_length("html").cast("long").alias("size")), 5000)
    placed = pages.select("page_id", shard(F.col("page_id"), F.col("url"), F.sha2("html", 256)).alias("s")).orderBy("page_id").collect()
    by_id = [p["s"] for p in placed if p["page_id"] != 5]
    assert by_id == sorted(by_id)
    # a file that isn't the one committed is found out
    fs, path = storage.file_system(root)
    name = f"{path}/{files[0]['path']}"
    with fs.open_input_stream(name, compression=None) as stream:
        data = stream.read()
    with fs.open_output_stream(name, compression=None) as out:
        out.write(data + warc.member(warc.record(1, "u", b"", hashlib.sha256(b"").hexdigest(), None, None, False)))
    with pytest.raises(Exception, match="isn't the file"):
        warc.read(spark, root).count()


def test_a_local_folder_is_refused_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        storage.shared_dir(Session())


def test_scratch_goes_when_discarded(spark):
    found = storage.materialize(spark.range(3).toDF("a"), "some")
    path = storage._paths[found]
    fs, local = storage.file_system(path)
    assert found.count() == 3 and fs.get_file_info(local).type.name == "Directory"
    storage.discard(found)
    assert fs.get_file_info(local).type.name == "NotFound"


def test_vectors_of_few_distances():
    """Binary vectors, whose distances tie, neither nest too deep nor lose neighbours."""
    import numpy as np

    points = np.unique(np.random.default_rng(2).integers(0, 2, (3000, 14)).astype(float), axis=0)[1:]
    rows, products = vptree.Tree(points, leaf=8).search(points[:50], 5)
    best = -np.sort(-(points[:50] @ points.T), axis=1)[:, :5]
    assert (-np.sort(-products, axis=1) == best).all() and (rows >= 0).all()


def _nearest(rows, k):
    """By the contract, in Python: sums first to last, ties to the smaller id."""

    def score(a, b):
        total = np.float64(0.0)
        with np.errstate(all="ignore"):
            for x, y in zip(a, b, strict=True):
                total = total + np.float64(x) * np.float64(y)
        return float(total)

    found = []
    for q, own in rows:
        best = sorted(((score(own, v), i) for i, v in rows if i != q), key=lambda p: (np.inf if np.isnan(p[0]) else -p[0], p[1]))
        found += [(q, n + 1, i, repr(s)) for n, (s, i) in enumerate(best[:k])]
    return sorted(found)


@pytest.mark.parametrize("size", [1e160, 1e308, 1e-170, 3e-320, 1.0])
def test_neighbours_of_numbers_out_of_the_usual_range(spark, size):
    """Squares overflow or vanish; products do, or only some; sizes mixed within the table."""
    rng = np.random.default_rng(11)
    vectors = rng.normal(0, 1, (260, 4)) * (size / 8)
    vectors[::3] /= max(size, 1e-300) if size > 1 else 1.0
    vectors[5] = vectors[9]
    vectors[7] = 0.125
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors) if v.any()]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(2)
    asked = table.where("vec_id % 9 < 2")
    got = vptree.nearest(table, asked, 5, shard_rows=150).collect()
    expected = [r for r in _nearest(rows, 5) if r[0] % 9 < 2]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], repr(r["score"])) for r in got) == expected


def test_letters_that_are_newer_than_python():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, own = Tokenizer.from_file(path), packing.Encoder(path)
    points = [0x10D40, 0x1C89, 0xA7DC, 0x1E5D0, 0x0E01, 0x0660, 0x2028, 0x200B, 0xFEFF, 0x10FFFF, 0x378, ord("a"), ord("7"), 0x4E2D, 0x1F600, 32, 10, 39]
    rng = np.random.default_rng(3)
    tails = ["", "'s", "'ll", " ", "x", "1", "!"]
    texts = ["".join(chr(rng.choice(points)) + tails[rng.integers(len(tails))] for _ in range(rng.integers(0, 12))) for _ in range(3000)]
    ids, offsets = own.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids, ascii(text)
