"""Small fixtures against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystone.llm import chat, decontam, graph, htmltext, langid, minhash, packing, substrings, toxicity, vptree, warc

DOCS = "doc_id long, text string"
rng = random.Random(5)
WORDS = ["alpha", "beta", "Gamma", "delta", "éclair", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]


def prose(n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    base = prose(160)
    near = base.split()
    near[80] = "changed"
    rows = [(1, base), (2, " ".join(near)), (3, base), (3, base), (4, prose(90) + " " + base), (5, ""), (6, None), (None, base), (7, "short text"), (8, "Same " * 300), (9, "Same " * 200), (10, prose(3000)), (7, "short text")]
    return rows


def test_chat_round_trip(spark):
    turns = [(1, 0, "user", "a </s> <\\/s> [INST] \\"), (1, 1, "user", None), (1, 2, "assistant", "b[/INST]"), (1, 2, "assistant", "b[/INST]"), (None, None, None, "x"), (2, 0, "assistant", ""), (3, 1, "we<s>ird[INST]", "<<s>")]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, turns string")
    formatted = chat.format_conversations(df)
    found = {r["conv_id"]: r for r in chat.parse_conversations(formatted).collect()}
    assert [(t["role"], t["text"]) for t in found[1]["turns"]] == [(r, x or "") for c, _, r, x in turns if c == 1]
    assert found[1]["loss_text"] == "b[/INST]" * 2
    assert [(t["role"], t["text"]) for t in found[3]["turns"]] == [("we<s>ird[INST]", "<<s>")]
    assert [(t["role"], t["text"]) for t in found[None]["turns"]] == [("", "x")]
    assert formatted.where("conv_id = 1").first()["formatted"].count("</s>") == 2
    assert chat.parse_conversations(chat.format_conversations(df.limit(0))).count() == 0


def test_chat_of_many_adjacent_turns(spark):
    n = 30_000
    turns = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "IF(id < 3, 'user', 'assistant') AS role", "concat('é[INST]', id) AS text")
    formatted = chat.format_conversations(turns)
    found = chat.parse_conversations(formatted).first()
    assert len(found["turns"]) == n and found["loss_text"] == "".join(f"é[INST]{i}" for i in range(3, n))
    assert found["formatted_chars"] == sum(len(f"é[\\INST]{i}") + 13 for i in range(n)) + 7 * 2 + len("user") + len("assistant")


def test_decontamination(spark, docs):
    items = [(1, "alpha1 beta2"), (2, docs[0][1][:600]), (2, None), (3, "same same same"), (None, "short text"), (4, "..")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(*d, 1) for d in docs], DOCS + ", n_words int")
    for block_bytes in (10**9, 50):
        out = decontam.decontaminate(df, bench, prefix="x_", block_bytes=block_bytes).collect()
        for r in out:
            cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
            words, hit, names = cut(r["text"]), set(), set()
            for i, t in items:
                w = cut(t)
                k = min(13, len(w))
                for a in range(len(w) - k + 1 if w else 0):
                    for b in range(len(words) - k + 1):
                        if words[b : b + k] == w[a : a + k]:
                            hit.update(range(b, b + k))
                            names |= {str(i)} if i is not None else set()
            assert (r["x_n_words"], r["x_n_hit"], r["x_n_items"]) == (len(words), len(hit), len(names))
            assert r["x_items_sha256"] == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
            assert sum(s["stop"] - s["start"] for s in r["x_spans"]) == len(hit)
    assert decontam.decontaminate(df.limit(0), bench, prefix="x_").count() == 0
    assert decontam.decontaminate(df, bench.limit(0), prefix="x_").where("x_n_hit > 0").count() == 0


def test_fm_index_ranks_and_locates():
    r = np.random.default_rng(1)
    symbols = r.integers(1, 5, 400)
    lengths = np.array([100, 1, 150, 149])
    index = decontam.FMIndex(symbols, np.cumsum(lengths) - lengths, lengths, 5)
    for k in (1, 3, 6):
        low, high = index.search(np.stack([symbols[i : i + k] for i in range(40)]))
        for i in range(40):
            found = sorted(index.locate(np.arange(low[i], high[i])))
            ends = np.cumsum(lengths)
            want = [p for p in range(400 - k + 1) if (symbols[p : p + k] == symbols[i : i + k]).all() and np.searchsorted(ends, p, side="right") == np.searchsorted(ends, p + k - 1, side="right")]
            assert found == want


def test_substring_dedup(spark, docs):
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS + ", start string")
    out = substrings.dedup_substrings(df).collect()
    assert len(out) == len(docs)
    cut = lambda t: re.findall("[^\x20\x09-\x0d]+", t or "")
    least = {}
    for i, t in docs:
        w = cut(t)
        for a in range(len(w) - 49):
            if i is not None:
                key = tuple(w[a : a + 50])
                least[key] = min(least.get(key, i), i)
    for r in out:
        w, gone = cut(r["text"]), set()
        for a in range(len(w) - 49):
            if r["doc_id"] is not None and least[tuple(w[a : a + 50])] < r["doc_id"]:
                gone.update(range(a, a + 50))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (r["n_words"], r["n_removed"], r["kept_text"]) == (len(w), len(gone), kept)
    assert substrings.dedup_substrings(df.limit(0)).count() == 0


def test_near_duplicates(spark, docs):
    df = spark.createDataFrame(docs, DOCS)
    out = minhash.near_duplicates(df, block=2).collect()
    assert len(out) == len(docs)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], r)
    assert [by[i]["component_id"] for i in (1, 2, 3, 5, 6, 7)] == [1, 1, 1, 5, 6, 7]
    assert by[None]["component_id"] == 1 and not by[None]["kept"]
    assert by[9]["component_id"] == 8 and by[5]["n_shingles"] == 0
    kept = sorted(r["doc_id"] for r in minhash.near_dedup(df).collect())
    assert kept == [1, 4, 5, 6, 7, 7, 8, 10]
    assert minhash.near_dedup(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (200, 5), (101, 100)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and found[200] == 0 and found[101] == 100


def test_toxicity(spark):
    rows = [(i, f"{prose(12)} {'vile' if i % 4 == 0 else 'fine'} {prose(12)}") for i in range(200)]
    texts = spark.createDataFrame([*rows, (900, None), (901, "")], DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)] + [(170, None), (None, 1)], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.score(texts, toxicity.train(texts, labels)).collect()}
    assert all(out[i]["predicted"] == int(i % 4 == 0) for i in range(160, 200))
    assert out[900]["score"] == out[901]["score"] and 0 <= out[900]["score"] <= 1
    assert toxicity.score(texts, toxicity.train(texts, labels.limit(0))).where("predicted = 1").count() == 0


def test_language_id(spark):
    latin = [(i, "the and of with house", "en") for i in range(20)] + [(i, "der und von mit haus", "de") for i in range(20, 40)]
    model = langid.train(spark.createDataFrame([*latin, (50, "привет мир", "ru"), (51, "x", None)], DOCS + ", lang string"))
    tests = [(1, "with the house"), (2, "мир"), (3, None), (4, "12 34"), (5, "der und von " * 5 + "the and of with")]
    out = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(tests, DOCS), model).collect()}
    assert [out[i]["lang_pred"] for i in range(1, 6)] == ["en", "ru", "und", "und", "de"]
    assert [s["lang"] for s in out[5]["lang_spans"]] == ["de", "en"]


def test_viterbi_equals_brute_force():
    import itertools

    r = np.random.default_rng(2)
    table = r.normal(size=(6, 3))
    first = np.array([0, 5, 5, 6, 10])
    index = r.integers(0, 6, 10)
    got = langid.viterbi(table, index, first, 0.7)
    for a, b in zip(first[:-1], first[1:], strict=True):
        value = lambda path: sum(table[index[a + t], s] for t, s in enumerate(path)) - 0.7 * sum(x != y for x, y in zip(path, path[1:], strict=False))  # noqa: B023, E731
        if b > a:
            assert value(got[a:b]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=b - a))))


def test_nearest_neighbours_keeps_ties_of_distinct_vectors(spark):
    r = np.random.default_rng(3)
    seen = {tuple(x) for x in r.integers(0, 3, (700, 9)).tolist()} - {(0,) * 9}
    ids = r.permutation(5000)[: len(seen)].tolist()
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, sorted(seen), strict=True)]
    queries = [*rows[:40], (9001, [1.0] + [0.0] * 8), (9002, [0.1] * 9), (9003, [-1.0] * 9)]
    schema = "vec_id long, embedding array<double>"
    for shard_rows in (8192, 100):
        out = vptree.nearest(spark.createDataFrame(rows, schema), spark.createDataFrame(queries, schema), k=5, shard_rows=shard_rows)
        found = {(x["query_id"], x["rank"]): (x["vec_id"], x["score"]) for x in out.collect()}
        expect = {}
        for q, v in queries:
            own = sorted((-float(np.cumsum(np.array(v) * w)[-1]), i) for i, w in rows if i != q)
            expect |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(own[:5])}
        assert found == expect


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    out = packing.pack(spark.createDataFrame(docs, DOCS), path, with_ids=True).toPandas()
    whole = Tokenizer.from_file(path)
    expect = sorted([*whole.encode(t or "", add_special_tokens=False).ids, 1] for _, t in docs)
    got = []
    for _, own in out.groupby([out.doc_id.fillna(-1), out.doc_tokens], sort=False):
        copies = (own.start == 0).sum()
        one = own.drop_duplicates("start").sort_values("start")
        got += [[i for x in one.ids for i in x]] * copies
        assert len(own) == copies * len(one)
    assert sorted(got) == expect
    assert all(zlib.crc32(np.asarray(x, "<u4").tobytes()) == c for x, c in zip(out.ids, out.ids_crc32, strict=True))
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 2048
    assert packing.pack(spark.createDataFrame([], DOCS), path).count() == 0


def test_pretokens_equal_the_tokenizer():
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, own = Tokenizer.from_file(path), packing.Encoder(path)
    letters = ["a", "'", "'s", "'ll", "'re", " ", "  ", "\n", "1", "²", "é", "-", " ", "中", "😀", "s", "́"]
    r = random.Random(1)
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 12))) for _ in range(3000)] + [None]
    ids, offsets = own.encode(pa.array(texts))
    assert all(whole.encode(t or "", add_special_tokens=False).ids == ids[a:b].tolist() for t, a, b in zip(texts, offsets, offsets[1:], strict=False))


def test_packing_takes_added_tokens(spark):
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    path, mark = public_tokenizers.path("byte_bpe_50k.json"), "<|endoftext|>"
    whole, own = Tokenizer.from_file(path), packing.Encoder(path)
    assert whole.encode(f"a{mark}b", add_special_tokens=False).ids == [64, 50256, 65]
    r = random.Random(2)
    pieces = [mark, mark, "<|endof", "text|>", "<|", "a", "'s", " ", "\n", "1", "é", "中"]
    texts = [None, "", mark, mark * 2, f"{mark} a", f"a {mark}", *("".join(r.choice(pieces) for _ in range(r.randint(0, 9))) for _ in range(2000))]
    ids, offsets = own.encode(pa.array(texts))
    assert len(offsets) == len(texts) + 1 and offsets[-1] == len(ids)
    assert all(whole.encode(t or "", add_special_tokens=False).ids == ids[a:b].tolist() for t, a, b in zip(texts, offsets, offsets[1:], strict=False))
    out = packing.pack(spark.createDataFrame([(1, f"a{mark}b"), (2, "a")], DOCS), path, with_ids=True).orderBy("doc_id", "start").collect()
    assert [x for r in out if r["doc_id"] == 1 for x in r["ids"]] == [64, 50256, 65, 1] and {r["doc_tokens"] for r in out} == {4, 2}


def test_warc(spark, tmp_path):
    big = "<p>é" + "x" * 200
    rows = [(5, "u5", big), (3, "a b\r\n%", big), (3, "z", big), (9, None, None), (8, "s", "small"), (7, "s", "small"), (None, "n", big), (5, "u5", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    root = f"file://{tmp_path}/w"
    manifest = warc.write(pages, root, shard_bytes=300, file_bytes=400)
    assert manifest.count() > 1
    out = warc.read(spark, root, with_payload=True).collect()
    assert sorted((r["page_id"] is None, r["page_id"] or 0, r["url"] or "") for r in out) == sorted((i is None, i or 0, u or "") for i, u, _ in rows)
    responses = [r for r in out if r["payload_digest"] == hashlib.sha256(big.encode()).hexdigest() and r["record_type"] == "response"]
    assert [(r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in responses] == [(3, "a b\r\n%", big)]
    assert {r["refers_to"] for r in out if r["record_type"] == "revisit"} == {3} and sum(r["record_type"] == "revisit" for r in out) == 4
    assert all(r["payload_bytes"] == len(big.encode()) for r in out if r["record_type"] == "revisit")
    again = warc.write(pages, f"file://{tmp_path}/v", shard_bytes=300, file_bytes=400)
    assert sorted(map(tuple, manifest.collect())) == sorted(map(tuple, again.collect()))
    assert warc.archive(pages.limit(0)).count() == 0


def test_nearest(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=8).tolist()) for i in range(300)] + [(500 + i, [1.0] * 8) for i in range(40)] + [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [1.0]), (0, [1.0] * 8)]
    vectors = vptree.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    good = [(i, np.array(v)) for i, v in rows if v is not None and len(v) == 8 and np.isfinite(v).all() and np.any(v)]
    queries = {(i, tuple(v)) for i, v in good if i % 20 == 0}
    out = vptree.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=7, shard_rows=50, group_rows=120, block_rows=3).toPandas()
    # id 0 has two vectors, so two queries; every other has its 7 best in order
    for q, v in queries:
        best = [(i, -s) for s, i in sorted((-float(np.cumsum(np.array(v) * w)[-1]), i) for i, w in good if i != q)[:7]]
        own = out[out.query_id == q]
        found = list(zip(own["rank"], own.vec_id, own.score, strict=True))
        assert set((n + 1, *b) for n, b in enumerate(best)) <= set(found) and len(found) == (14 if q == 0 else 7)
    assert vptree.nearest(vectors.limit(0), vectors.limit(0)).count() == 0
    assert vptree.nearest(vectors, vectors.limit(0)).count() == 0
    assert vptree.nearest(vectors.limit(3), vectors.limit(1), k=7).count() == 2
    named = vectors.select("*", F.lit(1).alias("q"), F.lit("x").alias("rank"))
    assert vptree.nearest(named, vectors.limit(1), k=2).count() == 2


def test_relaxed_search_finds_most():
    """On vectors in clusters a factor above 1 reads fewer leaves and still finds nine in ten of the nearest."""
    r = np.random.default_rng(4)
    centres = r.normal(size=(40, 16)) * 3
    points = centres[r.integers(0, 40, 6000)] + r.normal(size=(6000, 16))
    queries = points[:150]
    exact = np.argsort(-(queries @ points.T), axis=1)[:, :20]
    for factor, least in ((1.0, 1.0), (1.1, 0.9)):
        rows, _ = vptree.Tree(points).search(queries, 20, factor)
        recall = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(rows.tolist(), exact.tolist(), strict=True)])
        assert recall >= least


def test_extraction(spark):
    page = "<html><head><title>t</title><script>var a='</p>'</script></head><body><nav><ul><li><a href=/x>menu</a></li></ul></nav><div class='ad'>Buy now.</div><article><h1>Big &amp; news</h1><p>First part <b>bold</b>.<br>More\n text here, of some length.<p>Second one, longer than that.</article><footer>&copy; x</footer>"
    pages = spark.createDataFrame([(1, page, "e"), (2, None, "e"), (3, "", "e"), (4, "<p <b '", "e")], "page_id long, html string, n_chars string")
    out = {r["page_id"]: r["x_text"] for r in htmltext.extract(pages, prefix="x_").collect()}
    assert out[1] == "Big & news First part bold. More text here, of some length. Second one, longer than that."
    assert out[2] == out[3] == ""


def test_queries_and_stages_import():
    import corpus_pipeline

    from tallystone.llm import oracles, queries

    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"]
    assert set(oracles.ORACLES) <= set(queries.QUERIES) and len(queries.QUERIES) == 10
