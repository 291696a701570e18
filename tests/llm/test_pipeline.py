"""Every stage of the pipeline, and the whole, against brute force on a small corpus of odd documents."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

from .test_near_duplicates import brute

SCHEMA = "doc_id long, text string, lang string, n_chars long, _predicted string, _score int, _th int, _covers string, _n_removed int, _contaminated boolean, th string, node string"
rng = random.Random(23)


def prose(n, words=400):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    shared, item = prose(70), [f"item{i}" for i in range(20)]
    texts = [" ".join(prose(30) + ["vile", "horrid"] * (i % 3 == 0) + prose(30)) for i in range(120)]
    texts += [" ".join(prose(20) + shared + prose(40)) for _ in range(4)]
    texts += [" ".join(prose(5) + item + prose(5)), " ".join(prose(3000)) + " " + " ".join(item)]
    texts += [texts[1], texts[1] + " more", None, "", "  \n ", "short", texts[2], " ".join(shared)]
    rows = list(enumerate(texts)) + [(1, texts[1]), (None, "a text of nobody at all"), (None, texts[4])]
    docs = [(i, t, "en", None if t is None else len(t), "p", 1, 2, "c", 3, True, "t", "n") for i, t in rows]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 3 == 0)) for i in range(120)] + [(0, 1), (None, 1), (500, 0), (5, None)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None), (None, "..")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def without_repeats(rows):
    cut = lambda t: re.findall("[^\x20\x09-\x0d]+", t or "")
    least = {}
    for i, t in rows:
        w = cut(t)
        for a in range(len(w) - 49) if i is not None else ():
            least[tuple(w[a : a + 50])] = min(least.get(tuple(w[a : a + 50]), i), i)
    out = []
    for i, t in rows:
        w, gone = cut(t), set()
        for a in range(len(w) - 49) if i is not None else ():
            if least[tuple(w[a : a + 50])] < i:
                gone.update(range(a, a + 50))
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t))
    return out


def contaminated(text):
    w = re.findall(r"[a-z0-9]+", (text or "").lower())
    item, hit = [f"item{i}" for i in range(20)], set()
    for a in range(len(w) - 12):
        if any(w[a : a + 13] == item[b : b + 13] for b in range(8)):
            hit.update(range(a, a + 13))
    return bool(hit) and 20 * len(hit) >= len(w)


def expected(rows):
    """Rows after each stage but the last."""
    clean = [(i, t) for i, t in rows if "vile" not in (t or "").split()]
    one = [r for r, (doc, _, c) in zip(clean, brute(clean, 5, 80), strict=True) if doc == c]
    cut = without_repeats(one)
    return [clean, one, cut, [r for r in cut if not contaminated(r[1])]]


def test_stages_equal_brute_force(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for (name, stage), want in zip(pipeline.STAGES[:-1], expected(rows), strict=True):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        assert kept(out) == sorted(want, key=repr), name
        assert out.where("n_chars <> char_length(text)").count() == 0
        docs = spark.createDataFrame(out.collect(), docs.schema)
    packed = pipeline.STAGES[-1][1](spark, docs, folder)
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.sum_distinct("doc_tokens").alias("t")).where("doc_id IS NOT NULL")
    assert whole.where("n % t <> 0").count() == 0 and whole.count() == len({i for i, _ in want if i is not None})
    assert pipeline.run(spark, folder).agg(F.sum("length")).first() == packed.agg(F.sum("length")).first()


def test_stages_of_an_empty_corpus(spark, corpus):
    folder, _ = corpus
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name
