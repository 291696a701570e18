"""What classifiers learn from: labels beyond the documents, copies, rare scripts; scores against a plain computation."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallystone.llm import langid, toxicity

DIR = "/root/testdata/sf0.1"


def plain_grams(text):
    """The 3- to 5-grams of the lower-cased text, other characters being one space, that hold no space but at their ends."""
    low = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() or c in "0123456789" else " " for c in text or "")
    padded = re.sub(" +", " ", f" {low} ")
    every = {padded[i : i + n] for n in (3, 4, 5) for i in range(len(padded) - n + 1)}
    return {g for g in every if " " not in g[1:-1]}


def test_labels_of_other_documents_take_no_seats(spark):
    """Two million labels, of which 300 have documents: the same model as from these alone."""
    words = ["vile", "foul", "rude"]
    docs = [(i, f"plain words number {i} and more {'you ' + words[i % 3] + ' thing' if i % 3 == 0 else 'good day'}") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.range(2_000_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 1, 0) AS toxic")
    many, few = toxicity.train(df, labels), toxicity.train(df, labels.where("doc_id < 300"))
    assert len(many.hashes) == len(few.hashes) > 10
    assert np.array_equal(many.hashes, few.hashes) and np.allclose(many.weights, few.weights) and math.isclose(many.bias, few.bias)
    found = toxicity.score(df, many).select("doc_id", "predicted").collect()
    assert all(r["predicted"] == (r["doc_id"] % 3 == 0) for r in found)
    assert len(toxicity.train(df.limit(0), labels).hashes) == 0


def test_scores_are_those_of_a_plain_computation(spark):
    """A document's score is the logistic of the summed weights of its n-grams, and the ratios are counts of documents."""
    docs = [(i, f"Doc {i}: {'you VILE swine!' if i % 4 == 0 else 'such a fine day'} é{i % 7}") for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.train(df, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in docs], "doc_id long, toxic int"))
    grams = [plain_grams(t) for _, t in docs]
    known = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    owner, code = toxicity._grams(pa.array([t for _, t in docs]))
    for i, _ in docs:
        own = set(code[owner == i].tolist())
        assert len(own) == len(grams[i])  # as many different n-grams as the plain computation finds
        margin = model.bias + sum(known.get(h, 0.0) for h in own)
        assert math.isclose(scored[i], 1 / (1 + math.exp(-margin)), rel_tol=1e-9, abs_tol=1e-12)
    assert len({scored[i] for i, _ in docs}) > 1


def test_held_out_toxicity(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DIR}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.where(toxicity.fold(F.col("doc_id"), 5) != 0))
    held = [r["doc_id"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    rows = toxicity.score(docs, model).join(labels, "doc_id").where(F.col("doc_id").isin(held)).select("toxic", "predicted").collect()
    count = Counter((r["toxic"], r["predicted"]) for r in rows)
    assert count[1, 1] / (count[1, 1] + count[1, 0]) >= 0.85 and count[0, 1] / (count[0, 1] + count[0, 0]) <= 0.01, count


def test_a_language_of_copies_is_learnt(spark):
    rows = [(1, "zum wohl der guten sache und der welt", "de")] * 4000 + [(i, f"the good of the world and all its people {i}", "en") for i in range(2, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for sample in (20, 1000):
        model = langid.train(df, sample=sample)
        assert list(model.languages) == ["de", "en"]
        asked = spark.createDataFrame([(1, "der guten welt wohl"), (2, "all the people of the world")], "doc_id long, text string")
        assert {r["doc_id"]: r["lang_pred"] for r in langid.identify(asked, model).collect()} == {1: "de", 2: "en"}


@pytest.mark.parametrize(("share", "wanted"), [(0.01, "sr"), (0.0, "en")])
def test_a_rare_script_of_a_language(spark, share, wanted):
    """Cyrillic is one word in 200 of the English texts: by default that is stray, with share 0 it is a candidate."""
    rows = [(i, "word " * 199 + "привет", "en") for i in range(50)] + [(100 + i, "добар дан речи", "sr") for i in range(50)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), script_share=share)
    found = langid.identify(spark.createDataFrame([(1, "привет")], "doc_id long, text string"), model).first()
    assert found["lang_pred"] == wanted


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs.where(toxicity.fold(F.col("doc_id"), 4) != 2))
    found = langid.identify(docs, model).where(toxicity.fold(F.col("doc_id"), 4) == 2).where("lang_pred <> 'und' AND lang IS NOT NULL")
    r = found.agg(F.count("*").alias("n"), F.count_if(F.col("lang") == F.col("lang_pred")).alias("good")).first()
    assert r["n"] > 150 and r["good"] / r["n"] >= 0.98
