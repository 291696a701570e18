"""A training-data pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``docs``, whatever these are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm import decontam, minhash, packing, substrings, toxicity
from tallystone.llm.queries import table, tokenizer_path
from tallystone.llm.storage import materialize
from tallystone.llm.text import unclashing


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns as op1 does, from labels whose fold is not 0."""
    labels = table(spark, sf_dir, "labels").where(toxicity.fold(F.col("doc_id"), 5) != 0)
    model = toxicity.train(docs, labels)
    own = unclashing(docs.columns, ["score", "predicted"])
    return toxicity.score(docs, model, prefix=own).where(F.col(f"{own}predicted") == 0).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the document with the smallest doc_id stays."""
    return minhash.near_dedup(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of 50 words and more that a document with a smaller doc_id has go; untouched texts stay as they are."""
    own = unclashing(docs.columns, ["n_words", "n_removed", "kept_sha256", "kept_text", "repeats"])
    found = substrings.dedup_substrings(docs, prefix=own)
    changed = F.col(f"{own}n_removed") > 0
    found = found.withColumn("text", F.when(changed, F.col(f"{own}kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        chars = F.when(changed, F.char_length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated with benchmark items go."""
    own = unclashing(docs.columns, [name for name, _ in decontam.RESULT])
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), prefix=own)
    return found.where(~F.col(f"{own}contaminated")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: A trained classifier and a tokenizer are not SQL. Tests hold every stage and ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
