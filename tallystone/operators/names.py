"""The most similar name of the same directory, by a prefix join on q-grams: no name meets all others."""

from __future__ import annotations

import itertools
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATIO = 0.85
#: Score of a name that differs in accents alone, in ways that are tried.
VARIANT = 0.95
Q = 3

#: What accents are tried on which letters, in order.
ACCENTED = {"a": "aá", "e": "eé", "i": "ií", "o": "oó", "u": "uúü", "n": "nñ", "A": "AÁ", "E": "EÉ", "I": "IÍ", "O": "OÓ", "U": "UÚÜ", "N": "NÑ"}
VARIANTS = 5


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")


def allowed(word: str) -> set[str]:
    """Spellings of a word that are tried: without its accents, or, if it has none, the first few with some."""
    base = plain(word)
    if base != word:
        return {word, base}
    return set(map("".join, itertools.islice(itertools.product(*(ACCENTED.get(c, c) for c in word)), VARIANTS)))


def is_variant(name: str, target: str) -> bool:
    """Whether ``name`` is ``target`` with each of its words in one of the spellings that are tried."""
    one, two = (x.replace("-", " ").replace("_", " ") for x in (name, target))
    if len(name) != len(target) or any((a in " -_" or b in " -_") and a != b for a, b in zip(name, target, strict=True)):
        return False
    own, wanted = one.split(), two.split()
    return len(own) == len(wanted) and all(a in allowed(b) for a, b in zip(own, wanted, strict=True))


@F.pandas_udf(T.BooleanType())
def _variant(names: pd.Series, targets: pd.Series) -> pd.Series:
    return pd.Series([is_variant(a, b) for a, b in zip(names, targets, strict=True)], dtype=bool)


@F.pandas_udf(T.StringType())
def _plain(names: pd.Series) -> pd.Series:
    return names.map(plain)


def _edits(name: Column, ratio: float) -> Column:
    """The most edits that may lie between a name and a longer one whose similarity is above ``ratio``."""
    return (F.ceil(F.char_length(name) * (1 - ratio) / ratio + 1e-9) - 1).cast("int")


def _prefixes(rows: DataFrame, name: str, frequency: DataFrame, ratio: float) -> DataFrame:
    """``parent, name, edits, gram, at``: of each name the q * edits + 1 grams that are rarest on disk.

    Names within so many edits share a gram of both prefixes, as an edit changes at most q grams.
    """
    n = F.char_length(name)
    grams = F.transform(F.sequence(F.lit(0), F.greatest(n - Q, F.lit(0))), lambda i: F.struct(F.substring(name, i + 1, F.lit(Q)).alias("gram"), i.alias("at")))
    each = rows.select("parent", F.col(name), F.inline(grams)).join(frequency, "gram", "left")
    ordered = each.groupBy("parent", name).agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram", "at"))).alias("g"))
    edits = _edits(F.col(name), ratio)
    kept = F.slice("g", 1, Q * edits + 1)
    return ordered.where(edits > 0).select("parent", name, edits.alias(f"{name}_edits"), F.inline(kept)).drop("df")


def candidates(wanted: DataFrame, disk: DataFrame, ratio: float = RATIO) -> DataFrame:
    """Distinct ``parent, db_name, name`` that may be similar: a common gram of both prefixes, at places and in lengths that so many edits allow.

    Below a ratio of 0.85 short names may be similar without a common gram, so such ratios raise an error.
    """
    if ratio < RATIO:
        raise ValueError(f"names less similar than {RATIO} need not share a gram")
    names = disk.select("parent", "name").where("parent IS NOT NULL AND name IS NOT NULL").distinct()
    asked = wanted.select("parent", "db_name").where("parent IS NOT NULL AND db_name IS NOT NULL").distinct()
    # only directories that are asked for
    names = names.join(asked.select("parent").distinct(), "parent", "left_semi")
    n = F.char_length("name")
    grams = F.transform(F.sequence(F.lit(0), F.greatest(n - Q, F.lit(0))), lambda i: F.substring("name", i + 1, F.lit(Q)))
    frequency = names.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").agg(F.count("*").alias("df"))
    left, right = _prefixes(asked, "db_name", frequency, ratio), _prefixes(names, "name", frequency, ratio).withColumnRenamed("at", "place")
    near = left.join(right, ["parent", "gram"])
    edits = F.greatest("db_name_edits", "name_edits")
    near = near.where((F.abs(F.col("at") - F.col("place")) <= edits) & (F.abs(F.char_length("db_name") - F.char_length("name")) <= edits))
    return near.select("parent", "db_name", "name").distinct()


def similarity(one: Column, two: Column) -> Column:
    """1 - edits / length of the longer; two empty names are the same."""
    return 1 - F.levenshtein(one, two) / F.greatest(F.char_length(one), F.char_length(two), F.lit(1))


def similar(wanted: DataFrame, disk: DataFrame, ratio: float = RATIO) -> DataFrame:
    """``parent, db_name, name, score``: for each of ``wanted(parent, db_name)`` the best name of ``disk(parent, name)``.

    In order: the same name (1), the smallest that differs in accents as tried (0.95), the most similar above ``ratio``
    (of equally similar ones the smallest). Names without any are left out, so are nulls. Repeated rows count once.
    """
    names = disk.select("parent", "name").where("parent IS NOT NULL AND name IS NOT NULL").distinct()
    asked = wanted.select("parent", "db_name").where("parent IS NOT NULL AND db_name IS NOT NULL").distinct()
    same = asked.join(names.withColumn("db_name", F.col("name")), ["parent", "db_name"]).select("parent", "db_name", "name", F.lit(1.0).alias("score"))
    rest = asked.join(same.select("parent", "db_name"), ["parent", "db_name"], "left_anti")
    spelt = rest.withColumn("_key", _plain("db_name")).join(names.withColumn("_key", _plain("name")), ["parent", "_key"]).where(_variant("name", "db_name"))
    spelt = spelt.groupBy("parent", "db_name").agg(F.min("name").alias("name")).select("parent", "db_name", "name", F.lit(VARIANT).alias("score"))
    rest = rest.join(spelt.select("parent", "db_name"), ["parent", "db_name"], "left_anti")
    scored = candidates(rest, names, ratio).withColumn("score", similarity(F.col("db_name"), F.col("name"))).where(F.col("score") > ratio)
    best = scored.groupBy("parent", "db_name").agg(F.min(F.struct((-F.col("score")).alias("s"), "name")).alias("b"))
    return same.unionByName(spelt).unionByName(best.select("parent", "db_name", "b.name", F.round(-F.col("b.s"), 6).alias("score")))
