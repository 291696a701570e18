"""Path repair: match catalogue names to the names in their directories, on keys that forgive known damage."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.operators.names import similar  # noqa: F401

# Code points of invisible markers, and of quotes and what they fold to.
MARKERS = "[‪-‮​-‏﻿]"
QUOTES = "‘’‚‛ʼ´`“”„‟«»″"
PLAIN = "'''''''" + '"""""""'


@F.pandas_udf(T.StringType())
def strip_accents(names: pd.Series) -> pd.Series:
    """Canonical decomposition without non-spacing marks, composed again."""
    gone = lambda x: unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn"))
    return names.map(lambda x: None if x is None else x if x.isascii() else gone(x))


@F.pandas_udf(T.StringType())
def nfc(names: pd.Series) -> pd.Series:
    return names.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


@F.pandas_udf(T.StringType())
def nfd(names: pd.Series) -> pd.Series:
    return names.map(lambda x: None if x is None else unicodedata.normalize("NFD", x))


def strip_markers(name: Column) -> Column:
    return F.regexp_replace(name, MARKERS, "")


def fold_quotes(name: Column) -> Column:
    return F.translate(name, QUOTES, PLAIN)


def fix_backslashes(name: Column) -> Column:
    return F.replace(name, F.lit("\\"), F.lit(""))


def exact(name: Column) -> Column:
    return name


#: In order of preference.
STRATEGIES: list[tuple[str, Callable[[Column], Column]]] = [
    ("exact", exact),
    ("normal_form", nfc),
    ("markers", lambda c: nfc(strip_markers(c))),
    ("quotes", lambda c: nfc(fold_quotes(strip_markers(c)))),
    ("accents", lambda c: strip_accents(fold_quotes(strip_markers(c)))),
    ("accents_case", lambda c: F.lower(strip_accents(fold_quotes(strip_markers(c))))),
]


def match_names(wanted: DataFrame, disk: DataFrame, strategies=STRATEGIES) -> DataFrame:
    """``wanted(parent, db_name)`` with the first name of ``disk(parent, name)`` that a strategy finds, and which did.

    Every strategy is one equi-join on (parent, key), whose disk side has one row a key (the smallest name).
    """
    out = wanted
    for label, key in strategies:
        keyed = disk.groupBy("parent", key(F.col("name")).alias(f"_k_{label}")).agg(F.min("name").alias(f"_n_{label}"))
        out = out.withColumn(f"_k_{label}", key(F.col("db_name"))).join(keyed, ["parent", f"_k_{label}"], "left")
    found = F.coalesce(*(F.col(f"_n_{label}") for label, _ in strategies))
    method = F.coalesce(*(F.when(F.col(f"_n_{label}").isNotNull(), F.lit(label)) for label, _ in strategies))
    return out.select(*wanted.columns, found.alias("name"), method.alias("method"))


def deletions(name: Column, limit: int) -> Column:
    """Hashes of ``name`` with up to ``limit`` of its characters taken out, in number of the order of length to the power ``limit``."""

    def cut(kept: Column, rest: Column, left: int) -> Column:
        whole = F.array(F.xxhash64(F.concat(kept, rest)))
        if not left:
            return whole
        some = F.transform(F.sequence(F.lit(1), F.char_length(rest)), lambda i: cut(F.concat(kept, F.substring(rest, F.lit(1), i - 1)), F.substring(rest, i + 1, F.char_length(rest)), left - 1))
        return F.concat(whole, F.flatten(some))

    return F.array_distinct(cut(F.lit(""), name, limit))


def fuzzy_match(wanted: DataFrame, disk: DataFrame, limit: int = 2) -> DataFrame:
    """The nearest name of the same directory within ``limit`` edits, of any length; of equally near ones the smallest.

    Names within n edits have a deletion of up to n characters each in common, so each round is an equi-join on
    (parent, deletion) for one more edit, with the names that no round has matched and the disk names of their lengths.
    """
    names = disk.select("parent", "name").distinct()
    rest = wanted.select("parent", "db_name").where(F.col("parent").isNotNull() & F.col("db_name").isNotNull()).distinct()
    out = None
    for edits in range(limit + 1):
        n = F.char_length("db_name")
        lengths = rest.select("parent", F.explode(F.sequence(n - edits, n + edits)).alias("_len")).distinct()
        band = names.withColumn("_len", F.char_length("name")).join(lengths, ["parent", "_len"], "left_semi").select("parent", "name")
        left = rest.withColumn("_key", F.explode(deletions(F.col("db_name"), edits)))
        right = band.withColumn("_key", F.explode(deletions(F.col("name"), edits)))
        near = left.join(right, ["parent", "_key"]).withColumn("distance", F.levenshtein("db_name", "name", edits)).where("distance >= 0")
        found = near.groupBy("parent", "db_name").agg(F.min(F.struct("distance", "name")).alias("b")).select("parent", "db_name", "b.name", "b.distance")
        out = found if out is None else out.unionByName(found)
        if edits < limit:
            rest = rest.join(found.select("parent", "db_name"), ["parent", "db_name"], "left_anti")
    return out


def walk(paths: DataFrame, disk: DataFrame, depth: int, strategies=STRATEGIES) -> DataFrame:
    """Repair ``paths(pth)`` part by part against ``disk(parent, name)``: one round of joins a level, null if a part has no match."""
    rows = paths.select("pth", F.split("pth", "/").alias("_parts"), F.lit("").alias("_done"))
    for level in range(depth):
        wanted = rows.withColumn("parent", F.col("_done")).withColumn("db_name", F.try_element_at("_parts", F.lit(level + 1)))
        found = match_names(wanted, disk, strategies)
        longer = F.when(F.col("_done") == "", F.col("name")).otherwise(F.concat_ws("/", "_done", "name"))
        step = F.when(F.col("db_name").isNull(), F.col("_done")).when(F.col("_done").isNotNull() & F.col("name").isNotNull(), longer)
        rows = found.select("pth", "_parts", step.alias("_done"))
    return rows.select("pth", F.col("_done").alias("repaired"))


def outcome(repaired: DataFrame) -> DataFrame:
    state = F.when(F.col("repaired").isNull(), "not_found").when(F.col("repaired") == F.col("pth"), "unchanged").otherwise("renamed")
    return repaired.withColumn("outcome", state)


def collisions(mapping: DataFrame) -> DataFrame:
    """New paths that several old ones would get."""
    return mapping.groupBy("repaired").agg(F.count("*").alias("n")).where("n > 1")


def verify(fs: DataFrame, present: DataFrame) -> DataFrame:
    """Existence against the flag ``cantfind``."""
    joined = fs.join(present.select("pth", F.lit(True).alias("_p")).dropDuplicates(), "pth", "left")
    state = F.when(F.col("_p") & F.col("cantfind"), "found_but_flagged").when(F.col("_p").isNull() & ~F.col("cantfind"), "absent_not_flagged").otherwise("consistent")
    return joined.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def categories(fs: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Share of lost paths in each category (not exclusive), in whole percent."""
    lost = fs.where("cantfind")
    counted = lost.agg(F.count("*").alias("total"), *(F.count_if(F.col("pth").rlike(p)).alias(k) for k, p in patterns.items()))
    pairs = ", ".join(f"'{k}', {k}" for k in patterns)
    long = counted.select("total", F.expr(f"stack({len(patterns)}, {pairs}) AS (category, n)"))
    return long.select("category", "n", F.expr("CASE WHEN total = 0 THEN 0 ELSE (n * 100) DIV total END").alias("percent"))


def variants(name: Column) -> Column:
    """Spellings under which a name may be stored."""
    spaces = F.regexp_replace(name, " +", " ")
    dashes = F.translate(name, "–—", "--")
    return F.array_distinct(F.array(name, nfc(name), nfd(name), fold_quotes(name), dashes, spaces))


def non_ascii(name: Column) -> Column:
    return name.rlike("[^\\x00-\\x7F]")
