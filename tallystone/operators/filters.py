"""Conditions over names: word lists, parts without accents, folders, trees. Null names meet none of them."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystone.operators.paths import strip_accents
from tallystone.operators.spelling import without_accents


def _quoted(words: Iterable[str]) -> str:
    return "|".join(re.escape(w) for w in sorted(set(words), key=lambda w: (-len(w), w)))


def has_word(name: Column, words: Iterable[str]) -> Column:
    """One of ``words`` as a whole word, in any case; of none, false."""
    words = list(words)
    return F.coalesce(name.rlike(rf"(?iuU)\b(?:{_quoted(words)})\b") if words else F.lit(False), F.lit(False))


def has_part(name: Column, parts: Iterable[str]) -> Column:
    """One of ``parts`` anywhere, letter by letter: ``%``, ``_`` and quotes mean themselves."""
    found = [F.contains(name, F.lit(p)) for p in parts]
    return F.coalesce(_any(found), F.lit(False))


def has_part_without_accents(name: Column, parts: Iterable[str]) -> Column:
    """The same, in lower case and without accents on either side; the name is rewritten once for all parts."""
    plain = {without_accents(p).lower() for p in parts}
    return F.coalesce(F.lower(strip_accents(name)).rlike(_quoted(plain)) if plain else F.lit(False), F.lit(False))


def below(path: Column, folder: str) -> Column:
    """Paths in a folder or deeper; a folder whose name only begins alike is another one."""
    return F.coalesce(path.startswith(folder.rstrip("/") + "/"), F.lit(False))


def in_trees(tree: Column, trees: Iterable[str]) -> Column:
    return F.coalesce(tree.isin(*trees), F.lit(False))


def _any(found: list[Column]) -> Column:
    whole = F.lit(False)
    for one in found:
        whole = whole | one
    return whole


def listed(rows_of_lists: Column) -> Column:
    """The different paths of a list, in the list's order, nulls left out: ``SELECT DISTINCT`` over an array before it is exploded."""
    return F.array_distinct(F.filter(rows_of_lists, lambda p: p.isNotNull()))
