"""The similarity join against all pairs, and the spellings that are tried."""

import random

import pytest
from pyspark.sql import functions as F

from tallystone.operators import names

rng = random.Random(17)
WORDS = ["Corazón", "noche", "canción", "Amor", "Niño", "Pérez", "Live", "Remastered", "vol", "Günther", "Best", "of", "the", "sea"]


def title():
    return rng.choice([" ", "-", "_"]).join(rng.choice(WORDS) + rng.choice(["", "", str(rng.randint(0, 99))]) for _ in range(rng.randint(1, 5)))


def edited(name, edits):
    chars = list(name)
    for _ in range(edits):
        i = rng.randrange(len(chars) + 1)
        what = rng.random()
        if what < 0.4 and i < len(chars):
            chars[i] = rng.choice("abxyzé")
        elif what < 0.7:
            chars.insert(i, rng.choice("abxyz "))
        elif i < len(chars) and len(chars) > 1:
            del chars[i]
    return "".join(chars)


@pytest.fixture(scope="module")
def listing(spark):
    disk = [(f"d{k % 3}", title()) for k in range(2000)] + [("d0", "x" * 300), ("d0", ""), ("d1", "a"), (None, "x"), ("d1", None)]
    asked = [(p, edited(n, rng.choice([0, 1, 1, 2, 3, 5]))) for p, n in rng.sample(disk[:2000], 300)]
    asked += [(p, names.plain(n)) for p, n in rng.sample(disk[:2000], 50)] + [("d0", "x" * 280), ("d0", ""), ("d1", "b"), ("d9", "sea"), (None, "x"), ("d0", None), asked[0]]
    return spark.createDataFrame(asked, "parent string, db_name string"), spark.createDataFrame(disk, "parent string, name string")


@pytest.mark.parametrize("ratio", [0.85, 0.9])
def test_no_pair_is_lost(listing, ratio):
    asked, disk = listing
    pairs = asked.distinct().join(disk.distinct(), "parent").where(names.similarity(F.col("db_name"), F.col("name")) > ratio)
    want = {tuple(r) for r in pairs.where("db_name <> name").select("parent", "db_name", "name").collect()}
    found = names.candidates(asked, disk, ratio).where("db_name <> name")
    kept = {tuple(r) for r in found.where(names.similarity(F.col("db_name"), F.col("name")) > ratio).collect()}
    assert len(want) > 100 and kept == want
    with pytest.raises(ValueError, match="share a gram"):
        names.candidates(asked, disk, 0.8)


def test_best_match(listing):
    asked, disk = listing
    found = {(r["parent"], r["db_name"]): (r["name"], r["score"]) for r in names.similar(asked, disk).collect()}
    pairs = asked.dropna().distinct().join(disk.dropna().distinct(), "parent").select("parent", "db_name", "name", names.similarity(F.col("db_name"), F.col("name")).alias("s")).collect()
    want = {}
    for r in pairs:
        score = 1.0 if r["name"] == r["db_name"] else names.VARIANT if names.is_variant(r["name"], r["db_name"]) else r["s"] if r["s"] is not None and r["s"] > 0.85 else None
        if score is not None:
            kind = (score != 1.0 or r["name"] != r["db_name"], not (score == names.VARIANT and names.is_variant(r["name"], r["db_name"])))
            key, own = (r["parent"], r["db_name"]), (*kind, -score, r["name"])
            want[key] = min(want.get(key, own), own)
    assert found == {k: (v[3], round(-v[2], 6)) for k, v in want.items()}
    assert len(found) > 200 and names.VARIANT in {s for _, s in found.values()}


def test_spellings():
    assert names.allowed("Niño") == {"Niño", "Nino"}
    assert names.allowed("xyz") == {"xyz"}
    assert names.allowed("cancion") == {"cancion", "cancioñ", "canción", "cancióñ", "cancíon"}
    assert names.is_variant("Jose-Perez", "José-Pérez") and not names.is_variant("Jose_Perez", "José-Pérez") and not names.is_variant("Jose", "José-Pérez")


def test_a_large_directory_meets_few_names(spark):
    """20 000 names of one directory and 1 000 asked for: the join makes a small part of the 20 million pairs."""
    parts = ["".join(rng.choice("bcdfghlmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(2000)]
    stems = sorted({" ".join(rng.choice(parts) for _ in range(rng.randint(3, 5))) for _ in range(21_000)})[:20_000]
    disk = spark.createDataFrame([("d", n) for n in stems], "parent string, name string")
    asked = spark.createDataFrame([("d", edited(n, 2)) for n in rng.sample(stems, 1000)], "parent string, db_name string")
    assert names.candidates(asked, disk).count() < 20_000_000 / 100
