"""MinHash near-duplicates against brute force on whole sets."""

import random
import re

import pytest

from tallystone.llm import minhash

rng = random.Random(11)


def brute(rows, shingle, percent):
    """Shingles and component of every row."""
    sets = []
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        size = min(shingle, len(words)) or 1
        sets.append({tuple(words[a : a + size]) for a in range(len(words) - size + 1)} if words else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (doc, text) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, len(s), least.get(root(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]


def drift(words, many, step):
    """Texts that each change ``step`` words of the one before: neighbours are alike, the ends are not."""
    found = [words]
    for _ in range(many - 1):
        words = list(words)
        for _ in range(step):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        found.append(words)
    return found


@pytest.fixture(scope="module")
def rows():
    base = [f"Base{rng.randrange(40)}" for _ in range(150)]
    texts = [" ".join(t) for t in drift(base, 25, 2)]
    template = [f"T{i}" for i in range(120)]
    for _ in range(25):  # all near one template
        own = list(template)
        own[rng.randrange(120)] = f"x{rng.randrange(999)}"
        texts.append(" ".join(own))
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(15)]
    texts += [texts[0], texts[30], "two words", "Two  words", "", "one", "ONE", None, "é " * 30, "\t \n", " ".join(base * 300)]
    found = list(zip(rng.sample(range(1000), len(texts)), texts, strict=True))
    return [*found, found[3], (found[5][0], "something else entirely here now"), (None, texts[2]), (None, "nobody's own text here")]


@pytest.mark.parametrize(("shingle", "block", "leaders"), [(4, 4, 2), (5, 2, 0)])
def test_components_equal_brute_force(spark, rows, shingle, block, leaders):
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=shingle, block=block, leaders=leaders, matches=30).collect()
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=repr)
    assert found == sorted(brute(rows, shingle, 80), key=repr)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_near_dedup_keeps_one_of_each_and_other_columns(spark, rows):
    schema = "doc_id long, text string, th int, node string, component_id string, kept int"
    df = spark.createDataFrame([(*r, i, "n", "c", i) for i, r in enumerate(rows)], schema)
    out = minhash.near_dedup(df).collect()
    want = sorted((i for i, ((doc, _), (_, _, c)) in enumerate(zip(rows, brute(rows, 5, 80), strict=True)) if doc == c))
    assert sorted(r["kept"] for r in out) == want and out[0].asDict().keys() == set(df.columns)
    assert minhash.near_dedup(df.limit(0)).count() == 0


def test_recall_of_the_match_threshold():
    """Of pairs at the very similarity of 0.8, all but few have the matches that the search asks for."""
    import numpy as np

    r = np.random.default_rng(1)
    got = []
    for _ in range(400):
        items = np.unique(r.integers(0, 1 << 63, 1000, np.uint64))[:900]
        a, b = items[:810], np.concatenate([items[:720], items[810:]])  # 720 of 900
        got.append((minhash.signature(a, minhash.COORDINATES) == minhash.signature(b, minhash.COORDINATES)).sum())
    assert min(got) >= minhash.MATCHES and abs(np.mean(got) / minhash.COORDINATES - 0.8) < 0.02
