"""The n-gram Jaccard join, conversation repair and centroid clustering against brute force, and their odd inputs."""

import hashlib
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystone.llm import centroids, convrepair, vertical

rng = random.Random(11)


# --- n-gram Jaccard join


def shingles(text, k):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def linked(a, b, percent):
    return 100 * len(a & b) >= percent * len(a | b)


def brute_components(docs, k, percent):
    sets = [shingles(t, k) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        if sets[i] and sets[j] and linked(sets[i], sets[j], percent):
            up[max(root(i), root(j))] = min(root(i), root(j))
    ids = {}
    for i, (d, _) in enumerate(docs):
        ids.setdefault(root(i), []).append(d)
    least = {r: min((x for x in found if x is not None), default=None) for r, found in ids.items()}
    return sorted(((d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=repr)


def text(n, words=400):
    return " ".join(f"w{rng.randint(0, words)}" for _ in range(n))


def edited(source, edits):
    words = source.split()
    for _ in range(edits):
        i = rng.randrange(len(words))
        what = rng.random()
        if what < 0.4:
            words[i] = f"x{rng.randint(0, 9999)}"
        elif what < 0.7:
            del words[i]
        else:
            words.insert(i, f"y{rng.randint(0, 50)}")
        words = words or ["z"]
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    """Groups of near copies around the threshold, common passages, chains, exact copies, short and odd texts."""
    passage = text(40)
    docs = []
    for size in (6, 20, 60, 150, 400):
        base = text(size)
        docs += [base, base.upper(), base]
        docs += [edited(base, max(1, size // rng.choice([25, 40, 60, 100]))) for _ in range(25)]
        drift = base
        for _ in range(8):
            drift = edited(drift, max(1, size // 50))
            docs.append(drift)
    docs += [f"{passage} {text(rng.randint(1, 30))}" for _ in range(40)] + [f"{text(rng.randint(1, 4))} {passage}" for _ in range(15)]
    docs += ["", None, "one", "One", "two words", "three little words", "   \t ", "a " * 700, "a " * 300, text(5000)]
    rng.shuffle(docs)
    rows = [(i, t) for i, t in enumerate(docs)]
    return rows + [(None, docs[0]), (None, None), (3, docs[3]), (4, "another text under the same id")]


@pytest.mark.parametrize(("percent", "block", "screen"), [(85, 256, 4), (80, 16, 2), (85, 8, 1)])
def test_join_components(spark, corpus, percent, block, screen):
    df = spark.createDataFrame([(*r, 1, "x") for r in corpus], "doc_id long, text string, node int, token string")
    found = vertical.components(df, shingle=4, percent=percent, block=block, screen=screen).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_components(corpus, 4, percent)


def test_join_links(spark, corpus):
    """All pairs of different sets, once each, with the exact overlap."""
    members, pairs = vertical.links(spark.createDataFrame(corpus, "doc_id long, text string"), shingle=4, percent=85, block=16, fragments=5)
    by_node = {}
    own = {d: shingles(t, 4) for d, t in corpus if d not in (None, 4)}
    for r in members.collect():
        if r["doc_id"] in own and r["node"] is not None:
            by_node[bytes(r["node"])] = own[r["doc_id"]]
    found = {}
    for r in pairs.collect():
        a, b = by_node.get(bytes(r["a"])), by_node.get(bytes(r["b"]))
        if a is not None and b is not None:
            assert frozenset((a, b)) not in found and (r["na"], r["nb"]) == (len(a), len(b))
            found[frozenset((a, b))] = r["common"]
    different = set(by_node.values())
    want = {frozenset((a, b)): len(a & b) for a, b in itertools.combinations(different, 2) if linked(a, b, 85)}
    assert len(want) > 100 and found == want


def test_join_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert vertical.components(empty).collect() == []
    alone = spark.createDataFrame([(2, None), (1, ""), (5, "just one text of some words")], "doc_id long, text string")
    assert sorted(tuple(r) for r in vertical.components(alone).collect()) == [(1, 0, 1), (2, 0, 2), (5, 2, 5)]
    members, pairs = vertical.links(alone)
    assert members.count() == 3 and pairs.count() == 0


def test_join_of_a_large_group_makes_few_pairs(spark, monkeypatch):
    """Near copies of one text, half of them beyond the threshold from all others: what is linked with the leader, and
    what is too far from it, is not paired."""
    base = text(300, 100_000)
    docs = [(0, base)] + [(i, edited(base, 6 if i % 2 else 30)) for i in range(1, 300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counts, born = [], vertical._Cut.born

    def counted(*args):
        pairs = born(*args)
        counts.append(pairs.count())
        return pairs

    monkeypatch.setattr(vertical._Cut, "born", counted)
    found = vertical.components(df, shingle=4, percent=85, block=64).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_components(docs, 4, 85)
    vertical.links(df, shingle=4, percent=85, block=64)
    assert counts[0] < 600 and counts[1] > 5_000, counts


# --- conversation repair

PATTERN = re.compile(r"(s?(ua)+)?\Z")
PREFIX = re.compile(r"s?(ua)*u?\Z")


def brute_edits(signs):
    """The cheapest edits by trying all; ``signs``: (initial, must go, truncated)."""
    best = (10**9, "")

    def step(i, out, audit, cost, inserted):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(signs) and PATTERN.match(out):
            best = min(best, (cost, audit))
        if inserted < 4:
            for role in "ua":
                if PREFIX.match(out + role):
                    step(i, out + role, audit + "I", cost + 5, inserted + 1)
        if i < len(signs):
            initial, gone, cut = signs[i]
            step(i + 1, out, audit + "D", cost + 2, inserted)
            if not gone:
                if initial in ("s", "u", "a") and PREFIX.match(out + initial):
                    step(i + 1, out + initial, audit + "K", cost + 5 * cut, inserted)
                for role in "ua":
                    if PREFIX.match(out + role):
                        step(i + 1, out + role, audit + "R", cost + 1 + 5 * cut, inserted)

    step(0, "", "", 0, 0)
    return best


def test_trie_against_all_edits():
    signatures = ["".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(0, 6))) for _ in range(700)]
    trie = convrepair.Trie()
    for s in sorted(signatures):
        assert trie.solve(s) == brute_edits([(c.lower(), c == "x", c.isupper()) for c in s])
    assert trie.computed < sum(map(len, signatures)) / 2  # prefixes are shared
    unsorted = convrepair.Trie()
    assert [unsorted.solve(s) for s in signatures[:50]] == [convrepair.Trie().solve(s) for s in signatures[:50]]


def test_trie_of_a_long_signature():
    s = "s" + "uaxU" * 10_000
    cost, audit = convrepair.Trie().solve(s)
    assert len(audit.replace("I", "")) == len(s) and cost == 10_000 * 2 + min(10_000 * 2, 10_000 * 10)
    assert PATTERN.match("".join("suao"[("system", "user", "assistant").index(r)] if r else s[i].lower() for i, r in convrepair.plan(s, audit)))


def brute_repair(rows, ids):
    """The query's contract in plain Python."""
    out = []
    for conv in ids:
        mine = []
        for c, turn, role, said in rows:
            if c != conv:
                continue
            role, said = " " if role is None else role, " " if said is None else said
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            said = "" if kind == 1 else re.sub("[.!?]", "", said) if kind == 2 else said
            mine += [(turn, "user" if kind == 4 else role, said)] * (2 if kind == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, said in mine:
            bare = re.sub(r"[\x20\x09-\x0D]", "", said)
            faults.append("b" if not bare else "d" if (role, said) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, said))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, audit = brute_edits([(r[1][:1], f in ("b", "d"), f == "t") for r, f in zip(mine, faults, strict=True)])
        i, last, lines = 0, "", []
        for e in audit:
            if e != "I":
                _, role, said = mine[i]
                i += 1
            if e == "D":
                continue
            if e != "K":
                role = "assistant" if last == "u" else "user"
            lines.append(f"{role}:{'' if e == 'I' else said}")
            last = role[:1]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def test_repair_of_damaged_conversations(spark):
    said = ["Yes.", "No!", "cut off", "Why? ", "", "  \t", None, "Ünïcode…", "end.\n", "a\x85"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for c in [*range(90), None]:
        n = rng.randint(0, 6)
        rows += [(c, rng.choice([t, t, t, t + 3, None, 0]), rng.choice(roles[: 4 if rng.random() < 0.7 else 9]), rng.choice(said)) for t in range(n)]
    rows += [(200, 7, "user", "x."), (201, None, None, None), (202, 5, "user", "Hi."), (202, 5, "user", "Hi."), (203, -9, "system", "S."), (203, 4, "user", "Q?")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, rows string")
    found = convrepair.digest(convrepair.repair(convrepair.damage(df), expected=df))
    ids = list(dict.fromkeys(r[0] for r in rows))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_repair(rows, ids)


def test_repair_gives_texts(spark):
    turns = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (1, 2, "user", " "), (2, 0, "user", "Cut"), (3, None, "user", None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in convrepair.repair(df).collect()}
    assert [(r["role"], r["text"]) for r in found[1]["repaired"]] == [("user", "Be kind."), ("assistant", "Hello.")] and found[1]["audit"] == "RKDD" and found[1]["cost"] == 5
    assert found[2]["audit"] == "D" and found[3]["audit"] == "D" and found[3]["gaps"] == 0 and found[3]["blank"] == 1
    assert convrepair.digest(convrepair.repair(df.limit(0), expected=df.limit(0))).collect() == []
    far = spark.createDataFrame([(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")], df.schema)
    assert convrepair.repair(far).first()["gaps"] is None


def test_many_turns_of_one_conversation(spark):
    n = 20_000
    turns = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat(id, '.') AS text")
    found = convrepair.digest(convrepair.repair(turns)).first()
    assert found["cost"] == 0 and found["audit"] == "K" * n
    assert found["repaired_sha256"] == hashlib.sha256("\n".join(f"{'assistant' if i % 2 else 'user'}:{i}." for i in range(n)).encode()).hexdigest()


# --- centroid clustering


def brute_clusters(rows, size, k, rounds):
    vectors = [(i, [(Fraction(x) * 1024).__floor__() for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in vectors), key=lambda x: x[0])[:k]
    own = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(own))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in vectors]
        for j in range(len(own)):
            mine = [v for (_, v), c in zip(vectors, at, strict=True) if c == j]
            if mine:
                own[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [(i, *nearest(v)) for i, v in vectors]
    inertia = [sum(d for _, d, c in last if c == j) for j in range(len(own))]
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in own]

    def fits(x):
        return x if x < 1 << 63 else None

    return sorted((i, c, fits(d), fits(inertia[c]), fits(sum(inertia)), name[c]) for i, d, c in last)


SCALES = {"plain": 1.0, "coarse": 2.0**-9, "large": 2.0**25, "wide": 2.0**60, "huge": 1e290}


@pytest.mark.parametrize("scale", SCALES)
def test_clusters(spark, scale):
    """Also where float32 can't tell: components of a few units, many ties, numbers far beyond 64 bits."""
    numbers = np.random.default_rng(4)
    values = numbers.integers(-3, 4, (150, 6)) * (1.0 if scale == "coarse" else numbers.random((150, 6)))
    rows = [(int(i), [float(x) * SCALES[scale] for x in v]) for i, v in enumerate(values)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (400, None), (401, [1.0]), (402, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (405, [-0.0] * 6)]
    if scale == "huge":
        rows += [(500, [1.0] * 6), (501, [2.0**62] * 6)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, cluster int")
    found = centroids.cluster(df, size=6, k=5, rounds=6)
    assert sorted(map(tuple, found.collect())) == brute_clusters(rows, 6, 5, 6)


def test_screening_keeps_the_nearest():
    """Clustered far from the origin float32 products carry no digit of the distances; the intervals say so."""
    numbers = np.random.default_rng(9)
    far = numbers.integers(1 << 33, 1 << 34, (1, 16))
    vectors = far + numbers.integers(-2, 3, (400, 16))
    nearest = centroids.Nearest([[int(x) for x in v] for v in vectors[:6]])
    assert (nearest.shortlist(vectors).sum(axis=1) > 1).all()
    number, apart = nearest.of(vectors)
    assert [(int(d), int(c)) for c, d in zip(number, apart, strict=True)] == [min((centroids.distance(v.tolist(), c), j) for j, c in enumerate(nearest.centroids)) for v in vectors]
    near = numbers.normal(0, 300, (2000, 64)).astype(np.int64)
    nearest = centroids.Nearest([[int(x) for x in v] for v in near[:8]])
    assert (nearest.shortlist(near).sum(axis=1) == 1).mean() > 0.95  # and float32 does most of the work elsewhere


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([], schema), size=2).collect() == []
    rows = [(None, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [5.0, 2.0])]
    found = sorted(map(tuple, centroids.cluster(spark.createDataFrame(rows, schema), size=2).collect()), key=repr)
    assert [(r[0], r[1], r[2]) for r in found] == [(1, 0, 0), (1, 1, 0), (None, 0, 0)]
