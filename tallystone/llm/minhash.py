r"""MinHash near-duplicates by a signature-coordinate inverted join.

Texts are lower-cased (A-Z only), words are ``[^\x20\x09-\x0D]+``, a document's set holds its distinct shingles of
``shingle`` words (all its words, if fewer). Two documents are linked if the Jaccard similarity of their sets is at
least ``percent`` / 100, confirmed on the full sets.

Equal sets are one node. A node's signature has ``coordinates`` minima; each (coordinate, value) is posted. Nodes
linked at the threshold share at least ``matches`` postings (but with a chance below 1e-5 at the very threshold;
``matches`` 1 leaves out only pairs without any common minimum).
Counting collisions with prefixes and skips: a posting that no other node has can't match, so nodes with fewer than
``matches`` shared postings are skipped at once; of the others only the ``coordinates - matches + 1`` rarest
postings open a list (two nodes with enough matches must meet in one of them), and lists with equal members are
merged only once. In a list, each node's signature is first compared with that of the list's leader; lists whose nodes
are all connected then are skipped. In the others, parts that are not connected are merged by comparing whole
signatures; what meets the match threshold joins one cluster, by a spanning forest instead of all pairs.

Within clusters, full sets are intersected, again leaving out pairs that are connected already; the confirmed links
give the components. In clusters over ``block`` nodes each set is first compared with that of a leader (the node that
most others matched), what differs from it with that of a second leader, and so on ``leaders`` times. Only where parts
are left, their sets meet in pairs of blocks. Lists and clusters over ``block`` nodes are dealt out as pairs of blocks
of which at least one is not of the group's largest part, so no task holds an unbounded group, and work is the group's
size times the number of its nodes outside that part.

Cases: null, empty or wordless texts have an empty set and are linked with nothing; rows of one doc_id are all kept
if that id is its component's smallest; a null doc_id is never the smallest of a component with others; an empty
table gives no rows; other columns pass through in ``near_dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm import graph
from tallystone.llm import text as tx
from tallystone.llm.storage import discard, materialize

SHINGLE = 5
PERCENT = 80
COORDINATES = 64
MATCHES = 36
BLOCK = 256
LEADERS = 3

_rng = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = _rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _rng.integers(0, 1 << 63, 256, np.uint64)


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    raw, offsets = tx.utf8(column)
    words = tx.Words(tx.ascii_lower(raw), offsets, tx.NON_SPACE)
    rolling = tx.Rolling(words.hashes())
    n = len(words)
    full = rolling.of(np.arange(max(0, n - shingle + 1)), shingle)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= shingle:
            yield np.unique(full[a : b - shingle + 1])
        elif b > a:
            yield rolling.of(np.array([a]), b - a)
        else:
            yield np.zeros(0, np.uint64)


def signature(items: np.ndarray, coordinates: int) -> np.ndarray:
    low = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    factors, terms = _FACTORS[:coordinates, None], _TERMS[:coordinates, None]
    for k in range(0, len(items), 4096):
        part = (items[None, k : k + 4096] * factors + terms) >> np.uint64(32)
        low = np.minimum(low, part.min(1).astype(np.uint32))
    return low


def set_id(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def _features(batches: Iterator[pa.RecordBatch], shingle: int, coordinates: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            sizes, ids, signs, seen = [], [], [], {}
            for items in shingle_sets(batch.column("text"), shingle):
                sizes.append(len(items))
                if not len(items):
                    ids.append(None)
                    signs.append(None)
                    continue
                name = set_id(items)
                if name not in seen:
                    seen[name] = signature(items, coordinates).tobytes()
                ids.append(name)
                signs.append(seen[name])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(signs, pa.binary())],
                names=["doc_id", "th", "n_shingles", "node", "signature"],
            )


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            data = [x.tobytes() for x in shingle_sets(batch.column("text"), shingle)]
            kept = [i for i, f in enumerate(batch.schema) if f.name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(data, pa.binary())], names=[*(batch.schema.names[i] for i in kept), "items"]
            )


def _postings(batches: Iterator[pa.RecordBatch], coordinates: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = 2000
        for k in range(0, batch.num_rows, step):
            part = batch.slice(k, step)
            values = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint32).reshape(-1, coordinates)
            tokens = values.astype(np.int64) | (np.arange(coordinates, dtype=np.int64) << 32)
            yield pa.RecordBatch.from_arrays(
                [part.column("pid").take(pa.array(np.repeat(np.arange(len(values)), coordinates))), pa.array(tokens.reshape(-1))], names=["pid", "token"]
            )


class Forest:
    """Union-find over the rows of one task's group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _matches(signs: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    counts = np.zeros((len(left), len(right)), np.uint8)
    for c in range(signs.shape[1]):
        counts += signs[left, c][:, None] == signs[right, c][None, :]
    return counts


def _pairs(side: np.ndarray, signs: np.ndarray, matches: int, part: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows that match often enough, most first: within the one block, or between the two."""
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    counts = _matches(signs, left, right)
    i, j = np.nonzero(counts >= matches)
    keep = (left[i] < right[j]) if not (side < 2).any() else slice(None)
    i, j = i[keep], j[keep]
    if part is not None:
        keep = part[left[i]] != part[right[j]]
        i, j = i[keep], j[keep]
    order = np.argsort(-counts[i, j].astype(np.int64), kind="stable")
    return left[i[order]], right[j[order]]


def _numbers(parts: list) -> np.ndarray:
    number = {p: i for i, p in enumerate(dict.fromkeys(parts))}
    return np.array([number[p] for p in parts])


def _likely(side: np.ndarray, rows: list[tuple], signs: np.ndarray, matches: int, percent: int) -> Iterator[tuple]:
    """Edges between parts that are not connected yet."""
    parts = [r[3] for r in rows]
    if len(rows) == 2:
        if parts[0] != parts[1] and int((signs[0] == signs[1]).sum()) >= matches:
            yield parts[0], parts[1]
        return
    part = _numbers(parts)
    forest = Forest(int(part.max()) + 1)
    for i, j in zip(*_pairs(side, signs, matches, part), strict=True):
        if forest.join(int(part[i]), int(part[j])):
            yield parts[i], parts[j]


def _alike(batches: Iterator[pa.RecordBatch], matches: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 2000):
            rows = batch.slice(k, 2000)
            one, two = (np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint32).reshape(rows.num_rows, -1) for c in ("signature", "other"))
            good = pa.array((one == two).sum(1) >= matches)
            yield pa.RecordBatch.from_arrays([rows.column("pid").filter(good), rows.column("leader").filter(good)], names=["a", "b"])


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(side: np.ndarray, rows: list[tuple], signs: np.ndarray, matches: int, percent: int) -> Iterator[tuple]:
    part = _numbers([r[3] for r in rows])
    forest = Forest(int(part.max()) + 1)
    sets = [np.frombuffer(r[4], np.uint64) for r in rows]
    # every pair of the cluster's parts: what the signatures find likely first
    for i, j in zip(*_pairs(side, signs, matches, part), strict=True):
        i, j = int(i), int(j)
        if forest.root(part[i]) != forest.root(part[j]) and _linked(sets[i], sets[j], percent):
            forest.join(part[i], part[j])
            yield rows[i][1], rows[j][1]


def _led(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Nodes whose set is linked with that of the leader beside it."""
    for batch in batches:
        good = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(batch.column("items"), batch.column("others"), strict=True)]
        good = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("node").filter(good), batch.column("leader").filter(good)], names=["a", "b"])


def _grouped(batches: Iterator[pa.RecordBatch], find: Callable, matches: int, percent: int, coordinates: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Applies ``find`` to each run of rows with one key; rows come sorted by key. One group at a time is in memory."""
    key, rows = None, []

    def edges() -> pa.RecordBatch | None:
        if len(rows) < 2:
            return None
        side = np.array([r[0] for r in rows])
        signs = np.frombuffer(b"".join(r[2] for r in rows), np.uint32).reshape(-1, coordinates)
        found = list(find(side, rows, signs, matches, percent))
        if not found:
            return None
        a, b = zip(*found, strict=True)
        type_ = pa.int64() if kind == "long" else pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(a, type_), pa.array(b, type_)], names=["a", "b"])

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "k3")), strict=True)
        columns = [c for c in ("side", "node", "signature", "part", "items") if c in batch.schema.names]
        for own, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in columns), strict=True), strict=True):
            if own != key:
                out = edges()
                if out is not None:
                    yield out
                key, rows = own, []
            rows.append(row)
    out = edges()
    if out is not None:
        yield out


def _groups(members: DataFrame, key: str) -> DataFrame:
    """Of each group of ``members(key, part)`` that has several parts: its size ``n``, its largest part and that part's size."""
    parts = members.groupBy(key, "part").agg(F.count("*").alias("m"))
    whole = parts.groupBy(key).agg(F.sum("m").alias("n"), F.count("*").alias("p"), F.max(F.struct("m", "part")).alias("h"))
    return whole.where("p > 1").select(key, "n", F.col("h.part").alias("heavy"), F.col("h.m").alias("m"))


def _dealt(members: DataFrame, groups: DataFrame, key: str, block: int) -> DataFrame:
    """``members`` by (key, pair of blocks): groups up to ``block`` whole, larger ones as pairs of blocks of that size.

    Blocks hold nodes of the largest part or nodes of all others; two blocks of the largest part need not meet.
    ``side``: 2 where a group, or one block with itself, is compared; else 0 and 1 for the two blocks.
    """
    whole, heavy = F.col("n") <= block, F.col("part") == F.col("heavy")
    hash_ = F.xxhash64("node")
    rest = F.col("n") - F.col("m")
    dealt = members.join(groups, key).withColumn("gh", F.ceil(F.col("m") / block).cast("int")).withColumn("gr", F.ceil(rest / block).cast("int"))
    dealt = dealt.withColumn("own", F.when(whole, 0).when(heavy, F.pmod(hash_, "gh")).otherwise(F.col("gh") + F.pmod(hash_, F.greatest("gr", F.lit(1)))).cast("int"))
    others = F.when(whole, F.array(F.lit(0))).otherwise(F.sequence(F.when(heavy, F.col("gh")).otherwise(F.lit(0)), F.col("gh") + F.col("gr") - 1))
    spread = dealt.select("*", F.explode(others).alias("other"))
    return spread.select(
        F.col(key).alias("k1"),
        F.least("own", "other").alias("k2"),
        F.greatest("own", "other").alias("k3"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        *(c for c in ("node", "signature", "part", "items") if c in members.columns),
    )


def _edges(dealt: DataFrame, find: Callable, matches: int, percent: int, coordinates: int, kind: str) -> DataFrame:
    spread = dealt.repartition("k1", "k2", "k3").sortWithinPartitions("k1", "k2", "k3", "side", "node")
    return tx.map_arrow(spread, lambda b: _grouped(b, find, matches, percent, coordinates, kind), f"a {kind}, b {kind}")


def _confirm(sets: DataFrame, degrees: DataFrame, matches: int, percent: int, coordinates: int, block: int, leaders: int) -> tuple[DataFrame, list[DataFrame]]:
    """Confirmed links of ``sets(node, pid, cluster, signature, items)``; ``degrees(pid, degree)``: how many nodes matched one."""
    sizes = materialize(sets.groupBy("cluster").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    scratch, found = [sizes], []
    big = sizes.where(F.col("n") > block)
    parts = None
    if leaders and not big.isEmpty():
        todo = sets.join(big.select("cluster"), "cluster", "left_semi").select("node", "pid", "cluster").join(degrees, "pid", "left")
        todo = materialize(todo.select("node", "cluster", F.coalesce("degree", F.lit(0)).alias("degree")), "todo")
        members = todo
        scratch.append(todo)
        for _ in range(leaders):
            first = todo.groupBy("cluster").agg(F.max(F.struct("degree", "node")).alias("l")).select("cluster", F.col("l.node").alias("leader"))
            first = first.join(sets.select(F.col("node").alias("leader"), F.col("items").alias("others")), "leader")
            first = materialize(first, "leaders")
            tested = sets.join(todo.select("node"), "node", "left_semi").select("node", "cluster", "items")
            tested = materialize(tested, "tested")
            pairs = tested.join(first, "cluster").where("node <> leader").select("node", "leader", "items", "others")
            linked = materialize(tx.map_arrow(pairs, lambda b: _led(b, percent), "a binary, b binary"), "linked")
            found.append(linked)
            gone = linked.select(F.col("a").alias("node")).unionByName(first.select(F.col("leader").alias("node")))
            todo = materialize(todo.join(gone, "node", "left_anti"), "todo")
            discard(first, tested)
            scratch += [linked, todo]
        own = found[0]
        for linked in found[1:]:
            own = own.unionByName(linked)
        parts = members.select("node").join(own.select(F.col("a").alias("node"), F.col("b").alias("part")), "node", "left").select("node", F.coalesce("part", "node").alias("part"))
    if parts is None:
        cut = sets.withColumn("part", F.col("node"))
    else:
        cut = sets.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    groups = materialize(_groups(cut.select("cluster", "part"), "cluster"), "groups")
    scratch.append(groups)
    links = _edges(_dealt(cut.select("cluster", "node", "signature", "part", "items"), groups, "cluster", block), _confirmed, matches, percent, coordinates, "binary")
    for linked in found:
        links = links.unionByName(linked)
    return links, scratch


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, coordinates: int = COORDINATES, matches: int = MATCHES, block: int = BLOCK, leaders: int = LEADERS
) -> DataFrame:
    """``doc_id, th, n_shingles, component_id, kept`` for every row of ``docs`` (``th``: hash of its text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    features = tx.map_arrow(texts, lambda b: _features(b, shingle, coordinates), "doc_id long, th long, n_shingles long, node binary, signature binary")
    features = materialize(features, "features")
    nodes = features.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("first"), F.min("doc_id").alias("least"), F.first("signature").alias("signature"))
    nodes = materialize(nodes.withColumn("pid", F.xxhash64("node")), "nodes")

    # lists hold short numbers for nodes; where two nodes have one number, both go on to the full sets
    signs = nodes.select("pid", "signature").dropDuplicates(["pid"])
    postings = tx.map_arrow(signs, lambda b: _postings(b, coordinates), "pid long, token long")
    # a table of its own, like others below: joins of plain exchanges can be split where a key is hot
    shared = materialize(postings.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    prefix = coordinates - matches + 1
    opened = (
        postings.join(shared, "token")
        .groupBy("pid")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("list"))
        .where(F.size("list") >= matches)
        # the postings that nobody shares are the rarest and take the first places
        .select("pid", F.explode(F.slice("list", 1, F.greatest(F.lit(0), F.lit(prefix - coordinates) + F.size("list")))["token"]).alias("token"))
    )
    opened = materialize(opened, "opened")
    lists = opened.groupBy("token").agg(
        F.count("*").alias("n"), F.min("pid").alias("leader"), F.bit_xor(F.xxhash64("pid")).alias("x"), F.bit_xor(F.xxhash64("pid", F.lit(7))).alias("y")
    )
    lists = lists.where("n > 1").groupBy("n", "x", "y").agg(F.min("token").alias("token"), F.min("leader").alias("leader"))
    lists = materialize(lists.select("token", "n", "leader"), "lists")

    # skip: what matches its list's leader needs no merging with the others that do
    led = opened.join(lists.select("token", "leader"), "token").where("pid <> leader").select("pid", "leader").distinct()
    # plain scans: where two nodes have one number, each is compared
    other = nodes.select(F.col("pid").alias("leader"), F.col("signature").alias("other"))
    led = led.join(nodes.select("pid", "signature"), "pid").join(other, "leader").select("pid", "leader", "signature", "other")
    early = materialize(tx.map_arrow(led, lambda b: _alike(b, matches), "a long, b long"), "early")
    joined = graph.components(early)
    group = joined.select(F.col("node").alias("pid"), F.col("component").alias("part"))
    members = opened.join(lists.select("token"), "token", "left_semi").join(group, "pid", "left").withColumn("part", F.coalesce("part", "pid"))
    members = materialize(members, "members")
    mixed = materialize(_groups(members, "token"), "mixed")
    signed = members.withColumnRenamed("pid", "node").join(nodes.select(F.col("pid").alias("node"), "signature"), "node")
    late = materialize(_edges(_dealt(signed, mixed, "token", block), _likely, matches, percent, coordinates, "long"), "late")
    discard(shared, opened, lists, members, mixed)
    merged = graph.components(late)
    whole = merged.select(F.col("node").alias("part"), F.col("component").alias("cluster"))
    alone = whole.select(F.col("part").alias("pid"), "part").join(group.select("pid"), "pid", "left_anti")
    clusters = group.unionByName(alone).join(whole, "part", "left").select("pid", F.coalesce("cluster", "part").alias("cluster"))
    clusters = clusters.join(nodes.select("node", "pid", "signature", "first"), "pid")

    picked = clusters.select("node", "pid", "cluster", "signature", F.col("first.doc_id").alias("_d"), F.col("first.th").alias("_t"))
    picked = picked.join(texts, F.col("_d").eqNullSafe(texts["doc_id"]) & (F.col("_t") == texts["th"])).select("node", "pid", "cluster", "signature", "text")
    sets = tx.map_arrow(picked, lambda b: _sets(b, shingle), "node binary, pid long, cluster long, signature binary, items binary").dropDuplicates(["node"])
    sets = materialize(sets, "sets")
    discard(late, joined, merged)
    degrees = materialize(early.groupBy(F.col("b").alias("pid")).agg(F.count("*").alias("degree")), "degrees")
    links, scratch = _confirm(sets, degrees, matches, percent, coordinates, block, leaders)
    found = graph.components(links)
    discard(early, degrees, sets, *scratch)

    least = materialize(found.join(nodes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id")), "least")
    named = found.join(least, "component").select("node", "component_id")
    own = materialize(nodes.select("node", "least").join(named, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id")), "own")
    discard(found, least, nodes)
    rows = features.drop("signature").join(own, "node", "left")
    rows = rows.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return rows.select("doc_id", "th", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that with the smallest doc_id."""
    kept = near_duplicates(docs, **options).where("kept").select(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["_d"]) & F.xxhash64(docs["text"]).eqNullSafe(kept["_t"]), "left_semi")
