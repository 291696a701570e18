r"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

Texts are lower-cased (A-Z only), words are ``[^\x20\x09-\x0D]+``, a document's set holds its distinct shingles of
``shingle`` words (all its words as one, if fewer). Documents are linked where 100 * intersection >= ``percent`` * union,
counted on the full sets, each n-gram as a 64-bit hash. Equal sets are one node.

1. Screening by one vertical fragment, the n-grams with the smallest ``1 / screen`` of all hashes: a node with n n-grams
   that is linked with another misses at most floor((100 - percent) n / 100) of them there. So a node with more n-grams
   in this fragment that no other node has is linked with nothing, and is done.
2. The n-grams of the others are ordered globally, rarest first, and the order is cut into ``fragments`` of about equally
   many postings; a node's set is cut at the same places into segments. N-grams that one node has alone come first and
   are only counted.
3. Pairs are born in the lists of the n-grams that stand early enough in both sets (prefixes), in which some set has its
   n-gram early enough to be the smaller of a pair (index prefix).
4. Each fragment counts the overlap of its two segments for each pair, and the partial overlaps are summed per pair.

``components`` doesn't need all pairs: each member of a list is first tried with the list's leader, the set with the
smallest share of n-grams of its own; then lists whose members are all connected are skipped, and in the others a pair is
born only across parts, if lengths, places of the n-gram and, by the triangle inequality, the distances from the leader
allow it. Lists over ``block`` nodes are dealt out as pairs of blocks of which at least one is not of the largest part.
``links`` gives every pair of linked nodes and the membership of documents in nodes.

Cases: null, empty or wordless texts have an empty set and are linked with nothing; rows of one doc_id stay rows; a null
doc_id is the smallest of a component only alone or among nulls; an empty table gives no rows. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm import graph, minhash
from tallystone.llm import text as tx
from tallystone.llm.storage import adopt, discard, materialize

SHINGLE = 5
PERCENT = 80
SCREEN = 4
FRAGMENTS = 8
BLOCK = 256


def _features(batches: Iterator[pa.RecordBatch], shingle: int, screen: int) -> Iterator[pa.RecordBatch]:
    limit = np.uint64((1 << 64) // screen - 1)
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            sizes, ids, parts = [], [], []
            for items in minhash.shingle_sets(batch.column("text"), shingle):
                sizes.append(len(items))
                ids.append(minhash.set_id(items) if len(items) else None)
                parts.append(items[: np.searchsorted(items, limit, side="right")].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(parts, pa.list_(pa.int64()))],
                names=["doc_id", "th", "n_shingles", "node", "part"],
            )


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, "text"):
            items = [x.view(np.int64) for x in minhash.shingle_sets(batch.column("text"), shingle)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(items, pa.list_(pa.int64()))], names=["node", "items"])


def _misses(n: str, percent: int) -> F.Column:
    """How many of a set's n-grams a set that it is linked with may lack."""
    return F.floor(F.col(n) * (100 - percent) / 100)


def _linked(percent: int) -> F.Column:
    return F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("common"))


def _allowed(rows: list[tuple], percent: int, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of one list, or of two blocks of it, between which a pair may be born."""
    side, size, place, near = (np.array([r[i] for r in rows]) for i in (0, 2, 3, 4))
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    a, b = size[left][:, None], size[right][None, :]
    good = part[left][:, None] != part[right][None, :]
    good &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    good &= (100 + percent) * np.minimum(a - place[left][:, None], b - place[right][None, :]) >= percent * (a + b)
    good &= np.abs(near[left][:, None] - near[right][None, :]) <= (100 - percent) / 100 + 1e-9
    i, j = np.nonzero(good)
    i, j = left[i], right[j]
    keep = i < j if (side == 2).all() else slice(None)
    return i[keep], j[keep]


def _born(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of each run of rows with one key; rows come sorted by key. One list, or two blocks of one, is in memory."""
    key, rows = None, []

    def pairs() -> pa.RecordBatch:
        number = {p: i for i, p in enumerate(dict.fromkeys(r[5] for r in rows))}
        i, j = _allowed(rows, percent, np.array([number[r[5]] for r in rows], np.int64))
        found = [(rows[x], rows[y]) if rows[x][1] < rows[y][1] else (rows[y], rows[x]) for x, y in zip(i, j, strict=True)]
        columns = [[x[1] for x, _ in found], [y[1] for _, y in found], [x[2] for x, _ in found], [y[2] for _, y in found]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["a", "b", "na", "nb"])

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "k3")), strict=True)
        items = batch.column("items")
        columns = [batch.column("side"), batch.column("node"), *(items.field(c) for c in ("n", "place", "near")), batch.column("part")]
        for own, row in zip(keys, zip(*(c.to_pylist() for c in columns), strict=True), strict=True):
            if own != key:
                if len(rows) > 1:
                    yield pairs()
                key, rows = own, []
            rows.append(row)
    if len(rows) > 1:
        yield pairs()


class _Cut:
    """Nodes that passed the screening, their segments and their prefix lists."""

    def __init__(self, sets: DataFrame, percent: int, fragments: int):
        postings = sets.select("node", F.size("items").cast("long").alias("n"), F.explode("items").alias("token"))
        shared = materialize(postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "shared")
        # rare first; the fraction orders n-grams of one frequency
        rank = F.col("df") + F.shiftrightunsigned("token", 11) / F.lit(float(1 << 53))
        ordered = materialize(postings.join(shared, "token").select("node", "n", "token", rank.alias("rank")), "ordered")
        discard(shared)
        shares = [i / fragments for i in range(1, fragments)]
        cuts = ordered.agg(F.percentile_approx("rank", shares, 10_000)).first()[0] or [] if shares else []
        fragment = sum((F.when(F.col("rank") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
        whole = ordered.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("rank", "token"))).alias("items"))
        own, misses = F.col("n") - F.size("items"), _misses("n", percent)
        whole = whole.withColumn("own", own).where(F.col("own") <= misses)
        self.segments = materialize(
            ordered.groupBy("node", fragment.alias("fragment")).agg(F.collect_list("token").alias("items")).join(whole.select("node"), "node", "left_semi"), "segments"
        )
        early = whole.select("node", "n", "own", F.posexplode(F.slice("items", 1, (misses + 1 - F.col("own")).cast("int"))))
        place = F.col("own") + F.col("pos")
        index = F.lit(100 + percent) * (F.col("n") - place) >= F.lit(2 * percent) * F.col("n")
        early = early.select(F.col("col.token").alias("token"), "node", "n", place.alias("place"), index.alias("index"), (F.col("own") / F.col("n")).alias("lone"))
        self.early = materialize(early, "early")
        discard(ordered)

    def common(self, pairs: DataFrame) -> DataFrame:
        """``a, b, na, nb, common`` of ``pairs(a, b, na, nb)``: each fragment counts alone, then a pair's counts are summed."""
        one = self.segments.select(F.col("node").alias("a"), "fragment", F.col("items").alias("x"))
        two = self.segments.select(F.col("node").alias("b"), "fragment", F.col("items").alias("y"))
        partial = pairs.join(one, "a").join(two, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("x", "y")).cast("long").alias("partial"))
        return partial.groupBy("a", "b", "na", "nb").agg(F.sum("partial").alias("common"))

    def born(self, members: DataFrame, percent: int, block: int) -> DataFrame:
        """Pairs across parts of ``members(token, node, part, items)``, ``items`` being ``(n, place, near)``."""
        groups = materialize(minhash._groups(members.select("token", "part"), "token"), "groups")
        dealt = minhash._dealt(members, groups, "token", block).repartition("k1", "k2", "k3").sortWithinPartitions("k1", "k2", "k3", "side", "node")
        pairs = materialize(tx.map_arrow(dealt, lambda b: _born(b, percent), "a binary, b binary, na long, nb long").distinct(), "born")
        discard(groups)
        return pairs

    def discard(self) -> None:
        discard(self.segments, self.early)


def _nodes(docs: DataFrame, shingle: int, percent: int, screen: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their nodes; nodes with their smallest document; the sets of nodes that may be linked."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    features = materialize(
        tx.map_arrow(texts, lambda b: _features(b, shingle, screen), "doc_id long, th long, n_shingles long, node binary, part array<long>"), "features"
    )
    known = features.where("node IS NOT NULL")
    # an n-gram is a node's own where all its postings name that node, however many copies it has
    pid = F.xxhash64("node")
    posted = known.select(pid.alias("pid"), F.explode("part").alias("token")).groupBy("token").agg(F.min("pid").alias("pid"), F.max("pid").alias("other"))
    lone = posted.where("pid = other").groupBy("pid").agg(F.count("*").alias("lone"))
    nodes = known.groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("first"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"))
    nodes = materialize(nodes.withColumn("pid", pid).join(lone, "pid", "left").withColumn("open", F.coalesce("lone", F.lit(0)) <= _misses("n", percent)), "nodes")
    picked = nodes.where("open").select("node", F.col("first.doc_id").alias("_d"), F.col("first.th").alias("_t"))
    picked = picked.join(texts, F.col("_d").eqNullSafe(texts["doc_id"]) & (F.col("_t") == texts["th"])).select("node", "text")
    sets = materialize(tx.map_arrow(picked, lambda b: _sets(b, shingle), "node binary, items array<long>").dropDuplicates(["node"]), "sets")
    return features.drop("part"), nodes.select("node", "least", "n"), sets


def links(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, screen: int = SCREEN, fragments: int = FRAGMENTS, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Membership ``doc_id, n_shingles, node`` of every row, and every linked pair ``a, b, na, nb, common`` of different nodes."""
    features, _, sets = _nodes(docs, shingle, percent, screen)
    cut = _Cut(sets, percent, fragments)
    members = cut.early.select("token", "node", F.col("node").alias("part"), F.struct("n", "place", F.lit(0.0).alias("near")).alias("items"))
    pairs = cut.born(members, percent, block)
    found = materialize(cut.common(pairs).where(_linked(percent)), "links")
    discard(sets, pairs)
    cut.discard()
    return features.select("doc_id", "n_shingles", "node"), found


def components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, screen: int = SCREEN, fragments: int = FRAGMENTS, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    features, nodes, sets = _nodes(docs, shingle, percent, screen)
    cut = _Cut(sets, percent, fragments)
    discard(sets)
    lists = cut.early.groupBy("token").agg(F.count("*").alias("m"), F.min(F.when(F.col("index"), F.struct("lone", "node", "n"))).alias("l"))
    lists = materialize(lists.where("m > 1 AND l IS NOT NULL").select("token", F.col("l.node").alias("leader"), F.col("l.n").alias("nb")), "lists")
    met = cut.early.join(lists, "token")
    tests = materialize(met.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"), F.col("n").alias("na"), "nb").distinct(), "tests")
    common = materialize(cut.common(tests), "common")
    near = materialize(common.where(_linked(percent)), "near")
    joined = graph.components(near.select("a", "b"))

    part = joined.select("node", F.col("component").alias("part"))
    apart = common.select(F.col("a").alias("node"), F.col("b").alias("leader"), (1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).alias("near"))
    members = met.select("token", "node", "n", "place", "leader").join(apart, ["node", "leader"], "left").join(part, "node", "left")
    distance = F.coalesce("near", F.when(F.col("node") == F.col("leader"), 0.0).otherwise(1.0))
    members = members.select("token", "node", F.coalesce("part", "node").alias("part"), F.struct("n", "place", distance.alias("near")).alias("items"))
    members = materialize(members, "members")
    pairs = cut.born(members, percent, block)
    rest = materialize(cut.common(pairs).where(_linked(percent)), "rest")
    discard(lists, tests, common, joined, members, pairs)
    cut.discard()
    found = graph.components(near.select("a", "b").unionByName(rest.select("a", "b")))
    discard(near, rest)

    least = materialize(found.join(nodes, "node").groupBy("component").agg(F.min("least").alias("component_id")), "least")
    own = nodes.join(found, "node", "left").join(least, "component", "left").select("node", F.coalesce("component_id", "least").alias("component_id"))
    own = materialize(own, "own")
    discard(found, least)
    rows = features.join(own, "node", "left").withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return adopt(rows.select("doc_id", "n_shingles", "component_id"), own)
