r"""Repair of conversations whose turns are out of order of roles, blank, repeated or cut off.

A conversation's rows, by turn (nulls first), then role and text, carry a fault each, the first that holds: blank (no
``[^\x20\x09-\x0D]``), duplicate (role and text seen earlier), truncated (the last such character is not ``[.!?]``).
The cheapest edits make the roles' initials ``(s?(ua)+)?``: keep (0), delete (2, required for blank and duplicate),
rerole to user or assistant (1), insert an empty user or assistant row anywhere (5); a truncated row that stays costs 5
more. Of equally cheap edits the one whose initials, K D R I in order, are least in ASCII wins.

Trie-shared DP: what edits depend on is a conversation's signature, a character a row for role and fault. Distinct
signatures are range-sorted; each task walks its sorted run as a prefix trie, of which only the path to the current
signature is kept: a signature pops the layers behind the prefix that it shares with the one before, computes one layer
for each further character, and reads its answer off the last. A layer holds for each state of the role pattern the least
cost and, by rank, the least audit that reaches it: audits of one layer hold equally many edits of rows and end in one,
so none is a prefix of another and ranks order them without their texts. Memory is one path, whatever the number of
signatures; a signature met by a third of all conversations is solved once.

Faults, signatures and repaired texts are Spark expressions over one row a conversation, which must fit a task. Texts
don't reach Python.

Cases: null roles and texts are one space, so a null text is blank; a null conv_id is a conversation; rows of one turn
keep the order of role and text; repeated rows are duplicates; an empty role is one that only rerole or delete can mend;
gaps beyond 64 bits are null; a conversation that ``expected`` names and that has no rows gives zeros, an empty audit and
the hash of the empty string; an empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.llm import text as tx
from tallystone.llm.storage import adopt, materialize

#: What a row's edits cost.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the pattern: nothing yet, behind system, behind user, behind assistant. The first and last may end it.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Signature characters: initials of sound rows, their capitals where truncated, o and O for other roles.
GONE = "x"
SPACES = " \t\n\x0b\f\r"


def _inserted(state: int) -> Iterator[tuple[int, int]]:
    """States after 0, 1, 2 insertions; a third leads back to one that fewer reach."""
    yield 0, state
    for count in (1, 2):
        state = ASSISTANT if state == USER else USER
        yield count, state


def _moves(sign: str) -> list[tuple[int, str, int, int]]:
    """``(state, edits, cost, next state)``: insertions, then one edit of a row of this sign."""
    out = []
    extra = TRUNCATED if sign.isupper() else 0
    for state in range(4):
        for count, held in _inserted(state):
            before, paid = "I" * count, INSERT * count
            out.append((state, before + "D", paid + DELETE, held))
            if sign == GONE:
                continue
            if (held, sign.lower()) in _AFTER:
                out.append((state, before + "K", paid + KEEP + extra, _AFTER[held, sign.lower()]))
            out.append((state, before + "R", paid + REROLE + extra, ASSISTANT if held == USER else USER))
    return out


MOVES = {sign: _moves(sign) for sign in "suaoSUAO" + GONE}


class Trie:
    """The path of a prefix trie that leads to the signature met last, with a DP layer for each node.

    A layer is a list by state of ``(cost, rank, state before, edits since)`` or None.
    """

    def __init__(self):
        self.path = ""
        self.layers: list[list] = [[(0, 0, START, ""), None, None, None]]
        self.computed = 0

    def solve(self, signature: str) -> tuple[int, str]:
        """Cost and audit of ``signature``. Signatures may come in any order; sorted ones share the most."""
        shared = len(os.path.commonprefix([self.path, signature]))
        del self.layers[shared + 1 :]
        self.path = signature
        for sign in signature[shared:]:
            self.layers.append(self._layer(self.layers[-1], sign))
            self.computed += 1
        return self._answer()

    def _layer(self, before: list, sign: str) -> list:
        best: list = [None] * 4
        for state, edits, cost, then in MOVES[sign]:
            if before[state] is not None:
                paid, rank, *_ = before[state]
                found = (paid + cost, rank, edits, state)
                if best[then] is None or found < best[then]:
                    best[then] = found
        ranks = {key: i for i, key in enumerate(sorted((x[1], x[2]) for x in best if x))}
        return [x and (x[0], ranks[x[1], x[2]], x[3], x[2]) for x in best]

    def _answer(self) -> tuple[int, str]:
        ends = []
        for state, held in enumerate(self.layers[-1]):
            for count, then in _inserted(state) if held else ():
                if then in (START, ASSISTANT):
                    ends.append((held[0] + INSERT * count, held[1], "I" * count, state))
        cost, _, edits, state = min(ends)
        parts = [edits]
        for layer in reversed(self.layers[1:]):
            _, _, state, edits = layer[state]
            parts.append(edits)
        return cost, "".join(reversed(parts))


def plan(signature: str, audit: str) -> list[tuple[int, str | None]]:
    """The repaired rows: number of the row they stem from (-1: inserted), and their new role (None: as it is)."""
    out, row, state = [], -1, START
    for edit in audit:
        row += edit != "I"
        if edit == "D":
            continue
        if edit == "K":
            state = _AFTER[state, signature[row].lower()]
        else:
            state = ASSISTANT if state == USER else USER
        out.append((row if edit != "I" else -1, None if edit == "K" else _ROLE[state]))
    return out


_PLAN = pa.list_(pa.struct([("row", pa.int32()), ("role", pa.string())]))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = Trie()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            signatures = batch.column("signature").slice(start, 256).to_pylist()
            found = [trie.solve(s) for s in signatures]
            plans = [[{"row": r, "role": role} for r, role in plan(s, audit)] for s, (_, audit) in zip(signatures, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signatures), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found]), pa.array(plans, _PLAN)],
                names=["signature", "cost", "audit", "plan"],
            )


def solve(signatures: DataFrame) -> DataFrame:
    """``signature, cost, audit, plan`` for each distinct signature."""
    ranged = signatures.select("signature").distinct().repartitionByRange("signature").sortWithinPartitions("signature")
    return tx.map_arrow(ranged, _solved, "signature string, cost long, audit string, plan array<struct<row: int, role: string>>")


def conversations(turns: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """One row a conversation: ``conv_id, rows, signature, gaps, blank, duplicate, truncated, illegal``.

    ``rows`` are ``(turn, role, text, ...)`` in order. Conversations only in ``expected(conv_id)`` have none.
    """
    space = F.lit(" ")
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.lit(True).alias("here"))
    if expected is not None:
        none = expected.select("conv_id").distinct()
        none = none.select("conv_id", F.lit(None).cast("long").alias("turn"), space.alias("role"), space.alias("text"), F.lit(False).alias("here"))
        rows = rows.unionByName(none)
    seen = Window.partitionBy("conv_id", "here", "role", F.md5(F.encode("text", "utf-8"))).orderBy("turn")
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(F.length(bare) == 0, "b").when(F.row_number().over(seen) > 1, "d").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "t").otherwise("")
    initial = F.substring("role", 1, 1)
    sound = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    rows = rows.repartition("conv_id").withColumn("fault", fault).withColumn("initial", initial)
    rows = rows.withColumn("sign", F.when(F.col("fault").isin("b", "d"), GONE).when(F.col("fault") == "t", F.upper(sound)).otherwise(sound))
    kept = F.when(F.col("here"), F.struct("turn", "role", "text", "fault", "initial", "sign"))
    told = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(kept)).alias("rows"))
    one, two = F.slice("rows", 1, F.greatest(F.size("rows") - 1, F.lit(0))), F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(0)))
    joints = F.zip_with(one, two, lambda a, b: F.when(F.concat(a["initial"], b["initial"]).isin("su", "ua", "au"), 0).otherwise(1))
    turn = F.filter(F.col("rows.turn"), lambda t: t.isNotNull())
    gaps = F.array_max(turn).cast("decimal(38,0)") - F.array_min(turn) + 1 - F.size(F.array_distinct(turn))

    def count(fault: str) -> F.Column:
        return F.size(F.filter("rows", lambda r: r["fault"] == fault)).cast("long")

    return told.select(
        "conv_id",
        "rows",
        F.array_join("rows.sign", "").alias("signature"),
        F.when(F.size(turn) == 0, F.lit(0).cast("long")).otherwise(gaps.try_cast("long")).alias("gaps"),
        count("b").alias("blank"),
        count("d").alias("duplicate"),
        count("t").alias("truncated"),
        F.aggregate(joints, F.lit(0).cast("long"), lambda total, x: total + x).alias("illegal"),
    )


def repair(turns: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """One row a conversation: the columns of ``conversations``, ``cost``, ``audit`` and ``repaired``, an array of (role, text)."""
    told = materialize(conversations(turns, expected), "conversations")
    # a hot signature is joined without texts
    answers = told.select("conv_id", "signature").join(solve(told), "signature").drop("signature").withColumnRenamed("conv_id", "_conv")
    joined = told.join(answers, told["conv_id"].eqNullSafe(answers["_conv"])).drop("_conv")
    row = lambda p: F.get("rows", p["row"])
    repaired = F.transform("plan", lambda p: F.struct(F.coalesce(p["role"], row(p)["role"]).alias("role"), F.coalesce(row(p)["text"], F.lit("")).alias("text")))
    return adopt(joined.withColumn("repaired", repaired).drop("plan"), told)


def digest(repaired: DataFrame) -> DataFrame:
    """``repaired`` as numbers and the hash of its rows."""
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    return repaired.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(F.encode(F.array_join(lines, "\n"), "utf-8"), 256).alias("repaired_sha256")
    )


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with some rows dropped, emptied, cut off, repeated or given to the user, by a hash of conversation and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(F.encode(key, "utf-8")) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_")).drop("_")
