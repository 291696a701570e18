r"""Chat formatting with Spark expressions only.

A conversation becomes one string of blocks, one block for each run of adjacent turns of one role::

    <s>ROLE[INST]text[/INST][INST]text[/INST]</s>

``<s>``, ``</s>``, ``[INST]`` and ``[/INST]`` are control strings. Inside roles and texts a backslash is put behind
the opening bracket of each control string (``</s>`` becomes ``<\/s>``; one that has backslashes there gets one
more), so no text can end a turn, and taking one backslash away restores it exactly.

The loss mask names blocks (the pieces between one ``</s>`` and the next), and for each a list of spans ``(start,
length)`` in code points within it: the escaped texts of assistant turns, without any control string. Arrays of n spans
are made and read in pieces of about the square root of n, as Spark copies an array that grows in an aggregate and
counts code points from the start of a string.

Cases: null text or role counts as empty; turns are ordered by turn (null first), then role, then text, so ties and
repeated rows have one order; a null conv_id is a conversation of its own; an empty table gives no rows; columns
beyond the four named are ignored. One conversation is one row of output, so it must fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNED_ROLE = "assistant"

_ESCAPE = r"(<|\[)(\\*)(/?s>|/?INST\])"
_UNESCAPE = r"(<|\[)\\(\\*)(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def _pieces(array: Column) -> Column:
    """An array cut into pieces of about the square root of its size."""
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(array)))).cast("int")
    count = F.ceil(F.size(array) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: F.slice(array, i * size + 1, size))


def _running(array: Column, start: Column, step, kind: str, item) -> Column:
    """``item`` of the running value and each element, where ``step`` gives the value after an element."""
    zero = F.struct(start.cast("int").alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    merge = lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(item(acc["at"], x))).alias("out"))
    return F.aggregate(array, zero, merge)["out"]


def _settled(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``df`` with further columns, behind a generator of one row: the optimizer would else put an array's expression into
    a lambda that reads the array, which computes it again for every element."""
    return df.select(*keep, F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans array<struct<block,spans:array<struct<start,length>>>>`` for ``turns(conv_id, turn, role, text)``."""
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    escaped = _settled(collected, ["conv_id"], turns=F.transform("turns", lambda t: F.struct(t["role"].alias("raw"), escape(t["role"]).alias("role"), escape(t["text"]).alias("text"))))
    # first turn of each run of one role; the next run's first turn ends it
    raw = lambda i: F.element_at("turns", i)["raw"]
    first = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (i == 1) | (raw(i) != raw(F.greatest(i - 1, F.lit(1)))))
    opened = _settled(escaped, ["conv_id", "turns"], first=first)

    def run(a: Column, k: Column) -> Column:
        own = F.slice("turns", a, F.coalesce(F.try_element_at("first", k + 2), F.size("turns") + 1) - a)
        head = F.element_at("turns", a)
        sizes = F.transform(own, lambda t: F.char_length(t["text"]))
        return F.struct(k.cast("int").alias("block"), head["raw"].alias("raw_role"), head["role"].alias("role"), F.transform(own, lambda t: t["text"]).alias("texts"), sizes.alias("sizes"))

    runs = _settled(opened, ["conv_id"], runs=F.transform("first", run))
    block = lambda r: F.concat(F.lit("<s>"), r["role"], F.lit("[INST]"), F.array_join(r["texts"], "[/INST][INST]"), F.lit("[/INST]</s>"))

    def spans(r: Column) -> Column:
        """The places of a block's texts: sums of their sizes, first over pieces of the array, then within each."""
        pieces = _pieces(r["sizes"])
        totals = F.transform(pieces, lambda p: F.aggregate(p, F.lit(0), lambda at, n: at + n + 13))  # [/INST][INST]
        head = F.char_length(r["role"]) + F.lit(9)  # <s>ROLE[INST]
        starts = _running(totals, head, lambda at, n: at + n, "int", lambda at, n: at)
        place = lambda at, n: F.struct(at.alias("start"), n.alias("length"))
        each = lambda p, start: _running(p, start, lambda at, n: at + n + 13, "struct<start:int,length:int>", place)
        return F.struct(r["block"].alias("block"), F.flatten(F.zip_with(pieces, starts, each)).alias("spans"))

    learned = F.filter("runs", lambda r: r["raw_role"] == LEARNED_ROLE)
    return runs.select(
        "conv_id",
        F.array_join(F.transform("runs", block), "").alias("formatted"),
        F.transform(learned, spans).alias("loss_spans"),
    )


def parse_conversations(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns array<struct<role,text>>, loss_text, formatted_chars`` read back from the formatted strings."""
    blocks = F.expr(r"slice(split(formatted, '</s>', -1), 1, size(split(formatted, '</s>', -1)) - 1)")

    def turns_of(b: Column) -> Column:
        head = F.split(b, r"\[INST\]", 2)
        body = F.element_at(head, 2)
        role = unescape(F.substring(F.element_at(head, 1), 4, 2_147_483_647))
        texts = F.split(body.substr(F.lit(1), F.char_length(body) - 7), r"\[/INST\]\[INST\]", -1)  # without the last [/INST]
        # an array of one, so that role and texts are made once for a block
        once = F.array(F.struct(role.alias("role"), texts.alias("texts")))
        return F.flatten(F.transform(once, lambda x: F.transform(x["texts"], lambda t: F.struct(x["role"].alias("role"), unescape(t).alias("text")))))

    def texts_of(b: Column) -> Column:
        """The texts of a block's spans: its part that each piece of the spans lies in, and the spans in that."""
        text = F.element_at("blocks", b["block"] + 1)

        def of_piece(piece: Column) -> Column:
            first, last = F.element_at(piece, 1)["start"], F.element_at(piece, -1)
            part = F.array(text.substr(first + 1, last["start"] + last["length"] - first))
            return F.flatten(F.transform(part, lambda t: F.transform(piece, lambda s: unescape(t.substr(s["start"] - first + 1, s["length"])))))

        return F.array_join(F.flatten(F.transform(_pieces(b["spans"]), of_piece)), "")

    loss = F.transform("loss_spans", texts_of)
    return _settled(formatted, ["conv_id", "formatted", "loss_spans"], blocks=blocks).select(
        "conv_id",
        F.flatten(F.transform("blocks", turns_of)).alias("turns"),
        F.array_join(loss, "").alias("loss_text"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def digest(parsed: DataFrame) -> DataFrame:
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )
