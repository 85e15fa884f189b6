"""Conversations rebuilt from their event logs and rendered with a loss mask, in DataFrame operations only.

Events have a conversation, a message number, a sequence number and a kind: `delta` appends text to the message, `edit` replaces
its text, `regenerate` discards it and waits for new deltas. The fold sorts a message's events and keeps those from the
last edit or regeneration on. Messages are then rendered in order:

    ### <role>: <text></turn>

with a line feed after each. In texts and roles a backslash becomes `\\b`, `#` becomes `\\h`, `<` becomes `\\l` and, in roles, `:`
becomes `\\c`. So no text can hold `###` or `</turn>`, and as every backslash is followed by one of these letters, the
replacements can be undone.

A conversation's mask is one entry (off, on, rest) for each turn, in code points: the header, what the loss is taken over, and the
end mark. The entries add up to the length of the rendered text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, END = "### ", "</turn>\n"
KINDS = ("delta", "edit", "regenerate")
EVENTS = "conv_id bigint, message bigint, seq bigint, kind string, role string, text string"


_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))


def escaped(text: Column, marks: str = "\\#<") -> Column:
    """The text with some marks replaced, the backslash first."""
    for mark, letter in _ESCAPES:
        text = F.replace(text, F.lit(mark), F.lit(letter)) if mark in marks else text
    return text


def unescaped(text: Column) -> Column:
    for mark, letter in reversed(_ESCAPES):
        text = F.replace(text, F.lit(letter), F.lit(mark))
    return text


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final messages of an event log.

    A null sequence number comes first; at one number, deltas come before edits and these before regenerations, and each kind goes by
    text. Repeated events are applied again. A null text adds nothing. The role is that of the first event that has one, else
    empty. A message without text stays, empty. Null conversations and messages are keys like others. Unknown kinds are errors.
    """
    known = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(F.raise_error(F.lit("unknown kind of event")))
    number = F.coalesce("seq", F.lit(-(1 << 63)))
    event = F.struct(number.alias("seq"), known.alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    rows = events.select("conv_id", "message", "role", event.alias("e"))
    folded = rows.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(F.when(F.col("e.kind") == "delta", F.struct("e.seq", "e.text")))).alias("deltas"),
        F.max(F.when(F.col("e.kind") != "delta", F.col("e"))).alias("reset"),
        F.min_by("role", F.when(F.col("role").isNotNull(), F.struct("e.seq", "role"))).alias("role"),
    )
    live = F.filter("deltas", lambda e: F.col("reset").isNull() | (e["seq"] > F.col("reset.seq")))
    begun = F.when(F.col("reset.kind") == "edit", F.col("reset.text")).otherwise("")
    text = F.concat(begun, F.array_join(F.transform(live, lambda e: e["text"]), ""))
    return folded.select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, mask): messages in order of number, then role and text; the mask covers texts of the role `learn`.

    A conversation becomes one value, so it must fit into one; its messages are rendered before they come together.
    """
    head = F.concat(F.lit(HEAD), escaped(F.col("role"), "\\#<:"), F.lit(": "))
    body = escaped(F.col("text"))
    learnt = F.when(F.col("role") == learn, F.char_length(body)).otherwise(0)
    run = F.struct(
        F.char_length(head).alias("off"), learnt.alias("on"), (F.char_length(body) - learnt + len(END)).alias("rest")
    )
    turn = F.struct("message", "role", "text", F.concat(head, body, F.lit(END)).alias("piece"), run.alias("run"))
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return turns.select("conv_id", F.array_join("turns.piece", "").alias("formatted"), F.col("turns.run").alias("mask"))


def parse(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, learnt): the turns (role, text) read back from rendered text, and the texts under its mask."""
    pieces = F.split("formatted", END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    role = r"^### ([^:]*): "

    def turn(piece: Column) -> Column:
        name = F.regexp_extract(piece, role, 1)
        text = F.regexp_replace(piece, role, "")
        return F.struct(unescaped(name).alias("role"), unescaped(text).alias("text"))

    under = F.zip_with(pieces, "mask", lambda p, m: F.substring(p, m["off"] + 1, m["on"]))
    return formatted.select(
        "conv_id", "formatted", F.transform(pieces, turn).alias("turns"), unescaped(F.array_join(under, "")).alias("learnt")
    )


def digest(formatted: DataFrame) -> DataFrame:
    """The contract's columns, from what is read back."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parse(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
