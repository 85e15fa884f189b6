"""Repair of conversations whose structure is broken, by the cheapest edits.

A row's first fault counts: `blank` (no character but blanks), `duplicate` (its role and text stand earlier in the conversation),
`truncated` (its last character other than blanks is no `.`, `!` or `?`). Edits are K keep (0), R rerole to user or assistant (1),
D delete (2, required for blank and duplicate rows) and I insert an empty turn of the user or assistant (5); a truncated row that
stays adds 5. Afterwards the roles' initials must read `(s?(ua)+)?`; where a rerole or an insertion stands, the pattern leaves one
role only, so the letters say all. Of the cheapest edits those come out whose letters are the ASCII-least.

Costs are a vector over the pattern's four states for each place of a conversation, computed backward. Only the vectors at every
sqrt(n)-th place are kept; going forward, the vectors of one block are computed again from the checkpoint behind it, and each
step takes the least letter that is tight (its cost and the cost behind it add up to the vector's). So a conversation of n rows needs
sqrt(n) vectors, beside a byte for each row.

Rows come together twice by conversation, sorted by Spark, which spills: first without texts, for the audit (one value for each
conversation, so its length must fit into one); then the texts are walked along with the audit's letters, one at a time.

Nulls: a null role or text is one space, null turns come first, a null conv_id is a conversation of its own. Rows of the same turn are
ordered by their digests; repeated rows are rows of their own. Role and text are compared by 128 bits of digest. Empty tables
give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.batches import arrow_schema, rows_batch
from flowloom.sources.staging import stage

RATE = 20
#: Faults in the order in which they count.
FAULTS = ("blank", "duplicate", "truncated")
LEGAL = frozenset(("su", "ua", "au"))
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_FAR = 1 << 60
#: The state after an insertion or a rerole, the role that it gives, and the state after a row is kept.
_AFTER = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = ("user", "user", "assistant", "user")
_KEPT = {"s": (_SYSTEM, None, None, None), "u": (_USER, _USER, None, _USER), "a": (None, None, _ASSISTANT, None)}
_END = (0, _FAR, _FAR, 0)
_BLANK = r"[\x20\x09-\x0D]"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the rows, some of them dropped, emptied, without full stops, repeated or given to the user."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    draw = F.pmod(F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")), F.lit(RATE))
    copies = F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    said = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text["text"], "[.!?]", "")).otherwise(text["text"])
    rows = conversations.select(
        "conv_id", "turn", F.when(draw == 4, "user").otherwise(text["role"]).alias("role"), said.alias("text"), draw.alias("draw"),
        F.explode(copies).alias("copy"),
    )
    return rows.filter("draw <> 0").select("conv_id", "turn", "role", "text")


def _prepared(rows: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    read = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    return read.select(
        "conv_id",
        F.lit(1).alias("kind"),
        "turn",
        F.xxhash64(F.lit("x"), "role", "text").alias("x"),
        F.xxhash64(F.lit("y"), "role", "text").alias("y"),
        "role",
        "text",
    )


#: Of one conversation: its header, then its rows by turn, null first. Rows that are equal in all of this are equal.
_ORDER = ["conv_id", "kind", "turn", "x", "y"]


def _together(headers: DataFrame, rows: DataFrame) -> DataFrame:
    every = headers.unionByName(rows, allowMissingColumns=True)
    return every.repartition("conv_id").sortWithinPartitions(*_ORDER)


_CODES = {(i, f): k for k, (i, f) in enumerate((i, f) for i in "sua-" for f in ("", "must", "truncated"))}


def _moves(initial: str, fault: str) -> tuple:
    """For each state: (letter, cost, next state) of what may be done with such a row, by letter."""
    more = TRUNCATED if fault == "truncated" else 0
    out = []
    for state in range(4):
        moves = [("D", DELETE, state)]
        if fault != "must":
            kept = _KEPT.get(initial, (None,) * 4)[state]
            moves += [("K", more, kept)] if kept is not None else []
            moves += [("R", REROLE + more, _AFTER[state])]
        out.append(tuple(moves))
    return tuple(out)


_MOVES = [_moves(*key) for key in _CODES]


def _with_insertions(costs: list[int]) -> tuple[int, int, int, int]:
    start, system, user, assistant = costs
    to_user, to_assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(start, INSERT + to_user), min(system, INSERT + to_user), to_user, to_assistant


def _before(code: int, behind: tuple) -> tuple:
    """The costs in front of a row, from those behind it."""
    return _with_insertions([min(cost + behind[state] for _, cost, state in moves) for moves in _MOVES[code]])


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """The least cost of edits for the rows with these codes, and the ASCII-least letters at this cost."""
    size = len(codes)
    step = isqrt(size) + 1
    here = _with_insertions(list(_END))
    checkpoints = {size: here}
    for i in range(size - 1, -1, -1):
        here = _before(codes[i], here)
        if i % step == 0:
            checkpoints[i] = here
    cost, letters, state = here[_START], [], _START
    for first in range(0, size + 1, step):
        last = min(first + step, size)
        block = [checkpoints[last]]
        for i in range(last - 1, first - 1, -1):
            block.append(_before(codes[i], block[-1]))
        # A place at a border is walked with the block that begins there; the very last place belongs to the last block.
        for i in range(first, last if first + step <= size else last + 1):
            costs = block[last - i]
            while True:
                row = _MOVES[codes[i]][state] if i < size else ()
                behind = block[last - i - 1] if i < size else None
                tight = [(letter, to) for letter, c, to in row if c + behind[to] == costs[state]]
                after = _AFTER[state]
                tight += [("I", after)] if INSERT + costs[after] == costs[state] else []
                if not tight:
                    break
                letter, state = min(tight)
                letters.append(letter)
                if letter != "I":
                    break
    return cost, "".join(letters)


AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, open_at = arrow_schema(AUDIT), None

    def closed() -> tuple:
        conv, codes, counts, turns, _ = open_at
        cost, audit = cheapest_edits(bytes(codes))
        low, high, distinct = turns
        gaps = high - low + 1 - distinct if distinct else 0
        return conv, gaps, *[counts[f] for f in (*FAULTS, "illegal")], cost, audit

    for batch in batches:
        out = []
        for conv, kind, turn, initial, fault in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if kind == 0:
                if open_at:
                    out.append(closed())
                open_at = [conv, bytearray(), dict.fromkeys((*FAULTS, "illegal"), 0), (0, 0, 0), None]
                continue
            _, codes, counts, (low, high, distinct), previous = open_at
            if fault:
                counts[fault] += 1
            if previous is not None and previous + initial not in LEGAL:
                counts["illegal"] += 1
            open_at[4] = initial
            codes.append(_CODES[initial if initial in _KEPT else "-", "must" if fault in FAULTS[:2] else fault])
            if turn is not None and (not distinct or turn != high):
                open_at[3] = (turn if not distinct else low, turn, distinct + 1)
        yield rows_batch(out, schema)
    if open_at:
        yield rows_batch([closed()], schema)


def audits(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conv_id of `conversations`, from its `rows`."""
    some = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(rf"[.!?]{_BLANK}*+\z")
    fault = F.when(~some, FAULTS[0]).when(F.lit(True), F.when(~ended, FAULTS[2]).otherwise(""))
    codes = _prepared(rows).select(
        "conv_id", "kind", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "x", "y"
    )
    headers = conversations.select(F.col("conv_id").cast("long")).distinct().withColumn("kind", F.lit(0))
    again = F.row_number().over(Window.partitionBy("conv_id", "kind", "x", "y").orderBy("turn")) > 1
    counted = F.when((F.col("fault") != FAULTS[0]) & again, FAULTS[1]).otherwise(F.col("fault"))
    every = headers.unionByName(codes, allowMissingColumns=True).repartition("conv_id").withColumn("fault", counted)
    ordered = every.sortWithinPartitions(*_ORDER).select("conv_id", "kind", "turn", "initial", "fault")
    return ordered.mapInArrow(_audits, AUDIT)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(header, None) for each conversation, then (header, (role, text, letter)) for each of its repaired turns."""
    names = [*AUDIT.replace(" long", "").replace(" string", "").split(", "), "kind", "role", "text"]
    header, audit, at, state = None, "", 0, _START

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            yield header, (_ROLE[state], "", "I")
            at, state = at + 1, _AFTER[state]

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in names]
        for *values, kind, role, text in zip(*columns, strict=True):
            if kind == 0:
                yield from inserted()
                header, audit, at, state = tuple(values), values[-1], 0, _START
                yield header, None
                continue
            yield from inserted()
            letter, at = audit[at], at + 1
            if letter == "K":
                yield header, (role, text, letter)
                state = _KEPT[role[0]][state]
            elif letter == "R":
                yield header, (_ROLE[state], text, letter)
                state = _AFTER[state]
    yield from inserted()


REPAIRED = "conv_id long, place long, role string, text string, edit string"
DIGEST = f"{AUDIT}, repaired_sha256 string"
#: Rows and characters of texts in a batch that a task gives back.
_ROWS, _CHARS = 1000, 4 << 20


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, out, place, size = arrow_schema(REPAIRED), [], 0, 0
    for header, turn in _walk(batches):
        if turn is None:
            place = 0
            continue
        out.append((header[0], place, *turn))
        place, size = place + 1, size + len(turn[1])
        if len(out) >= _ROWS or size >= _CHARS:
            yield rows_batch(out, schema)
            out, size = [], 0
    yield rows_batch(out, schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, out, state, first, last = arrow_schema(DIGEST), [], None, True, None
    for header, turn in _walk(batches):
        if turn is None:
            if state:
                out.append((*last, state.hexdigest()))
            if len(out) >= _ROWS:
                yield rows_batch(out, schema)
                out = []
            state, first, last = hashlib.sha256(), True, header
            continue
        state.update(f"{'' if first else chr(10)}{turn[0]}:{turn[1]}".encode())
        first = False
    if state:
        out.append((*last, state.hexdigest()))
    yield rows_batch(out, schema)


def _walked(rows: DataFrame, audited: DataFrame, run: Callable, schema: str) -> DataFrame:
    return _together(audited.withColumn("kind", F.lit(0)), _prepared(rows)).mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the turns that remain, in order from 0, with the letter that each got."""
    return _walked(rows, stage(audits(rows, rows), "audits"), _turns, REPAIRED)


def repair_digest(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The audit of each conv_id of `conversations`, whose rows are `rows`, and the digest of its repaired `role:text` lines."""
    return _walked(rows, stage(audits(rows, conversations), "audits"), _digests, DIGEST)
