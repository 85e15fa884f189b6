"""The trie of all prefixes of conversations that are rebuilt from a base conversation's head and their own suffix.

Conversation c is rebuilt as the first h original turns of its base c - c % 100 (fewer if it has fewer, none if it is absent)
and its own turns after its first h, with h = crc32 of the decimal c, modulo 6. Rebuilt texts are never made. A turn is a
reference (its conversation and place) with a digest of 128 bits and its length; from then on only these are moved.

A sequence of turns is an element (length, value) of a monoid: the value is a polynomial in a fixed multiplier over the turns'
digests modulo a prime, two elements compose to (n + m, v * B^m + w), and a known front can be cancelled. The fingerprint of a
rebuilt prefix is the product of the base's head, read from a table of heads of at most five turns, with the product of the own
suffix. Turns are range-partitioned in order, so a conversation of any length lies over many tasks: each task folds its rows, and a
conversation that began in an earlier task is finished by composing that task's rows with the product of what lies before.

Groups of prefixes with one fingerprint are the nodes. Nothing rests on hashes alone: first all (role, text) with one digest are
shown to be equal; then all members of a node must have the same last turn and the same parent, so by induction the same turns. If
either fails, all is done again with other multipliers.

Sums over a node's subtree need no walk through the tree. Let m be the smallest member of a node; the nodes whose smallest member is c are
the last ones on c's path, from some depth on. Characters of c before that depth are saved: those of c from the node down to that depth
are the characters that other conversations hold already. So saved_tokens is a sum over the members c other than m of
(characters of c before its own nodes) - (characters before the node), and n_leaves counts the members whose own path ends in a leaf.

Nulls: role and text become empty, null turns come first, rows without a conv_id belong to no conversation and are left out. Rows with
the same turn are ordered by their digests; repeated rows are turns of their own. c % 100 has the sign of c. An empty table gives no node.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowloom.llm.batches import arrow_schema, rows_batch
from flowloom.llm.heavy import heavy_joined
from flowloom.sources.staging import stage

GROUP, HEADS = 100, 6
#: (prime, multiplier) of each attempt; the next one is taken if two different turns or prefixes share a fingerprint.
MULTIPLIERS = (
    ((1 << 127) - 1, 0x2545F4914F6CDD1D9E3779B97F4A7C15),
    ((1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F),
    ((1 << 127) - 1, 0x369DEA0F31A53F85BB67AE8584CAA73B),
)
_BUCKET_BITS = 12

_TURN = "conv_id long, nul int, turn long, x long, y long, chars long, tie long"
_SCANNED = (
    "kind int, part int, conv_id long, depth long, fp binary, parent binary, x long, y long, chars long, before long, last boolean, state string"
)
_DONE, _OPEN, _SUMMARY = 0, 1, 2


class Product:
    """Elements (length, value) of the monoid."""

    def __init__(self, prime: int, multiplier: int):
        self.prime, self.multiplier, self.powers = prime, multiplier % prime, [1]

    def power(self, n: int) -> int:
        if n > 4096:
            return pow(self.multiplier, n, self.prime)
        while len(self.powers) <= n:
            self.powers.append(self.powers[-1] * self.multiplier % self.prime)
        return self.powers[n]

    def turn(self, x: int, y: int) -> tuple[int, int]:
        return 1, (((x & (1 << 64) - 1) << 64 | y & (1 << 64) - 1) + 1) % self.prime

    def compose(self, one: tuple[int, int], two: tuple[int, int]) -> tuple[int, int]:
        return one[0] + two[0], (one[1] * self.power(two[0]) + two[1]) % self.prime

    def cancel(self, front: tuple[int, int], whole: tuple[int, int]) -> tuple[int, int]:
        """What composes with `front` to `whole`."""
        n = whole[0] - front[0]
        return n, (whole[1] - front[1] * self.power(n)) % self.prime


def _bytes(element: tuple[int, int]) -> bytes:
    return element[1].to_bytes(16, "big")


def _number(value: bytes) -> int:
    return int.from_bytes(value, "big")


def turns(conversations: DataFrame, salt: int) -> DataFrame:
    """One row of fixed size for each turn, and its role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    return rows.filter("conv_id is not null").select(
        "conv_id",
        F.col("turn").isNotNull().cast("int").alias("nul"),
        F.coalesce("turn", F.lit(0)).cast("long").alias("turn"),
        F.xxhash64(F.lit(2 * salt), "role", "text").alias("x"),
        F.xxhash64(F.lit(2 * salt + 1), "role", "text").alias("y"),
        F.char_length("text").cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("tie"),
        "role",
        "text",
    )


def _digests_hold(rows: DataFrame) -> bool:
    """Whether each digest stands for one (role, text); copies are combined before the shuffle."""
    contents = rows.groupBy("x", "y", "role", "text").agg(F.count("*").alias("n"))
    return contents.groupBy("x", "y").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def headers(rows: DataFrame) -> DataFrame:
    """(conv_id, n, h, head): the number of own turns, and the base's turns that come first, for each conversation."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("nul", "turn", "x", "y", "tie"))
    # A limit on the place, so tasks send at most five rows of a conversation.
    first = rows.filter(F.col("conv_id") % GROUP == 0).withColumn("place", place).filter(F.col("place") < HEADS)
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("place", "x", "y", "chars"))).alias("head"))
    own = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    head = F.coalesce(F.slice("head", 1, F.col("h")), F.array().cast(heads.schema["head"].dataType))
    return own.join(heads, "base", "left").withColumn("h", h).select("conv_id", "n", "h", head.alias("head"))


class _Scan:
    """The fold over a partition's rows, in order. The rows in front of the partition's first header belong to a conversation that
    began elsewhere; they stay open, with products of their own."""

    def __init__(self, product: Product, part: int):
        self.m, self.part, self.rows = product, part, []
        self.header, self.seen = None, 0
        self.lead, self.lead_chars, self.first = (0, 0), 0, []

    def begin(self, conv: int, n: int, h: int, head: list) -> None:
        product, chars = (0, 0), 0
        size = len(head) + max(0, n - h)
        if size == 0:
            self.rows.append((_DONE, self.part, conv, 0, b"", None, 0, 0, 0, 0, True, None))
        for k, turn in enumerate(head):
            x, y, length = turn["x"], turn["y"], turn["chars"]
            before, product = product, self.m.compose(product, self.m.turn(x, y))
            self.rows.append((_DONE, self.part, conv, k + 1, _bytes(product), _bytes(before), x, y, length, chars, k + 1 == size, None))
            chars += length
        self.header, self.seen = (conv, h, product, chars, size), 0
        self.suffix, self.chars = (0, 0), 0

    def turn(self, x: int, y: int, length: int) -> None:
        element = self.m.turn(x, y)
        if self.header is None:
            before, self.lead = self.lead, self.m.compose(self.lead, element)
            row = (_OPEN, self.part, None, self.lead[0], _bytes(self.lead), _bytes(before), x, y, length, self.lead_chars, False, None)
            self.rows.append(row)
            self.lead_chars += length
            if len(self.first) < HEADS - 1:
                self.first.append([self.lead[1], self.lead_chars])
            return
        conv, h, head, chars, size = self.header
        self.seen += 1
        if self.seen <= h:
            return
        before, self.suffix = self.suffix, self.m.compose(self.suffix, element)
        whole, parent = self.m.compose(head, self.suffix), self.m.compose(head, before)
        self.rows.append(
            (_DONE, self.part, conv, whole[0], _bytes(whole), _bytes(parent), x, y, length, chars + self.chars, whole[0] == size, None)
        )
        self.chars += length

    def summary(self) -> str:
        tail = None
        if self.header is not None:
            conv, h, head, chars, size = self.header
            tail = {"conv": conv, "h": h, "size": size, "seen": self.seen, "product": self.m.compose(head, self.suffix), "chars": chars + self.chars}
        return json.dumps({"lead": self.lead, "chars": self.lead_chars, "first": self.first, "tail": tail})


def _scanner(prime: int, multiplier: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = arrow_schema(_SCANNED)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fold = _Scan(Product(prime, multiplier), TaskContext.get().partitionId())
        for batch in batches:
            for conv, kind, x, y, chars, n, h, head in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
                if kind == 0:
                    fold.begin(conv, n, h, head)
                else:
                    fold.turn(x, y, chars)
            yield rows_batch(fold.rows, schema)
            fold.rows = []
        yield rows_batch([(_SUMMARY, fold.part, *[None] * 9, fold.summary())], schema)

    return scan


def _carries(summaries: list[tuple[int, str]], product: Product) -> list[tuple[int, str]]:
    """For each partition that begins inside a conversation, what lies before it: composed from the partitions' summaries in order."""
    out, open_at = [], None
    for part, text in sorted(summaries):
        state = json.loads(text)
        lead = tuple(state["lead"])
        if lead[0]:
            skip = min(max(0, open_at["h"] - open_at["seen"]), lead[0])
            value, chars = state["first"][skip - 1] if skip else (0, 0)
            out.append((part, json.dumps({**open_at, "skip": skip, "value": value, "less": chars})))
            rest = product.cancel((skip, value), lead)
            whole = product.compose(tuple(open_at["product"]), rest)
            open_at = {**open_at, "seen": open_at["seen"] + lead[0], "product": whole, "chars": open_at["chars"] + state["chars"] - chars}
        open_at = state["tail"] or open_at
    return out


def _finisher(prime: int, multiplier: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = arrow_schema(_SCANNED)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = Product(prime, multiplier), {}
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["carry"] not in known:
                    known = {row["carry"]: json.loads(row["carry"])}
                at, n = known[row["carry"]], row["depth"]
                if n <= at["skip"]:
                    continue
                front, head = (at["skip"], at["value"]), tuple(at["product"])
                whole = m.compose(head, m.cancel(front, (n, _number(row["fp"]))))
                parent = m.compose(head, m.cancel(front, (n - 1, _number(row["parent"]))))
                before = at["chars"] + row["before"] - at["less"]
                rows.append((_DONE, row["part"], at["conv"], whole[0], _bytes(whole), _bytes(parent), row["x"], row["y"], row["chars"], before, whole[0] == at["size"], None))
            yield rows_batch(rows, schema)

    return finish


def prefixes(rows: DataFrame, prime: int, multiplier: int) -> DataFrame:
    """(conv_id, depth, fp, parent, x, y, chars, before, last): one row for each turn of each rebuilt conversation, and for each empty one."""
    spark = rows.sparkSession
    heads = headers(rows)
    no_head = F.lit(None).cast(heads.schema["head"].dataType)
    number = [F.lit(0).cast("long").alias(c) for c in ("x", "y", "chars")]
    order = ["kind", "nul", "turn", "ox", "oy", "tie"]
    first = heads.select("conv_id", F.lit(0).alias("kind"), *number, "n", "h", "head", *[F.lit(0).cast("long").alias(c) for c in order[1:]])
    then = rows.select(
        "conv_id", F.lit(1).alias("kind"), "x", "y", "chars", F.lit(0).cast("long").alias("n"), F.lit(0).alias("h"), no_head.alias("head"),
        F.col("nul").cast("long"), "turn", F.col("x").alias("ox"), F.col("y").alias("oy"), "tie",
    )
    ordered = first.union(then).repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    ordered = ordered.select("conv_id", "kind", "x", "y", "chars", "n", "h", "head")
    scanned = stage(ordered.mapInArrow(_scanner(prime, multiplier), _SCANNED), "scanned")
    # One row for each partition of the shuffle.
    summaries = [tuple(r) for r in scanned.filter(F.col("kind") == _SUMMARY).select("part", "state").collect()]
    carries = _carries(summaries, Product(prime, multiplier))
    done = scanned.filter(F.col("kind") == _DONE)
    if carries:
        table = spark.createDataFrame(carries, "part int, carry string")
        still = scanned.filter(F.col("kind") == _OPEN).join(F.broadcast(table), "part")
        done = done.union(still.mapInArrow(_finisher(prime, multiplier), StructType(scanned.schema.fields)))
    return done.drop("kind", "part", "state")


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted ids of a node, in order, to the digest of all of them."""
    schema = arrow_schema("depth long, fp binary, ends_sha256 string")
    at, state = None, None
    for batch in batches:
        out = []
        for depth, fp, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
            text = ",".join(map(str, ids))
            if (depth, fp) != at:
                if state:
                    out.append((*at, state.hexdigest()))
                at, state = (depth, fp), hashlib.sha256(text.encode())
            else:
                state.update(f",{text}".encode())
        yield rows_batch(out, schema)
    if state:
        yield rows_batch([(*at, state.hexdigest())], schema)


def _ends(rows: DataFrame) -> DataFrame:
    """(depth, fp, ends_sha256). Ids come together in runs of at most 4,096 and are hashed as they are read."""
    bucket = F.shiftright("conv_id", _BUCKET_BITS).alias("bucket")
    runs = rows.filter("last").groupBy("depth", "fp", bucket).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    ordered = runs.repartition("depth", "fp").sortWithinPartitions("depth", "fp", "bucket")
    return ordered.mapInArrow(_hash_ends, "depth long, fp binary, ends_sha256 string")


def nodes(rows: DataFrame) -> DataFrame | None:
    """(depth, fp, parent, conv_id, n_convs, chars, before) for each group of equal prefixes; None if one holds different ones."""
    same = ["parent", "x", "y", "chars", "before"]
    grouped = rows.filter("depth > 0").groupBy("depth", "fp").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *[F.min(c).alias(c) for c in same],
        *[F.max(c).alias(f"{c}_most") for c in same],
    )
    found = stage(grouped, "nodes")
    if not found.filter(" or ".join(f"{c} <> {c}_most" for c in same)).isEmpty():
        return None
    return found.drop(*[f"{c}_most" for c in same], "x", "y")


def prefix_trie(conversations: DataFrame, multipliers: tuple = MULTIPLIERS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) for each node."""
    for salt, (prime, multiplier) in enumerate(multipliers):
        read = turns(conversations, salt)
        if not _digests_hold(read):
            continue
        rows = stage(prefixes(stage(read.drop("role", "text"), "turns"), prime, multiplier), "prefixes")
        found = nodes(rows)
        if found is not None:
            return _measured(rows, found)
    raise RuntimeError("fingerprints of different prefixes met in every attempt; give more multipliers")


def _measured(rows: DataFrame, found: DataFrame) -> DataFrame:
    below = found.filter("depth > 1").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("fp"))
    children = below.agg(F.count("*").alias("n_children"))
    found = found.join(children, ["depth", "fp"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    found = stage(found, "nodes")
    # The nodes whose smallest member is a conversation are the last ones on its path.
    paths = found.groupBy("conv_id").agg(F.min("before").alias("own"), (F.max_by("n_children", "depth") == 0).cast("long").alias("leaf"))
    whole = rows.filter("last").select("conv_id", (F.col("before") + F.col("chars")).alias("total"))
    shares = whole.join(paths, "conv_id", "left").select(
        "conv_id", F.coalesce("own", "total").alias("own"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf")
    )
    members = heavy_joined(rows.filter("depth > 0").select("conv_id", "depth", "fp"), stage(shares, "shares"), ["conv_id"])
    sums = members.groupBy("depth", "fp").agg(
        F.sum("own").alias("owns"), F.min_by("own", "conv_id").alias("least_own"), F.sum("leaf").alias("n_leaves")
    )
    saved = F.col("owns") - F.col("least_own") - (F.col("n_convs") - 1) * F.col("before")
    tree = stage(found.join(sums, ["depth", "fp"]).withColumn("saved_tokens", saved), "tree")
    ends = stage(_ends(rows), "ends")
    none = hashlib.sha256(b"").hexdigest()
    root = rows.filter("last").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    tops = tree.filter("depth = 1").agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    least, convs = root.first()
    count, leaves, all_saved = tops.first()
    schema = "depth long, fp binary, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    top = [(0, b"", least, None, convs, count, leaves or 1, all_saved or 0)] if convs else []
    above = tree.select((F.col("depth") + 1).alias("level"), F.col("fp").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    lower = tree.filter("depth > 1").withColumnRenamed("depth", "level")
    lower = heavy_joined(lower, above, ["level", "parent"]).withColumnRenamed("level", "depth")
    first = tree.filter("depth = 1").withColumn("parent_conv_id", F.lit(least).cast("long"))
    names = [field.split()[0] for field in schema.split(", ")]
    every = lower.select(*names).union(first.select(*names)).union(rows.sparkSession.createDataFrame(top, schema))
    return every.join(ends, ["depth", "fp"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
