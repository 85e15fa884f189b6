"""Operators 11 and 13 against brute force."""

import random
import sys
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from flowloom.llm import op11_prefixes, op13_repair  # noqa: E402
from flowloom.llm.heavy import heavy_joined  # noqa: E402
from flowloom.llm.queries import find_package  # noqa: E402
from flowloom.sources.staging import staged_scope  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(autouse=True)
def package(spark):
    find_package(spark)


def frame(spark, rows):
    clashing = {name: F.lit(name) for name in ("kind", "x", "h", "fp", "head", "n", "depth", "Tie", "audit", "a.b")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(clashing).repartition(5)


def some_rows(seed, number=260):
    rnd = random.Random(seed)
    convs = [*range(40), 100, 105, 207, -3, -100]
    draws = [(rnd.choice(convs), rnd.choice([None, *range(1, 7)]), rnd.choice("ua"), rnd.choice(["x", "yy", "zz🙂", None, ""])) for _ in range(number)]
    # Contents of one turn would be ordered by digest, so each turn stands once.
    return list({row[:2]: row for row in draws}.values())


def tries(spark, rows, **more):
    return brute.ordered(op11_prefixes.prefix_trie(frame(spark, rows), **more).collect())


def test_trie(spark):
    rows = some_rows(1)
    # C remainders, as in SQL, have the sign of c: the base of -3 is 0.
    plain = [r for r in rows if r[0] >= 0]
    assert tries(spark, plain) == brute.ordered(brute.trie(plain))
    own = {c for c, *_ in rows}
    assert {r[0] for r in tries(spark, rows) if r[1] == 0} == {min(own)}
    repeated = [*plain[:30], *plain[:30], (None, 1, "u", "lost")]
    assert tries(spark, repeated) == brute.ordered(brute.trie(repeated))
    assert tries(spark, []) == []


def test_conversations_over_many_tasks(spark):
    """Three conversations hold nearly all rows, so they lie over several tasks; two of them are alike to the end."""
    rnd = random.Random(2)
    rows = [r for r in some_rows(3, 80) if r[0] >= 0]
    for conv in (0, 17):
        rows += [(conv, k, "u", rnd.choice(["p", "qq"])) for k in range(10, 700)]
    for conv in (21, 22):
        rows += [(conv, k, "u", "same" * (k % 3)) for k in range(10, 700)]
    assert tries(spark, rows) == brute.ordered(brute.trie(rows))


def test_equal_fingerprints_are_found(spark):
    """With a tiny prime different prefixes meet, and the next multiplier is taken."""
    rows = [r for r in some_rows(4) if r[0] >= 0]
    assert tries(spark, rows, multipliers=((5, 2), *op11_prefixes.MULTIPLIERS)) == brute.ordered(brute.trie(rows))
    with pytest.raises(RuntimeError):
        tries(spark, rows, multipliers=((5, 2),))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 63), max_size=40), st.integers(0, 40))
def test_products(values, cut):
    m = op11_prefixes.Product(*op11_prefixes.MULTIPLIERS[0])
    elements = [m.turn(v, v * 3) for v in values]

    def product(part):
        whole = (0, 0)
        for e in part:
            whole = m.compose(whole, e)
        return whole

    one, two, whole = product(elements[:cut]), product(elements[cut:]), product(elements)
    assert m.compose(one, two) == whole and m.cancel(one, whole) == two


def test_heavy_keys(spark):
    rows = [(k % 3 if k % 2 else k,) for k in range(5000)]
    left = spark.createDataFrame(rows, "k long").repartition(4)
    right = spark.createDataFrame([(k, str(k)) for k in range(0, 4000)], "k long, v string")
    for how in ("inner", "left"):
        assert brute.ordered(heavy_joined(left, right, ["k"], how).collect()) == brute.ordered(left.join(right, ["k"], how).collect())


def test_heavy_keys_are_not_written(spark):
    left = spark.createDataFrame([(k % 3 if k % 2 else k,) for k in range(5000)], "k long")
    right = spark.createDataFrame([(k, str(k)) for k in range(4000)], "k long, v string")
    with staged_scope(spark) as scope:
        assert heavy_joined(left, right, ["k"], "left").count() == 5000
        assert heavy_joined(right, right.select("k"), ["k"]).count() == 4000
    assert scope.paths == []


ROLES = ["system", "user", "user", "assistant", "assistant", "tool", "", None]
TEXTS = ["x.", "yy!", "zz?", "w", " ", None, "", "ab.  \n", "a . ", "é ", "no stop"]


def messy(seed, number, convs):
    rnd = random.Random(seed)
    return [(rnd.choice(convs), k if k % 40 else None, rnd.choice(ROLES), rnd.choice(TEXTS)) for k in range(1, number)]


def test_repair(spark):
    rows = messy(1, 700, [None, *range(60)])
    table = frame(spark, rows)
    hurt = [tuple(r) for r in op13_repair.damaged(table).collect()]
    assert brute.ordered(hurt) == brute.ordered(brute.damage(rows))
    result = op13_repair.repair_digest(op13_repair.damaged(table), table).collect()
    assert brute.ordered(result) == brute.ordered(brute.repair(list(brute.damage(rows)), rows))


def test_repaired_turns(spark):
    rows = [(c, t, r or " ", x or " ") for c, t, r, x in messy(2, 300, range(12))]
    found = op13_repair.repaired(frame(spark, rows)).collect()
    said = {c: "" for c, *_ in rows}
    for c in said:
        turns = sorted((r for r in found if r.conv_id == c), key=lambda r: r.place)
        assert [r.place for r in turns] == list(range(len(turns)))
        said[c] = brute.sha("\n".join(f"{r.role}:{r.text}" for r in turns))
    assert said == {row[0]: row[-1] for row in brute.repair(rows, rows)}


def test_nothing_left(spark):
    """A conversation without rows, and no table at all."""
    rows = [(1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (2, 1, "user", "Lost.")]
    table = frame(spark, rows)
    result = {r.conv_id: r for r in op13_repair.repair_digest(table.filter("conv_id = 1"), table).collect()}
    assert tuple(result[1])[1:8] == (0, 0, 0, 0, 0, 0, "KK")
    assert tuple(result[2])[1:] == (0, 0, 0, 0, 0, 0, "", brute.sha(""))
    empty = table.limit(0)
    assert op13_repair.repair_digest(op13_repair.damaged(empty), empty).collect() == []
    assert op13_repair.repaired(empty).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suat"), st.sampled_from(["", "blank", "truncated"])), max_size=14))
def test_cheapest_edits(rows):
    codes = bytes(op13_repair._CODES[i if i in "sua" else "-", "must" if f == "blank" else f] for i, f in rows)
    assert op13_repair.cheapest_edits(codes) == brute.edits([(i, "x") for i, _ in rows], [f for _, f in rows])[:2]


def test_long_conversation():
    codes = bytes(random.Random(5).choices(range(12), k=50_000))
    cost, letters = op13_repair.cheapest_edits(codes)
    assert cost > 0 and sum(c != "I" for c in letters) == len(codes)
