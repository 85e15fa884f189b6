"""Operator 12 against the plain patterns, and what it learns from contexts."""

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from conftest import DATA  # noqa: E402
from flowloom.llm import op12_pii  # noqa: E402

PIECES = ["1", "2", "55", "192", "@", "a", "b.c", ".", "-", " ", "  ", "+", "(", ")", "\n", "+1", "4111111111111111", "x@y.z", "é", "🙂", "_"]
PIECES += ["1.2.3.4", "%", ",", "0", "+44 20 7946 0958", "300.1.1.1"]


def digests(spark, rows, **bounds):
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, rid string, runs string").repartition(4)
    return op12_pii.digest(op12_pii.personal_data(docs, **bounds)).collect()


def wide(rows):
    return [(*row, "x", "y", "z") for row in rows]


def expected(rows):
    for doc, text in rows:
        spans = brute.private(text, op12_pii.PLAIN)
        said = ",".join(f"{op12_pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        yield doc, *[sum(s[1] == k for s in spans) for k in range(4)], brute.sha(said), said


def check(spark, rows):
    result = digests(spark, wide(rows))
    assert brute.ordered(r[:6] for r in result) == brute.ordered(r[:6] for r in expected(rows))
    base = {r[0]: r[6] for r in expected(rows) if r[0] is not None}
    for r in result:
        if r.doc_id is not None and [d for d, _ in rows].count(r.doc_id) == 1:
            assert set(base[r.doc_id].split(",")) - {""} <= set(r.spans.split(","))
            assert len(r.spans.split(",") if r.spans else []) == sum(r[1:5]) + r.n_added


def test_base(spark):
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 40)))) for i in range(1500)]
    check(spark, [*rows, (None, None), (None, "a@b.c"), (None, "a@b.c"), (7, "a@b.c"), (9000, ""), (9001, None)])


def test_empty(spark):
    assert digests(spark, []) == []


def test_table(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(r) for r in docs.collect()])


def test_very_long_texts(spark):
    """Runs on which plain patterns need quadratic time or a deep stack, and matches beyond a block of sums."""
    rows = [
        (1, "a." * 50_000 + "@x.y"),
        (2, "1" * 100_000),
        (3, "1 " * 50_000),
        (4, "a@b" + ".c" * 50_000),
        (5, "+1" + " " * 50_000),
        (6, "1.1.1.1 " * 5_000),
        (7, "é1.1.1.1\n" * 5_000),
    ]
    result = {r.doc_id: r for r in digests(spark, wide(rows))}
    assert [result[i].n_email for i in (1, 4)] == [1, 1] and result[4].spans == f"email:0:{len(rows[3][1])}"
    assert result[2].spans == result[3].spans == result[5].spans == ""
    assert result[6].spans == ",".join(f"ip:{8 * i}:{8 * i + 7}" for i in range(5000))
    assert result[7].spans == ",".join(f"ip:{9 * i + 1}:{9 * i + 8}" for i in range(5000))


def test_contexts(spark):
    """Twenty addresses follow `reach me at`, so what else follows it, with the same shape, is one; other numbers stay alone."""
    rows = [(i, f"{'word ' * 3}Reach me at user{i}@mail.example.com today") for i in range(20)]
    rows += [(100 + i, f"blah reach me at user{i}@localhost, ok") for i in range(3)]
    rows += [(200, "the user7@box again"), (201, "reach me at 99"), (202, "reach me at 1234567890123")]
    result = {r.doc_id: r for r in digests(spark, wide(rows))}
    for i in range(3):
        assert result[100 + i].spans == "email:17:32" and result[100 + i].n_email == 0 and result[100 + i].n_added == 1
    assert all(result[i].n_added == 0 for i in (*range(20), 200, 201, 202))
    # Too few seeds, or a context that mostly holds other things.
    assert all(r.n_added == 0 for r in digests(spark, wide(rows[:3] + rows[20:])))
    mixed = rows + [(300 + i, f"reach me at user{i}@host{i} now") for i in range(40)]
    assert all(r.n_added == 0 for r in digests(spark, wide(mixed)))


def test_further_rounds(spark):
    """A context that no seed has is learnt from values that the first round found."""
    rows = [(i, f"mail to user{i}@a.example now") for i in range(12)]
    rows += [(50 + i, f"mail to user{i}@intern now") for i in range(3)]
    rows += [(60 + i, f"ping user{i}@intern or") for i in range(3)] + [(70 + i, f"ping user{i}@b.example or") for i in range(5)] + [(80, "ping user9@lab or")]
    result = {r.doc_id: r for r in digests(spark, wide(rows), least_seeds=5, least_score=700, rounds=2)}
    assert result[50].n_added == 1 and result[60].n_added == 1 and result[80].n_added == 1
    once = {r.doc_id: r for r in digests(spark, wide(rows), least_seeds=5, least_score=700, rounds=1)}
    assert once[50].n_added == 1 and once[80].n_added == 0
