"""Operators 1 to 7 against the tokenizer libraries or brute force."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from flowloom.llm import (  # noqa: E402
    op1_decontaminate,
    op2_tokenfile,
    op3_quality,
    op4_counts,
    op5_bpe,
    op6_chat,
    op7_urls,
)
from flowloom.llm.encoded import library_ids  # noqa: E402
from flowloom.llm.queries import find_package  # noqa: E402
from flowloom.llm.vocab import library  # noqa: E402

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"
ODD = "aeiouthns'  \n\t.,!|é漢字ΣİßǺ\x85\xa0 \x1c\u2003\u3000🙂123"


@pytest.fixture(autouse=True)
def package(spark):
    find_package(spark)


def frame(spark, rows, schema=SCHEMA):
    clashing = {name: F.lit(name) for name in ("ids", "key", "n_tokens", "fit", "Hit", "item_id", "_quality", "a.b")}
    return spark.createDataFrame(rows, schema).withColumns(clashing)


def texts(seed):
    rnd = random.Random(seed)
    mixed = ["".join(rnd.choice([*ODD, "<|endoftext|>", "<|startoftext|>"]) for _ in range(rnd.randint(0, 80))) for _ in range(60)]
    long = ["x" * 4000, "".join(rnd.choice("abehtn") for _ in range(6000)), "the" * 2000 + " 's", "a b" * 700 + "y" * 3000 + " c" * 400]
    return [*mixed, *long, " " * 2000 + "a", "<|endoftext|>" * 300, "ΑΣ ΑΣ'", "", " "]


# 1


def test_leaks(spark, monkeypatch):
    rnd = random.Random(3)

    def prose(n):
        return " ".join("".join(rnd.choice(["tion", "the", "ér", "qu", "漢", "ba", "ing"]) for _ in range(rnd.randint(1, 3))) for _ in range(n))

    items = [(i, prose(rnd.randint(4, 40))) for i in range(12)] + [(50, None), (51, "short"), (52, "")]
    docs = []
    for i in range(30):
        text = prose(rnd.randint(0, 40))
        if rnd.random() < 0.7:
            found = list(rnd.choice(items[:12])[1])
            for _ in range(rnd.randint(0, max(1, len(found) // 7))):
                at = rnd.randrange(len(found))
                found[at : at + rnd.randint(0, 1)] = rnd.choice(["", "y", "zz"])
            text += "! " + "".join(found).upper() + " " + prose(3)
        docs.append((i, text))
    docs += [(100, None), (101, ""), (102, items[3][1]), (None, items[4][1]), (102, items[3][1])]
    expected = set()
    for doc, text in docs:
        inside = op1_decontaminate.normalized(text)
        for name, item in items:
            item = op1_decontaminate.normalized(item)
            if len(item) >= op1_decontaminate.SHORTEST:
                length = min(op1_decontaminate.WINDOW, len(item))
                edits = op1_decontaminate._budget(length)[0]
                starts = {*range(0, len(item) - length + 1, op1_decontaminate.STEP), len(item) - length}
                if any(brute.distance_inside(item[s : s + length], inside) <= edits for s in starts):
                    expected.add((doc, name))
    table, benchmark = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    found = op1_decontaminate.leaks(table, benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected
    clean = op1_decontaminate.without_leaks(table, benchmark)
    assert clean.schema == table.schema
    assert clean.count() == sum(1 for doc, _ in docs if doc not in {d for d, _ in expected})
    assert op1_decontaminate.leaks(table, benchmark.limit(0)).collect() == []
    assert op1_decontaminate.leaks(table.limit(0), benchmark).collect() == []
    # Small pieces of texts and small blocks of the benchmark change nothing.
    monkeypatch.setattr(op1_decontaminate, "BLOCK_BYTES", 300)
    monkeypatch.setattr(op1_decontaminate, "_PIECE", 200)
    index = op1_decontaminate.Index.of(items)
    hits = op1_decontaminate._matches(index, [t for _, t in docs])
    assert {(docs[h[0]][0], index.names[h[1]]) for h in hits} == expected
    assert {(r.doc_id, r.item_id) for r in op1_decontaminate.leaks(table.limit(10), benchmark).collect()} <= expected


@pytest.mark.parametrize("swaps", [0, 3, 6])
def test_parts_of_an_item(swaps):
    """A part of an item leaks wherever it begins, with what the best of all windows needs."""
    rnd = random.Random(17 + swaps)

    def prose(n):
        return " ".join("".join(rnd.choice("abdefghiklmnoprstuvw") for _ in range(rnd.randint(2, 9))) for _ in range(n))

    items, docs = [(i, prose(16)) for i in range(2)], []
    for _ in range(20):
        item = rnd.choice(items)[1]
        start = rnd.randrange(len(item) - 63)
        part = list(item[start : start + 64])
        for at in rnd.sample(range(64), swaps):
            part[at] = "x"
        docs.append(op1_decontaminate.normalized(f"{prose(3)} {''.join(part)} {prose(3)}"))
    least = {
        (k, i): min(brute.distance_inside(item[s : s + 64], text) for s in range(len(item) - 63))
        for k, text in enumerate(docs) for i, item in items
    }
    expected = {(*at, edits, 64) for at, edits in least.items() if edits <= 6}
    assert len(expected) >= 20
    assert {*op1_decontaminate._matches(op1_decontaminate.Index.of(items), docs)} == expected


def test_neighbouring_rows():
    """Each of neighbouring copies of a short item leaks; an item whose halves end one row and begin the next does not."""
    for size in range(30, 34):
        item = "the quick brown foxes jump over it"[:size - 1] + "s"
        for lead in range(33):
            docs = ["q" * lead, *[item] * 9]
            hits = op1_decontaminate._matches(op1_decontaminate.Index.of([(7, item)]), docs)
            assert [(h[0], h[2]) for h in hits] == [(k, 0) for k in range(1, 10)]
    item = "a long line of a benchmark that two rows of a table share by chance"
    halves = [item[:32], item[33:]]
    assert op1_decontaminate._matches(op1_decontaminate.Index.of([(7, item)]), halves) == []


def test_short_items(monkeypatch):
    """Items of any length are searched with all edits that 10 % of their length allow, the shortest as whole words."""
    rnd = random.Random(5)
    items = [(n, "".join(rnd.choice("abdefghiklmnoprstuvw") for _ in range(n))) for n in range(10, 65)]
    docs, expected = [], set()
    for k, (n, item) in enumerate(items):
        for edits in (n // 10, n // 10 + 1):
            part = list(item)
            for j in range(edits):
                part[(2 * j + 1) * n // (2 * edits)] = "x"
            docs.append(f"foreign words and {''.join(part)} and more of them")
            if brute.distance_inside(item, docs[-1]) <= n // 10:
                expected.add((len(docs) - 1, k, edits, n))
    assert len(expected) == len(items)
    assert {*op1_decontaminate._matches(op1_decontaminate.Index.of(items), docs)} == expected
    for piece in (1 << 21, 40):
        monkeypatch.setattr(op1_decontaminate, "_PIECE", piece)
        items = [(0, "What is the capital of France?"), (1, "Paris"), (2, "x"), (3, "?!")]
        index = op1_decontaminate.Index.of(items)
        docs = ["Q: what IS the capital of France", "a comparison, xx", "(Paris)", "so\nparis x", "", "paris"]
        docs += ["long comparisons " * 40, "long comparisons " * 40 + "x", "comparis" * 200, "xx" * 300]
        hits = op1_decontaminate._matches(index, docs)
        assert [(h[0], index.names[h[1]], h[2]) for h in hits] == [(0, 0, 0), (2, 1, 0), (3, 1, 0), (3, 2, 0), (5, 1, 0), (7, 2, 0)]


def test_copies_of_an_item(spark, monkeypatch):
    """Copies of an item are searched once and all reported; blocks are small however many there are."""
    rnd = random.Random(8)
    others = [" ".join(str(rnd.randrange(10**6)) for _ in range(12)) for _ in range(20)]
    one = "Which of the following is the largest of the rivers that reach this sea?"
    items = [(i, one.upper() if i % 2 else f"({one})") for i in range(60)] + [(100 + i, t) for i, t in enumerate(others)] + [(None, others[3])]
    docs = [(1, f"so: {one}"), (2, others[3]), (3, "nothing"), (4, (one + " ") * 40)]
    table, benchmark = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    expected = [(d, i, 0, 64) for d in (1, 4) for i in range(60)] + [(2, 103, 0, 64), (2, None, 0, 64)]
    monkeypatch.setattr(op1_decontaminate, "BLOCK_BYTES", 400)
    indexed = []
    build = op1_decontaminate.Index.of
    monkeypatch.setattr(op1_decontaminate.Index, "of", lambda rows: indexed.append(rows) or build(rows))
    for entries in (1 << 22, 100):
        monkeypatch.setattr(op1_decontaminate, "_ENTRIES", entries)
        index = build(items)
        assert {(docs[k][0], index.names[i], e, n) for k, i, e, n in op1_decontaminate._matches(index, [t for _, t in docs])} == {*expected}
    assert brute.ordered(op1_decontaminate.leaks(table, benchmark).collect()) == brute.ordered(expected)
    assert sum(map(len, indexed)) == 21 and max(sum(len(t) for _, t in rows) for rows in indexed) <= 800
    assert [r.doc_id for r in op1_decontaminate.without_leaks(table, benchmark).collect()] == [3]


# 2


@given(st.lists(st.integers(0, 2**32 - 1), max_size=3000), st.sampled_from([0.0, 0.5, 0.9, 1.0]))
@settings(max_examples=40, deadline=None)
def test_blocks(values, percentile):
    ids = np.array(values, np.uint32)
    blocks = op2_tokenfile.pack(ids, percentile)
    starts = np.cumsum([0, *(len(b) for b in blocks[:-1])]) if blocks else np.zeros(0, np.int64)
    assert op2_tokenfile.unpack(b"".join(blocks), starts).tolist() == values


def test_token_files(spark, tmp_path):
    rows = [(i * 7 % 50, t) for i, t in enumerate(texts(2)[:50])] + [(None, "null id"), (90, None), (3, "same id"), (91, "long " * 5000)]
    path = str(tmp_path / "ids")
    op2_tokenfile.write_ids(frame(spark, rows), path, BYTES)
    read = op2_tokenfile.read_ids(spark, path).collect()
    found = {}
    at = 0
    for row in sorted(read, key=lambda r: r.start):
        assert row.start == at and row.n_tokens * 4 == len(row.ids)
        at += row.n_tokens
        found.setdefault(row.doc_id, []).append(np.frombuffer(row.ids, "<u4").tolist())
    expected = {}
    for doc, text in rows:
        ids = library(BYTES).encode(text or "", add_special_tokens=False).ids
        expected.setdefault(doc, []).append([*ids, 0])
    assert {d: sorted(v) for d, v in found.items()} == {d: sorted(v) for d, v in expected.items()}
    order = [r.doc_id for r in sorted(read, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    digest = {r.ids_crc32 for r in op2_tokenfile.digest(op2_tokenfile.read_ids(spark, path)).collect()}
    assert digest == {zlib.crc32(np.array(ids, "<u4").tobytes()) for v in expected.values() for ids in v}
    empty = str(tmp_path / "none")
    op2_tokenfile.write_ids(frame(spark, rows).limit(0), empty, BYTES)
    assert op2_tokenfile.read_ids(spark, empty).collect() == []


def test_token_file_reads_from_any_id(tmp_path):
    from pyarrow import fs

    ids = np.random.default_rng(1).integers(0, 50_000, 10_000).astype(np.uint32)
    writer = op2_tokenfile.FileWriter(fs.LocalFileSystem(), str(tmp_path / "one"), 0.9)
    for part in np.split(ids, [10, 5000, 5000, 9999]):
        writer.add(np.array([1]), np.array([False]), np.array([len(part)]), part)
    writer.close()
    reader = op2_tokenfile.FileReader(fs.LocalFileSystem(), str(tmp_path / "one"))
    for first, last in ((0, 0), (0, 10_000), (1023, 1025), (2048, 3000), (9999, 10_000)):
        assert (reader.ids(first, last) == ids[first:last]).all()


def test_second_write_is_refused(spark, tmp_path):
    path = f"{tmp_path}/ids"
    op2_tokenfile.write_ids(spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA), path, BYTES)
    before = sorted(p.name for p in (tmp_path / "ids").iterdir())
    with pytest.raises(FileExistsError):
        op2_tokenfile.write_ids(spark.createDataFrame([(3, "c")], SCHEMA), path, BYTES)
    assert sorted(p.name for p in (tmp_path / "ids").iterdir()) == before
    assert [r.doc_id for r in op2_tokenfile.read_ids(spark, f"file:{path}").collect()] == [1, 2]


def test_order_of_files(tmp_path):
    """Files are listed by task and place, also beyond six digits; a failed job leaves none."""
    options = {"path": str(tmp_path)}
    messages = []
    for part in (1_000_000, 999_999, 2):
        name = f"ids-{part:06d}-000000-x.pfor"
        (tmp_path / name).write_bytes(b"")
        messages.append(op2_tokenfile._Written([{"name": name, "docs": 0, "ids": 1, "part": part, "at": 0}]))
    writer = op2_tokenfile._Writer(options)
    writer.commit(messages)
    listed = [p.name for p in op2_tokenfile._Reader(options).partitions()]
    assert [int(n.split("-")[1]) for n in listed] == [2, 999_999, 1_000_000]
    writer.abort(messages)
    assert not list(tmp_path.glob("*.pfor"))


# 3


def test_base_counts(spark):
    rnd = random.Random(5)
    rows = [(i, "".join(rnd.choice(["a ", "b ", "c\n", "#d ", "é\t", "\n", "<|> "]) for _ in range(rnd.randint(0, 200)))) for i in range(60)]
    rows += [(90, None), (91, ""), (92, " \n \n"), (93, "w " * 20_000), (94, "a b"), (95, "a a a a"), (None, "x y z " * 30)]
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5000, 0)], "doc_id long, quality int")
    table = frame(spark, rows)
    result, name = op3_quality.judged(table, labels)
    assert set(table.columns) < set(result.columns)
    for row in result.select("text", f"{name}.*").collect():
        expected = brute.base_counts(row.text)
        assert tuple(row[c] for c in op3_quality.COUNTS) == expected
        assert row.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert row.kept == (not row.base_failed and not row.broken)
    assert op3_quality.judged(table.limit(0), labels)[0].collect() == []


def binomial(n, x, p):
    term = total = (1 - p) ** n
    for k in range(1, x + 1):
        term *= (n - k + 1) / k * p / (1 - p)
        total += term
    return total


def test_binomial_bound(spark):
    cases = spark.createDataFrame([(n, x) for n in (1, 10, 300, 2000) for x in (0, 1, 3, 20) if x <= n], "n long, x long")
    for row in cases.withColumn("p", op3_quality.binomial_below(F.col("n"), F.col("x"), F.lit(0.02))).collect():
        assert row.p == pytest.approx(binomial(row.n, row.x, 0.02) if row.x < 0.02 * row.n else 1.0, rel=1e-9)


def test_cutoffs_hold_their_risk(spark):
    """Separable features get a cutoff between good and bad; a stratum with few labels gets none; noise gets none."""
    rnd, rows = random.Random(2), []
    for i in range(12_000):
        good = i % 4 > 0
        rows.append((i, "many", good, {"clear": rnd.random() if good else 2 + rnd.random(), "noise": rnd.random()}))
    rows += [(20_000 + i, "few", i % 2 == 0, {"clear": 3.0 * (i % 2), "noise": 0.0}) for i in range(60)]
    table = spark.createDataFrame(rows, "id long, stratum string, good boolean, features map<string,double>")
    found = {(r.stratum, r.feature): r.cutoff for r in op3_quality.cutoffs(table).collect()}
    assert set(found) == {("many", "clear")} and 0.9 <= found["many", "clear"] < 2
    assert op3_quality.cutoffs(table.limit(0)).collect() == []


# 4


@pytest.mark.parametrize(("chunk", "overlap"), [(200, 60), (1000, 100)])
def test_token_counts(spark, chunk, overlap):
    rows = [(i, t) for i, t in enumerate(texts(4))] + [(None, "x y" * 400), (3, None), (3, "z " * 900), (4, "z " * 900)]
    result = op4_counts.token_counts(frame(spark, rows), BYTES, 100, chunk=chunk, overlap=overlap)
    expected = []
    for doc, text in rows:
        n = len(library(BYTES).encode(text or "", add_special_tokens=False).ids)
        expected.append((doc, len((text or "").encode()), n, n > 100))
    assert brute.ordered(result.collect()) == brute.ordered(expected)
    assert op4_counts.token_counts(frame(spark, rows).limit(0), BYTES).collect() == []


# 5


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_bpe(spark, path):
    rows = [(i, t) for i, t in enumerate(texts(5))] + [(None, "null id"), (3, None), (3, "again"), (3, "again")]
    result = op5_bpe.encode(frame(spark, rows), path)
    expected = []
    for doc, text in rows:
        ids = library(path).encode(text or "", add_special_tokens=False).ids
        expected.append((doc, tuple(ids), library(path).decode(ids, skip_special_tokens=False)))
    assert brute.ordered((r.doc_id, tuple(r.ids), r.decoded) for r in result.collect()) == brute.ordered(expected)
    digest = op5_bpe.digest(result).collect()
    assert {r.ids_sha256 for r in digest} == {brute.sha(" ".join(map(str, ids))) for _, ids, _ in expected}
    assert op5_bpe.encode(frame(spark, rows).limit(0), path).collect() == []


@given(st.text(alphabet="aehinorst", min_size=1, max_size=4000))
@settings(max_examples=25, deadline=None)
def test_stream_emits_what_the_whole_word_gives(word):
    merges = op5_bpe.merges(WORDS)
    encoder, out, data = op5_bpe.Encoder(merges), [], word.encode()
    for at in range(0, len(data) - 1, 700):
        out += encoder.feed(data[at : min(at + 700, len(data) - 1)])
        assert len(encoder.buffer) <= 4 * merges.lookahead + 700
    out += encoder.finish(data[-1])
    assert out == merges.merged([*(merges.byte_ids[b] for b in data[:-1]), merges.last_ids[data[-1]]])


def test_decoder_in_steps():
    for path in (WORDS, BYTES):
        ids = library(path).encode("Größe 漢字 🙂 <|endoftext|> é", add_special_tokens=False).ids
        decoder = op5_bpe.Decoder(path)
        text = "".join(decoder.feed([i]) for i in ids) + decoder.finish()
        assert text == library(path).decode(ids, skip_special_tokens=False)


def test_unassigned_code_points():
    """Code points that Python's tables do not know are cut as the library cuts them."""
    rnd = random.Random(2)
    known = [0x558, 0x88F, 0xC5C, 0x1C89, 0xA7CE, 0xA7DA, 0x10D40, 0x10D50, 0x10D69, 0x1E5D0, 0x323B0, 0x33479, 0x2FFFF, 0xE0FFF]
    odd = [*map(chr, known), *(chr(rnd.randrange(0x10000, 0x3FFFF)) for _ in range(200))]
    samples = [f"word{c}word 1{c}2  {c}\n{c}! Σ{c} e\u0301{c}\u0301" for c in odd]
    samples += ["".join(rnd.choice([*ODD, *odd]) for _ in range(200)) for _ in range(50)]
    samples += ["".join(rnd.choice([*ODD, "plain words and more, "] * 9 + odd[:3]) for _ in range(9000)), odd[0] * 9000 + " a" * 9000]
    samples += [f"a{odd[0]}" + "b" * 5000 + " \n", (odd[0] + " \n\n  x") * 2000]
    for path in (BYTES, WORDS):
        for text in samples:
            expected = library(path).encode(text, add_special_tokens=False).ids
            assert np.frombuffer(library_ids(text, path, None), "<i4").tolist() == expected
            if path == WORDS:
                assert np.frombuffer(op5_bpe.text_ids(text, path), "<i4").tolist() == expected


# 6


def test_fold(spark):
    events = [
        (1, 0, 1, "delta", "user", "b"), (1, 0, 0, "delta", "user", "a"), (1, 0, 5, "edit", None, "new"), (1, 0, 6, "delta", None, "!"),
        (1, 1, 0, "delta", "assistant", "draft"), (1, 1, 1, "regenerate", "assistant", None), (1, 1, 2, "delta", None, "fin"),
        (1, 1, 3, "delta", None, None), (1, 1, 4, "delta", None, "al"),
        (2, 0, None, "delta", None, "first"), (2, 0, 1, "edit", "x", "A"), (2, 0, 1, "edit", "x", "B"), (2, 0, 1, "delta", "x", "lost"),
        (3, 0, 0, "regenerate", "user", None), (None, None, 0, "delta", "user", "z"),
    ]
    table = spark.createDataFrame(events, op6_chat.EVENTS).withColumn("turns", F.lit(1))
    found = {(r.conv_id, r.message): (r.role, r.text) for r in op6_chat.fold(table).collect()}
    assert found == {
        (1, 0): ("user", "new!"), (1, 1): ("assistant", "final"), (2, 0): ("x", "B"), (3, 0): ("user", ""), (None, None): ("user", "z"),
    }
    assert op6_chat.fold(table.limit(0)).collect() == []
    with pytest.raises(Exception, match="unknown kind"):
        op6_chat.fold(table.withColumn("kind", F.lit("shout"))).collect()


def test_render_and_parse(spark):
    rnd = random.Random(6)
    parts = ["### ", "</turn>", "\n", "\\", "#", "<", ": ", "assistant", "🙂", "é", "x", "### assistant: ", "</turn>\n"]
    rows = []
    for conv in range(25):
        for message in range(rnd.randint(1, 6)):
            text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
            rows.append((conv, message, rnd.choice(["user", "assistant", "a:b", "sys\\tem", "", "# <"]), text))
    rendered = op6_chat.render(spark.createDataFrame(rows, "conv_id long, message long, role string, text string"))
    for row in rendered.collect():
        assert sum(m.off + m.on + m.rest for m in row.mask) == len(row.formatted)
    for row in op6_chat.parse(rendered).collect():
        own = [(role, text) for conv, _, role, text in rows if conv == row.conv_id]
        assert [(t.role, t.text) for t in row.turns] == own
        assert row.learnt == "".join(text for role, text in own if role == "assistant")


# 7


def test_url_parts(spark):
    urls = [None, "", "no scheme", "HTTP://A.B/C?x#y", "s://h", "s://h?q/p", "s://h#f", "://x/y", "a://b://c/d", "s://É.COM\n/p\nq?z", "s:///p"]
    table = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = table.select("url", op7_urls.host_of(F.col("url")), op7_urls.path_of(F.col("url"))).collect()
    parts = [("", ""), ("", ""), ("", ""), ("a.b", "/C"), ("h", ""), ("h", ""), ("h", ""), ("x", "/y"), ("b:", "//c/d"), ("É.com\n", "/p\nq"), ("", "/p")]
    assert [tuple(r) for r in rows] == [(u, *p) for u, p in zip(urls, parts, strict=True)]


@pytest.mark.parametrize("most", [1, 1 << 18])
def test_url_verdicts(spark, most):
    """A filter of one block lets nearly all through; the exact join removes what isn't listed."""
    rnd = random.Random(7)
    rows = [(i, f"http://{rnd.choice(['www.', 'm.', ''])}h{rnd.randint(0, 30)}.net/p{rnd.randint(0, 20)}{rnd.choice(['', '/', '.html', '?q'])}") for i in range(400)]
    rows += [(500, None), (500, "x"), (None, "http://h1.net/p1"), (501, "http://a.b.com/x/y"), (502, "http://bb.com/x/y"), (503, "http://b.com/x")]
    listed = [f"h{i}.net/p{j}" for i in range(30) for j in range(0, 20, 3)] + ["h1.net/p3"]
    listed = spark.createDataFrame([(x,) for x in [*listed, None]], "canonical string")
    rules = [("block", "b.com", "/x"), ("allow", "b.com", "/x/y"), ("block", "com", "/x/y")]
    result = op7_urls.judged(frame(spark, rows, "page_id long, url string"), rules, listed, most=most).collect()
    assert len(result) == len(rows)
    verdicts = {r.page_id: (r.rule, r.verdict) for r in result}
    assert (verdicts[501], verdicts[502], verdicts[503]) == (("b.com/x/y", "allow"), ("com/x/y", "block"), ("b.com/x", "block"))
    on_list = {r.canonical for r in listed.collect()}
    for row in result:
        if row.rule is None:
            key = row.host.removeprefix("www.").removeprefix("m.") + row.path.removesuffix("/").removesuffix(".html")
            assert row.verdict == ("block" if key in on_list else "allow")
    none = op7_urls.judged(frame(spark, rows, "page_id long, url string"), (), listed.limit(0), most=most)
    assert {r.verdict for r in none.collect()} == {"allow"}


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("block", [16, 40, 4096])
def test_texts_in_blocks(path, block):
    """Pre-tokens, merges and special strings over block borders, as the library sees the whole text."""
    rnd = random.Random(block)
    pieces = [*ODD, "'s", "'", "re", "<|endoftext|>", "<|end", "\u0301", "\x0b", "the", "ing"]
    some = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    some += ["a" * 300 + "b", " " * 200 + "x", "!" * 100 + "'s" + "é" * 90, "ab" * 200 + "<|endoftext|>" + "'" * 50 + "re", "1" * 100, "\t" * 99 + "a"]
    for text, ids in zip(some, op5_bpe.slice_ids(some, path, block), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == library(path).encode(text, add_special_tokens=False).ids, text


def test_state_is_bounded():
    """A long text without white space: what waits between blocks does not grow."""
    encoder = op5_bpe.TextEncoder(WORDS, 1 << 12)
    most = 0
    for _ in range(120):
        encoder.feed("abcdefghij" * 410)
        most = max(most, len(encoder.raw) + len(encoder.carry) + (len(encoder.long.buffer) if encoder.long else 0))
    assert most < 8 * (1 << 12) and sum(len(x) for x in encoder.out) > 500_000
