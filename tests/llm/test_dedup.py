"""Operators 8, 9 and 10 against brute force, with nulls, repeated ids, ties and columns with clashing names."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from flowloom.llm import bloom, components, op8_jaccard, op9_suffix, op10_substring  # noqa: E402
from flowloom.llm.queries import find_package  # noqa: E402
from flowloom.llm.suffixes import Suffixes  # noqa: E402

SCHEMA = "doc_id long, text string"


@pytest.fixture(autouse=True)
def package(spark):
    find_package(spark)


def frame(spark, rows):
    clashing = {name: F.lit(name) for name in ("RID", "key", "starts", "anchor", "Block", "tree", "a.b")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(clashing)


def passages(seed, odd):
    rnd, rows = random.Random(seed), []
    common = [" ".join(rnd.choice(["a", "b", "cé", "D", "漢"]) for _ in range(rnd.randint(0, 150))) for _ in range(10)]
    for i in range(50):
        text = " ".join(rnd.choice(["x%d" % rnd.randint(0, 500), "a", "b"]) for _ in range(rnd.randint(0, 60)))
        if rnd.random() < 0.6:
            part = rnd.choice(common).split()
            text += rnd.choice([" ", "\n", "\t \x0b"]) + " ".join(part[rnd.randint(0, max(0, len(part) - 1)) :])
        rows.append((i, text))
    rows += [(60, rows[3][1]), (61, rows[3][1]), (62, ""), (63, None), (64, "z " * 200), (65, "   \n")]
    return rows + ([(None, rows[4][1]), (None, rows[5][1] + " q"), (3, rows[3][1]), (3, "q " + rows[7][1])] if odd else [])


@pytest.mark.parametrize(("window", "odd"), [(35, False), (35, True), (9, False), (2, False)])
def test_substring(spark, window, odd):
    rows = passages(window, odd)
    result = op10_substring.digest(op10_substring.remove_repeats(frame(spark, rows), window))
    assert brute.ordered(result.collect()) == brute.ordered(brute.repeated_words(rows, window))


def test_substring_keeps_columns_and_white_space(spark):
    shared = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"one\n\ntwo  {shared}\tthree"), (2, f" {shared} four\n"), (3, "left  as\nit is"), (4, None), (4, "")]
    result = op10_substring.shortened(frame(spark, rows))
    assert "anchor" in result.columns
    kept = brute.ordered(result.select("doc_id", "text").collect())
    assert kept == brute.ordered([(1, "one\n\ntwo  three"), (2, " four\n"), (3, "left  as\nit is"), (4, None), (4, "")])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op10_substring.remove_repeats(empty).collect() == []
    assert op9_suffix.remove_repeats(empty).collect() == []
    assert op8_jaccard.jaccard_components(empty).collect() == []
    assert op8_jaccard.first_of_each(empty).collect() == []


@pytest.mark.parametrize(("length", "odd", "regions", "letters"), [(400, False, 4096, "abé 漢\n"), (60, True, 4096, "ab"), (40, False, 3, "abcde fgé")])
def test_suffixes(spark, monkeypatch, length, odd, regions, letters):
    """With few regions a shard, anchors are cut and merged again."""
    monkeypatch.setattr(op9_suffix, "_REGIONS", regions)
    rnd, rows = random.Random(length), []
    common = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 3 * length))) for _ in range(8)]
    for i in range(40):
        text = "".join(rnd.choice("xyzäöu ") for _ in range(rnd.randint(0, length)))
        for _ in range(rnd.randint(0, 3)):
            part = rnd.choice(common)[rnd.randint(0, length) :]
            if part and rnd.random() < 0.5:
                at = rnd.randrange(len(part))
                part = part[:at] + "Q" + part[at + 1 :]
            text += part + rnd.choice("pqr") * rnd.randint(0, 3)
        rows.append((i, text))
    rows += [(60, rows[3][1]), (62, ""), (63, None), (64, "z" * (3 * length)), (65, "ab" * (2 * length)), (67, "y" * length)]
    rows += [(None, rows[4][1]), (None, rows[5][1] + " q"), (3, "q " + rows[7][1])] if odd else []
    result = op9_suffix.digest(op9_suffix.remove_repeats(frame(spark, rows), length))
    assert brute.ordered(result.collect()) == brute.ordered(brute.repeated_bytes(rows, length))


@pytest.mark.parametrize("hashed", [1, 700, 1 << 20])
def test_texts_hashed_in_slices(spark, monkeypatch, hashed):
    monkeypatch.setattr(op9_suffix, "_HASHED", hashed)
    rnd = random.Random(5)
    parts = ["".join(rnd.choice("abé \n") for _ in range(90)) for _ in range(6)]
    rows = [(i, "".join(rnd.choice(parts)[rnd.randint(0, 60) :] + rnd.choice("xyz") for _ in range(rnd.randint(0, 9)))) for i in range(40)]
    result = op9_suffix.digest(op9_suffix.remove_repeats(frame(spark, rows), 50))
    assert brute.ordered(result.collect()) == brute.ordered(brute.repeated_bytes(rows, 50))


def test_passages_of_many_words_go_from_400_bytes_on(spark):
    """51 words with 399 bytes in two texts stay, with one byte more they go."""
    short = " ".join(f"w{i:04d}x" for i in range(50)) + " " + "q" * 49
    assert len(short) == 399 and len(short.split()) > 50
    rows = [(1, "A" + short + "B"), (2, "C" + short + "D"), (3, "E" + short.upper() + "!F"), (4, "G" + short.upper() + "!H")]
    found = op9_suffix.remove_repeats(frame(spark, rows)).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, found)) == [(1, 0), (2, 0), (3, 400), (4, 400)]


def test_suffix_order():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60))).encode() for _ in range(30)] + [b"aaaa" * 9, b""]
    suffixes = Suffixes(texts)
    keys = [(t[i:], k, i) for k, t in enumerate(texts) for i in range(len(t))]
    expected = [suffixes.begins[k] + i for _, k, i in sorted(keys, key=lambda x: (x[0], x[1], x[2]))]
    assert suffixes.order.tolist() == expected


def near_copies(seed, odd):
    rnd, rows = random.Random(seed), []
    for _ in range(18):
        base = ["w%d" % rnd.randint(0, 3000) for _ in range(rnd.choice([1, 2, 3, 8, 9, 10, 11, 12, 13, 20, 40, 100, 300]))]
        for _ in range(rnd.randint(1, 20)):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, len(base) // 40])):
                at = rnd.randrange(len(text))
                if rnd.random() < 0.5:
                    text[at] = "z%d" % rnd.randint(0, 9)
                elif len(text) > 1:
                    del text[at]
            rows.append((len(rows) * 3, rnd.choice([" ", "\n", " \t"]).join(text)))
    rows += [(100001, ""), (100002, None), (100003, "A b"), (100004, "a B"), (100005, "a B c"), (100006, "a a a a a")]
    return rows + ([(None, rows[4][1]), (None, ""), (3, rows[30][1]), (3, "q r s t")] if odd else [])


@pytest.mark.parametrize(("part", "ngram", "odd"), [(90, 3, False), (90, 3, True), (80, 5, False), (50, 2, False)])
def test_jaccard(spark, part, ngram, odd):
    rows = near_copies(part + ngram, odd)
    result = op8_jaccard.jaccard_components(frame(spark, rows), (part, 100), ngram)
    assert brute.ordered(result.collect()) == brute.ordered(brute.jaccard(rows, part, ngram))


def test_jaccard_blocks_and_rounds(spark, monkeypatch):
    """Trees cut into small blocks, and a group whose members link in a chain only."""
    monkeypatch.setattr(op8_jaccard, "_BLOCK", 4)
    rows = [(100 - i, " ".join(f"w{k}" for k in range(i, i + 60))) for i in range(40)]
    rows += [(200 + i, " ".join(["v%d" % k for k in range(58)] + [f"u{i}", "t"])) for i in range(30)]
    result = op8_jaccard.jaccard_components(frame(spark, rows))
    assert brute.ordered(result.collect()) == brute.ordered(brute.jaccard(rows))


def test_jaccard_joins_only_trees_of_several(spark, monkeypatch):
    rnd = random.Random(3)
    texts = [" ".join("w%d" % rnd.randint(0, 10**6) for _ in range(60)) for _ in range(150)]
    rows = list(enumerate(texts)) + [(200 + k, text + " end") for k, text in enumerate(texts[:5])]
    docs, joined = spark.createDataFrame(rows, SCHEMA), []
    routed = op8_jaccard._signatures(docs.withColumnRenamed("doc_id", "rid"), 3, (90, 100)).count()
    heavy_joined = op8_jaccard.heavy_joined

    def counted(rows, lookup, keys, how="inner"):
        if keys == ["tree"]:
            joined.append(rows.count())
        return heavy_joined(rows, lookup, keys, how)

    monkeypatch.setattr(op8_jaccard, "heavy_joined", counted)
    found = op8_jaccard.jaccard_components(docs).select("doc_id", "component_id").collect()
    assert {tuple(r) for r in found} == {(i, i % 200 if i >= 200 else i) for i, _ in rows}
    assert 0 < joined[0] < routed / 4


def test_first_of_each(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (2, text), (9, text + " end"), (7, None), (8, ""), (1, "else"), (None, "alone here")]
    kept = op8_jaccard.first_of_each(frame(spark, rows[:-1]), (80, 100), 5)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 7, 8] and "tree" in kept.columns
    assert op8_jaccard.first_of_each(frame(spark, rows), (80, 100), 5).count() == 5


def test_components_of_a_path(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (200, 200)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(tuple(r) for r in found) == [(i, 0) for i in range(41)] + [(i, 100) for i in (100, 101, 102)]


def test_bloom_joins(spark):
    """A filter of one block lets everything through; results stay exact."""
    rows = spark.range(500).selectExpr("if(id = 3, null, id) rid", "cast(id as string) w0")
    keys = spark.range(0, 500, 7).selectExpr("id rid", "id * 2 more")
    for most in (1, bloom.MAX_BLOCKS):
        some, rest = bloom.probed(rows, F.col("rid"), keys, "rid", most)
        assert some.count() + rest.count() == 500
        assert rest.join(keys, "rid").count() == 0 and rest.filter("rid is null").count() == 1
    assert bloom.among(rows, keys, "rid").count() == 72
    assert bloom.without(rows, keys, "rid").count() == 428
    assert bloom.left_joined(rows, keys, "rid").filter("more is null").count() == 428
    assert bloom.inner_joined(rows, keys, "rid").count() == 72
    assert bloom.without(rows, keys.limit(0), "rid").count() == 500


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_same_rows_in_each_partitioning(spark, parts):
    """Null and repeated ids: which row of a group of copies stays does not depend on how the table is split."""
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, "a"), (1, words, "b"), (None, words, "c"), (None, words, "d"), (2, words + " more", "e"), (2, "other text here", "f"), (None, "", "g")]
    docs = spark.createDataFrame(random.Random(parts).sample(rows, len(rows)), "doc_id long, text string, mark string").repartition(parts)
    kept = sorted(r.mark for r in op8_jaccard.first_of_each(docs, similarity=(80, 100), ngram=5).collect())
    assert kept in (["a", "f", "g"], ["b", "f", "g"])
    wanted = sorted(r.mark for r in op8_jaccard.first_of_each(spark.createDataFrame(rows, docs.schema).coalesce(1), similarity=(80, 100), ngram=5).collect())
    assert kept == wanted
