"""Operator 3's cutoffs and verdicts against a plain version, and its base columns against DuckDB."""

import random
import sys
import unicodedata
from collections import defaultdict
from math import ceil, comb
from pathlib import Path

import duckdb
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from conftest import DATA  # noqa: E402
from flowloom.llm import op3_quality, op9_suffix  # noqa: E402


def features(text):
    n, chars, symbols, dup, repeat = brute.base_counts(text)
    lines = sum(bool(brute.words(line)) for line in text.split("\n"))
    upper = sum(unicodedata.category(c) == "Lu" for c in text)
    words = max(n, 1)
    return {
        "symbols": symbols / words,
        "dup_lines": dup / max(lines, 1),
        "repeats": repeat / words,
        "capitals": upper / max(chars, 1),
        "marks": sum(text.count(c) for c in "!?") / words,
        "long_words": chars / words,
        "short_words": -chars / words,
    }


def below(n, x, rate):
    if x >= n * rate:
        return 1.0
    return sum(comb(n, k) * rate**k * (1 - rate) ** (n - k) for k in range(x + 1))


def cutoffs(rows):
    """{(stratum, feature): cutoff} from (id, stratum, good, features), rule by rule."""
    groups = defaultdict(list)
    for i, stratum, good, found in rows:
        design = xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed=42) % 2 == 0
        for feature, value in found.items():
            groups[stratum, feature].append((design, good, value))
    tried = {}
    for key, own in groups.items():
        values = sorted(v for design, good, v in own if design and good)
        cuts = sorted({values[max(0, ceil(q * len(values)) - 1)] for q in op3_quality._QUANTILES})
        held = [v for design, good, v in own if not design and good]
        bad = [v for design, good, v in own if design and not good]
        worth = {c: sum(v > c for v in bad) - op3_quality._PRICE * sum(v > c for v in values) for c in cuts}
        best = max(worth.values())
        if best > 0 and best >= op3_quality._LEAST_SHARE * len(bad):
            tried[key] = [(c, worth[c], len(held), sum(v > c for v in held)) for c in sorted(cuts, reverse=True)]
    out = {}
    for (stratum, feature), found in tried.items():
        rate = op3_quality.RISK / sum(s == stratum for s, _ in tried)
        passed = []
        for cut, worth, n, x in found:
            if below(n, x, rate) > op3_quality.LEVEL / len(tried):
                break
            if worth > 0:
                passed.append((worth, cut))
        if passed:
            out[stratum, feature] = max(passed)[1]
    return out


@pytest.mark.parametrize("seed", [1])
def test_verdicts(spark, seed):
    rnd = random.Random(seed)

    def text(noise, shout):
        words = ["".join(rnd.choice("abdefghiklmnoprstuvw") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(45, 75))]
        words = [w.upper() if rnd.random() < shout else w for w in words]
        return " ".join(w + "#" * (rnd.random() < noise) for w in words) + "!" * rnd.randint(0, 3)

    docs, labels = [], []
    for i in range(5200):
        [stratum], bad = rnd.choices(["en", "de", None], [49, 49, 2]), rnd.random() < 0.3
        docs.append((i, text(0.3 if bad and stratum == "en" else 0.02, 0.5 if bad and stratum == "de" else 0.03), stratum))
        if rnd.random() < 0.9:
            labels.append((i, int(not bad)))
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    rows, name = op3_quality.judged(table, marks)
    found = {r["doc_id"]: r[name] for r in rows.collect()}
    good = dict(labels)
    counts = {i: brute.base_counts(t) for i, t, _ in docs}
    failed = {i: n < op3_quality.MIN_WORDS or 100 * repeat > 50 * n for i, (n, _, _, _, repeat) in counts.items()}
    known = {i: features(t) for i, t, _ in docs}
    limits = cutoffs([(i, s or "", good[i] == 1, known[i]) for i, _, s in docs if i in good and not failed[i]])
    assert {s for s, _ in limits} >= {"en", "de"}
    for i, _, stratum in docs:
        broken = {f for f, value in known[i].items() if value > limits.get((stratum or "", f), float("inf"))}
        assert found[i]["base_failed"] == failed[i] and set(found[i]["broken"]) == broken, i
        assert found[i]["kept"] == (not failed[i] and not broken)
    rejected = [i for i in good if good[i] == 1 and not failed[i] and found[i]["broken"]]
    assert len(rejected) < 0.1 * sum(good.values()) and sum(not found[i]["kept"] for i in found) > 300


BASE = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents
), grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM cut)
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS j FROM grams WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM cut) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
  coalesce(covered.n, 0) AS n_repeat_words,
  len(ws) < 50 OR 100 * coalesce(covered.n, 0) > 50 * len(ws) AS base_failed
FROM cut LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
"""

REPEATS = """
WITH bytes AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), starts AS (
  SELECT doc_id, i, sha256(lower(hex(b))[2 * i - 1 : 2 * i + 798]) AS k
  FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 398)) AS i FROM bytes WHERE octet_length(b) >= 400)
), gone AS (
  SELECT doc_id, list(i ORDER BY i) AS js FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM starts) WHERE n > 1 GROUP BY doc_id
)
SELECT doc_id, octet_length(b) AS n_bytes,
  coalesce(list_sum([least(400, coalesce(js[p + 1] - js[p], 400)) FOR p IN range(1, len(js) + 1)]), 0)::BIGINT AS n_removed
FROM bytes LEFT JOIN gone USING (doc_id)
"""


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DATA}/sf0.001/documents.parquet' where length(text) < 4000")
    return con


def test_base_by_sql(spark, con):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").filter("length(text) < 4000")
    rows, name = op3_quality.judged(docs, spark.createDataFrame([], "doc_id long, quality int"), keep=("doc_id",))
    found = rows.select("doc_id", *[f"{name}.{c}" for c in (*op3_quality.COUNTS, "base_failed")])
    assert brute.ordered(found.collect()) == brute.ordered(con.execute(BASE).fetchall())


def test_removed_bytes_by_sql(spark, con):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").filter("length(text) < 4000")
    found = op9_suffix.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed").collect()
    assert brute.ordered(found) == brute.ordered(con.execute(REPEATS).fetchall())
    assert sum(r.n_removed > 0 for r in found) > 10
