"""The registered queries over the small tables, and the pipeline against a brute-force version of it."""

import sys
from pathlib import Path

import duckdb
import pytest
from conftest import DATA

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from flowloom.llm import op1_decontaminate, op3_quality, op5_bpe, queries  # noqa: E402

SMALL = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_against_sql(spark, con, name):
    result = queries.queries()[name](spark, SMALL)
    cursor = con.execute(queries.oracle_sql()[name])
    listed = [d[0] for d in cursor.description]
    assert sorted(listed) == sorted(result.columns)
    assert brute.ordered(result.select(*listed).collect()) == brute.ordered(cursor.fetchall())


@pytest.mark.parametrize("name", [n for n in queries.queries() if n.startswith("op")])
def test_no_python_where_native(spark, name):
    number = int(name[2:].split("_")[0])
    plan = queries.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    if number in (3, 6, 12):
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_suffixes_of_the_table(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    result = queries.queries()["op9_suffix_array"](spark, SMALL).collect()
    assert brute.ordered(result) == brute.ordered(brute.repeated_bytes(docs, 400))


def test_pipeline(spark):
    """With these few labels no threshold can be proven, so the base decides."""
    docs = [tuple(d) for d in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    counts = {d: brute.base_counts(t) for d, t in docs}
    docs = [(d, t) for d, t in docs if counts[d][0] >= op3_quality.MIN_WORDS and 2 * counts[d][4] <= counts[d][0]]
    first = {d: c for d, _, c in brute.jaccard(docs, 80, 5)}
    docs = [(d, t) for d, t in docs if first[d] == d]
    removed = {d: n for d, _, n, _ in brute.repeated_words(docs, 35)}
    index = op1_decontaminate.Index.of([tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()])
    leaking = {docs[k][0] for k, *_ in op1_decontaminate._matches(index, [t for _, t in docs])}
    result = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    # A text may leak no more once a repeated passage is cut.
    assert set(result) >= {d for d, _ in docs if d not in leaking}
    assert set(result) <= {d for d, _ in docs if d not in leaking or removed[d]}
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    for doc, text in docs:
        if doc in result and not removed[doc]:
            assert result[doc].ids == op5_bpe.np.frombuffer(op5_bpe.text_ids(text, path), "<i4").tolist()
            assert result[doc].decoded == op5_bpe.decoded(result[doc].ids, path)


def test_stages_keep_the_columns(spark):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_rules" and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, SMALL).columns == docs.columns
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs.limit(0), SMALL).collect() == []


def test_pipeline_verdicts(spark, tmp_path):
    """A proven cutoff, the remains of a shared passage, parts of a benchmark item by brute force, and the library's ids."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    rnd = random.Random(4)

    def prose(n):
        return " ".join("".join(rnd.choice("abdefghiklmnoprstuvw") for _ in range(rnd.randint(3, 8))) for _ in range(n))

    texts = {i: prose(60) + (" #&|#" * 12 if i < 240 else "") for i in range(2400)}
    labels = [(i, int(i >= 240), 0) for i in range(2400)]
    passage, item, ends = prose(40), prose(20), {}
    for i in (5000, 5001):
        ends[i] = prose(60), prose(60)
        texts[i] = f"{ends[i][0]} {passage} {ends[i][1]}"
    for i, swaps in ((6000, 0), (6001, 3), (6002, 14)):
        part = list(item[21:85].strip().ljust(64, "y"))
        for at in range(0, 64, 64 // swaps) if swaps else ():
            part[at] = "x"
        texts[i] = f"{prose(60)} {''.join(part)} {prose(60)}"
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    rows = [(i, t, "en", "test", len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leaking = {i for i in (6000, 6001, 6002) if min(brute.distance_inside(item[s : s + 64], texts[i]) for s in range(len(item) - 63)) <= 6}
    assert leaking == {6000, 6001}
    result = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not any(i in result for i in range(240)) and sum(240 <= i < 2400 for i in result) >= 0.96 * 2160
    assert {i for i in result if i >= 2400} == {5000, 5001, 6002}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, row in result.items():
        assert row.ids == tokenizer.encode(" ".join(ends.get(i, [texts[i]])), add_special_tokens=False).ids
