"""Foreign CSV, type inference, hidden addresses, top keys, overlap joins and neighbours against plain versions."""

import csv
import io
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from flowloom.operators import heavyhitters, hiding, inference, intervals, neighbours
from flowloom.operators.positions import nth_in_group, numbered
from flowloom.plans import flows
from flowloom.sources import csvfiles, foreign


@pytest.fixture
def small_ranges(spark):
    """Files are read in byte ranges of some hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for name, size in zip(names, ("900", "0"), strict=True):
        spark.conf.set(name, size)
    yield
    for name, size in zip(names, before, strict=True):
        spark.conf.set(name, size)


def foreign_files(folder, number, seed=1):
    rnd, rows = random.Random(seed), []
    folder.mkdir()
    for k, end in enumerate(("\n", "\r\n")):
        own = [[f"{k}-{i}", "".join(rnd.choice(["a", "\n", "\r\n", '"', ",", "é", " "]) for _ in range(rnd.randint(0, 9))), rnd.choice(["", "x"])] for i in range(number)]
        text = io.StringIO(newline="")
        csv.writer(text, lineterminator=end).writerows([["id", "a text, more", "z"], *own])
        (folder / f"f{k}.csv").write_bytes((b"\xef\xbb\xbf" if k else b"") + text.getvalue().encode())
        rows += own
    return [[v or None for v in row] for row in rows]


def test_foreign_records(spark, tmp_path, small_ranges):
    wanted = foreign_files(tmp_path / "in", 250)
    assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 8
    rows = foreign.read_foreign(spark, str(tmp_path / "in"), order="pos").orderBy("pos").collect()
    assert [[r["id"], r["a text, more"], r["z"]] for r in rows] == wanted
    assert [r["pos"] for r in rows] == list(range(len(wanted)))
    some = foreign.read_foreign(spark, str(tmp_path / "in"), "z", "id").collect()
    assert Counter(map(tuple, some)) == Counter((z, i) for i, _, z in wanted)


def test_foreign_files_grow_in_number(spark, tmp_path, monkeypatch):
    """As many files as the texts take, so that no task writes or reads a share of all."""
    import __spark_entry__ as entry

    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit('a "b",\n' * 20 + "x").alias("text"), F.lit(141).alias("n_chars"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(entry, "BYTES_PER_CSV_FILE", 4230, raising=False)
    monkeypatch.setattr(entry, "fresh_path", lambda *_: str(tmp_path / "csv"))
    rows = entry.csv_foreign_records(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == [(i, "en", 'a "b",\n' * 20 + "x", 141) for i in range(300)]
    assert len([*(tmp_path / "csv").glob("part-*")]) == 10


def test_records_over_ranges(spark, tmp_path, small_ranges):
    """A record that is longer than several ranges, and one that is never closed."""
    long = "\n".join(f"line {i}" for i in range(400))
    (tmp_path / "a.csv").write_text(f'id,text\n1,x\n2,"{long}"\n3,y\n')
    rows = {r["id"]: r["text"] for r in foreign.read_foreign(spark, str(tmp_path / "a.csv")).collect()}
    assert rows == {"1": "x", "2": long, "3": "y"}
    (tmp_path / "b.csv").write_text('id,text\n1,"x\n' + "12345678 12345678\n" * 8000)
    with pytest.raises(Exception, match="not closed"):
        foreign.read_foreign(spark, str(tmp_path / "b.csv")).collect()


def test_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,x\n")
    (tmp_path / "b.csv").write_text("text,id\nx,1\n")
    with pytest.raises(ValueError, match="different headers"):
        foreign.read_foreign(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no column"):
        foreign.read_foreign(spark, str(tmp_path / "a.csv"), "other")
    (tmp_path / "c.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        foreign.read_foreign(spark, str(tmp_path / "c.csv"))


def test_values_of_the_review(spark, tmp_path):
    (tmp_path / "p.csv").write_text('Port Number,Protocol\n"443\nx",tcp\n80,udp\n')
    rows = csvfiles.read_text_columns_in_order(spark, str(tmp_path / "p.csv"), "Port Number").orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [("443\nx", 0), ("80", 1)]
    binary = spark.createDataFrame([(1, b"ab"), (2, None), (3, b""), (4, bytes(range(256)))], "id long, b binary")
    back = csvfiles.csv_roundtrip(binary, str(tmp_path / "bin"), 1)
    assert back.schema == binary.schema and sorted(back.collect()) == sorted(binary.collect())


def test_types(spark):
    values = {
        "whole": ["1", "-007", None], "long": ["1", "99999999999"], "huge": ["1", "9" * 38], "too_huge": ["1.5", "9" * 38],
        "fixed": ["1.25", "-.5", "10."], "float": ["1e5", "2"], "day": ["2024-02-29", "2024-01-02"], "no_day": ["2024-02-30", "2024-01-02"],
        "time": ["2024-02-29 01:02:03.5", "2024-01-02"], "text": ["1", " 2"], "none": [None, None],
    }
    rows = [tuple(v[k] if k < len(v) else None for v in values.values()) for k in range(3)]
    table = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in values)).repartition(3)
    found = {r["column"]: r for r in inference.inferred_types(table).collect()}
    types = {c: r["type"] for c, r in found.items()}
    assert types == {
        "whole": "int", "long": "bigint", "huge": "decimal(38,0)", "too_huge": "double", "fixed": "decimal(4,2)", "float": "double",
        "day": "date", "no_day": "string", "time": "timestamp_ntz", "text": "string", "none": "string",
    }
    assert found["long"]["not_int"] == 1 and found["no_day"]["not_date"] == 1 and found["whole"]["n_nulls"] == 1
    typed = inference.with_inferred_types(table)
    assert dict(typed.dtypes) == types and typed.filter("whole = -7").count() == 1
    assert {r["type"] for r in inference.inferred_types(table.limit(0)).collect()} == {"string"}


def test_addresses_differ(spark):
    keys = spark.range(20_000).select((F.col("id") * 7).alias("user"))
    found = hiding.distinct_addresses(keys.union(keys), "user", "secret")
    assert found.count() == found.select("ip").distinct().count() == 20_000
    back = hiding.shown_positions(found.withColumnRenamed("pos", "was"), "secret")
    assert back.filter("pos <> was").isEmpty()
    other = hiding.distinct_addresses(keys, "user", "other").select("key", F.col("ip").alias("other"))
    assert found.join(other, "key").filter("ip = other").count() < 5


def test_bijection_of_the_edges(spark, monkeypatch):
    """With four bits to a half the whole space can be listed: it is permuted, and 0 is left out by walking on."""
    rows = spark.range(1, 1 << 16).select((F.col("id") * 65536 + F.col("id") * 3 % 65536).alias("n"))
    hidden = hiding.with_secret(rows, hiding.round_keys("s", "rank")).withColumn("h", hiding.hidden_number(F.col("n"), F.col("_secret")))
    assert hidden.select("h").distinct().count() == (1 << 16) - 1 and hidden.filter("h < 1 or h >= 1L << 32").isEmpty()
    zero = hiding.with_secret(spark.range(1), hiding.round_keys("s", "rank"))
    origin = zero.select(hiding._feistel(F.lit(0).cast("long"), F.col("_secret"), True).alias("n")).first()["n"]
    walked = zero.select(hiding.hidden_number(F.lit(origin).cast("long"), F.col("_secret")).alias("h")).first()["h"]
    shown = zero.select(hiding.shown_number(F.lit(walked).cast("long"), F.col("_secret")).alias("n")).first()["n"]
    assert origin and walked and shown == origin


def test_prefixes_are_kept(spark):
    rnd = random.Random(1)
    numbers = sorted({rnd.getrandbits(32) for _ in range(60)} | {1 << k for k in range(32)} | {0, 2**32 - 1} | {0x0A000000 + k for k in range(8)})
    table = hiding.hidden_prefixes(spark.createDataFrame([(n,) for n in numbers], "n long"), "n", "secret")
    rows = [tuple(r) for r in table.collect()]

    def common(a, b):
        return 32 - (a ^ b).bit_length()

    assert all(common(a, b) == common(x, y) for a, x in rows for b, y in rows)
    assert sum(a != x for a, x in rows) > 90
    assert hiding.hidden_prefixes(table, "hidden", "secret", "shown", back=True).filter("shown <> n").isEmpty()


@pytest.mark.parametrize("name", ["supply_flows", "supply_flow_edges", "supply_flow_nodes", "address_dim", "distinct_addresses", "hidden_prefixes", "domain_class"])
def test_no_secret_in_plans(spark, small, monkeypatch, name):
    monkeypatch.setattr(registry, "SECRET", "Zebra77")
    result = registry.queries()[name](spark, small)
    result.collect()
    known = ["Zebra77", *hiding.round_keys("Zebra77", "rank"), *hiding.round_keys("Zebra77", "prefix")]
    plan = result._jdf.queryExecution().toString() + result._jdf.queryExecution().executedPlan().toString()
    assert not any(text in plan for text in known) and "NestedLoop" not in plan


def test_edges_of_raw_keys(spark, small):
    lines, source, destination = registry._keyed(spark, small)
    from flowloom.operators.graph import flow_edges, flow_nodes

    plain = flows.keyed_flows(lines, source, destination, "l_extendedprice", "l_shipdate", "s")
    assert sorted(flows.keyed_edges(lines, source, destination, "s").collect()) == sorted(flow_edges(plain).collect())
    assert sorted(flows.keyed_nodes(lines, source, destination, "s").collect()) == sorted(flow_nodes(plain).collect())


def test_summaries():
    """No counter is too high, none too low by more than is said, and absent keys are no more frequent than that."""
    rnd = random.Random(3)
    keys = [int(rnd.paretovariate(0.7)) for _ in range(5000)]
    state, less = (np.zeros(0, np.int64), np.zeros(0, np.int64)), 0
    for at in range(0, 5000, 250):
        own, times = np.unique(np.array(keys[at : at + 250]), return_counts=True)
        *state, more = heavyhitters.merged(np.concatenate([state[0], own]), np.concatenate([state[1], times]), 40)
        less += more
    kept = dict(zip(*map(list, state), strict=True))
    for key, n in Counter(keys).items():
        assert n - less <= kept.get(key, 0) <= n
    assert len(kept) <= 40 and less <= 5000 / 41


@pytest.mark.parametrize("counters", [8, 64, None])
def test_top_keys(spark, counters):
    rnd = random.Random(2)
    values = [int(rnd.paretovariate(0.6)) for _ in range(8000)] + [None] * 100
    table = spark.createDataFrame([(v, v and v % 3) for v in values], "v long, w long").repartition(8)
    found = [tuple(r) for r in heavyhitters.top_keys(table, ["v", "w"], 10, counters).orderBy("rank").collect()]
    best = sorted((-n, v is not None, v or 0) for v, n in Counter(values).items())[:10]
    assert found == [(k + 1, v if some else None, v % 3 if some else None, -n) for k, (n, some, v) in enumerate(best)]


def test_top_keys_of_few(spark):
    table = spark.createDataFrame([("a",), ("b",), ("a",)], "v string")
    assert [tuple(r) for r in heavyhitters.top_keys(table, ["v"], 5).orderBy("rank").collect()] == [(1, "a", 2), (2, "b", 1)]
    assert heavyhitters.top_keys(table.limit(0), ["v"], 5).collect() == []


@pytest.mark.parametrize("width, levels, pairs", [(None, None, 1 << 22), (4, 3, 1 << 22), (None, None, 40)])
def test_overlaps(spark, monkeypatch, width, levels, pairs):
    """Points, short and very long intervals, empty ones and nulls; with small bounds bins are cut."""
    monkeypatch.setattr(intervals, "PAIRS", pairs)
    rnd = random.Random(4)

    def some(number, lengths):
        starts = [rnd.choice([rnd.randint(-5000, 5000), 17]) for _ in range(number)]
        return [(i, s, s + rnd.choice(lengths)) for i, s in enumerate(starts)]

    ours, theirs = some(200, [0, 1, 5, 30, 1000, 100_000]), some(150, [1, 2, 300, 20_000])
    schema = "i long, s long, e long"
    left = spark.createDataFrame([*ours, (900, None, 5), (901, 5, None)], schema)
    joined = intervals.overlap_join(left, ("s", "e"), spark.createDataFrame(theirs, schema), ("s", "e"), width, levels)
    found = sorted(tuple(r) for r in joined.select("left.i", "right.i").collect())
    assert found == sorted((a, b) for a, s, e in ours for b, t, f in theirs if max(s, t) < min(e, f))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("bits, lot", [(17, 1 << 18), (4, 7)])
def test_overlap_counts(spark, monkeypatch, bits, lot):
    """Points at one time, null times and keys, windows from end to end, values of `by` that repeat, with equal windows and with others."""
    monkeypatch.setattr(intervals, "BLOCK_BITS", bits)
    monkeypatch.setattr(intervals, "LOT", lot)
    rnd = random.Random(6)
    points = [(rnd.choice([None, 7, rnd.randint(-500, 500)]), rnd.choice([None, "hot", *"abcdefgh"])) for _ in range(400)]
    points += [(7, "hot")] * 90
    windows = [(i, s, s + rnd.choice([0, 1, 9, 200, 3000])) for i, s in enumerate(rnd.choice([7, rnd.randint(-600, 600)]) for _ in range(120))]
    windows += [(1000, -50, 50)] * 3 + [(1001, -50, 50), (1001, 0, 60), (1001, 400, 480), (None, 7, 8), (None, 3, 8), (1002, 2000, 3000)]
    windows += [(1003, None, 5), (1004, 5, None), (1005, 9, 3)]
    table = spark.createDataFrame(points, "at long, who string")
    found = intervals.overlap_counts(table, "at", "who", spark.createDataFrame(windows, "w long, s long, e long"), ("s", "e"), "w")
    wanted = defaultdict(list)
    for w, s, e in windows:
        if s is not None and e is not None:
            wanted[w] += [k for t, k in points if t is not None and s <= t < e]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(((w, len(k), len({*k} - {None})) for w, k in wanted.items() if k), key=str)


def test_overlap_counts_without_pairs(spark):
    """Points that all lie in all windows: no step makes a row for each pair."""
    points = spark.range(3000).select((F.col("id") % 50).alias("at"), F.col("id").alias("who"))
    windows = spark.range(2000).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("s"), F.lit(50).cast("long").alias("e"))
    found = intervals.overlap_counts(points, "at", "who", windows, ("s", "e"), "w")
    assert {tuple(r)[1:] for r in found.collect()} == {(3000, 3000)}
    assert intervals.overlap_counts(points, "at", "who", windows.limit(0), ("s", "e"), "w").collect() == []
    assert "count(distinct" not in found._jdf.queryExecution().executedPlan().toString()


def test_no_overlaps(spark):
    empty = spark.createDataFrame([], "s long, e long")
    some = spark.createDataFrame([(1, 5)], "s long, e long")
    for one, two in ((empty, some), (some, empty), (empty, empty)):
        assert intervals.overlap_join(one, ("s", "e"), two, ("s", "e")).collect() == []


def test_neighbours(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([1, 2, None]), rnd.randint(0, 3000), rnd.randint(0, 9)) for _ in range(20_000)]
    table = spark.createDataFrame(rows, "a long, b long, t long")
    exact = defaultdict(set)
    for a, b, t in rows:
        for w in range(t, t + 3):
            exact[a, w].add(b)
    wanted = {k: len(v) for k, v in exact.items() if k[0] is not None}
    found = {(r["node"], r["window"]): r["n"] for r in neighbours.window_neighbours(table, "a", "b", F.col("t"), 3).collect()}
    assert found == wanted
    estimated = {(r["node"], r["window"]): r["n"] for r in neighbours.window_neighbours_estimated(table, "a", "b", F.col("t"), 3).collect()}
    # Five standard deviations of 1.6 %.
    assert estimated.keys() == wanted.keys() and all(abs(estimated[k] / n - 1) < 0.08 for k, n in wanted.items())


def test_neighbours_in_partitions_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS", 500)
    rows = spark.range(20_000).select((F.col("id") % 3).alias("a"), (F.col("id") % 7000).alias("b"), (F.col("id") % 4).alias("t"))
    found = neighbours.window_neighbours(rows, "a", "b", F.col("t"), 2)
    wanted = defaultdict(set)
    for i in range(20_000):
        for w in range(i % 4, i % 4 + 2):
            wanted[i % 3, w].add(i % 7000)
    assert {(r["node"], r["window"]): r["n"] for r in found.collect()} == {k: len(v) for k, v in wanted.items()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    # One shuffle of edges over 20,000 / 500 partitions, one of counts; the first part of the plan is the one that ran.
    assert ", 40), REPARTITION_BY_NUM" in plan and plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 2


def test_place_in_one_group(spark):
    """All rows in one cell: only the tie column tells them apart."""
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(1).alias("g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = nth_in_group(rows, ["g"], [], ["ts", "id"]).collect()
        assert all(r["nth"] == r["id"] + 1 for r in placed) and len(placed) == 5000
        halves = rows.withColumn("half", F.col("id") / 2)
        found, count = numbered(halves, "-half", "id")
        assert count == 5000 and found.filter("pos <> 4999 - id").isEmpty()
        for order in (["ts"], ["half", "ts"], ["g", "ts"]):
            with pytest.raises(ValueError, match="not unique"):
                numbered(halves.union(halves), *order)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
