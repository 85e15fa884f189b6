r"""Personal data in texts: four kinds found by patterns, and more by contexts learnt from these, in DataFrame operations only.

Base spans are the leftmost non-overlapping matches of each kind (email, ip, card, phone); matches that fail their check are dropped and not
tried again. The patterns here give the same matches as the plain ones in `PLAIN`, but each place of a text is tried once
and repetitions are possessive, so they take linear time and no stack however long a run is.

A text is searched once, for runs of tokens that hold a digit or `@`, joined by a space and further spaces, dots, hyphens or brackets.
Each base span lies inside one run, so the kinds are searched in runs only.

The method bootstraps from the base spans. Candidates are runs, cut of
punctuation, of one of four shapes: with `@`, with three dots or more, with 13 digits or more, with 7 to 12 digits. A candidate
whose run holds a base span is a seed of its kind (the first listed). Lexical patterns are the words around a candidate: the one
before, the two before, the one after, and the ones on both sides, lower-cased, looked for within 64 characters, each with the shape.
Patterns and candidates' values form a graph, and scores, in thousandths, go to and fro on it for a fixed number of rounds: a
pattern's score for a kind is the mean score of its distinct values, a value's score is that of its best pattern, and
seeds keep 1000 for their own kind and 0 for others. A pattern counts when its score and the number of its distinct seeds
reach two bounds. At the end, candidates under a pattern that counts become spans of its kind (the highest score, then the kind
listed first), if their own value is no seed and their run holds no base span.

Positions are summed up in blocks of matches, so a text with very many of them needs no quadratic time. Edges are
joined with scores by `heavy_joined`: a word or value that holds a large share of all edges is broadcast, not shuffled.

Nulls: a null text is empty, a null doc_id stays one; repeated rows are rows of their own. Empty texts and tables have no spans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.heavy import heavy_joined
from flowloom.llm.rowids import with_rid
from flowloom.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")
#: Fixed by the contract, as other engines write them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_LINEAR = {
    "email": r"(?:(?<![A-Za-z0-9._%+\-])|\G)[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20\-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9\-]+[0-9]",
}
#: A text without a match of this has none of the kind.
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
_CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+(?:\x20[\x20().\-]*+[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)*+"
_WORD = r"[^\x20\x09-\x0D]+"
_LEAD, _TRAIL = "\"'[{<>}]),.;:!?*#&%$|=", "\"'([{<>}]),.;:!?*#&%$|="
CONTEXT = 64
_BLOCK = 256
_MATCHES = "array<struct<hit:string,start:bigint,before:string,after:string>>"

ROUNDS, LEAST_SCORE, LEAST_SEEDS = 3, 800, 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also where `body` uses it inside other functions' lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(steps: Column) -> Column:
    """Sums of an array from its beginning, block by block. `steps` is a bound value."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int"))

    def add(acc: Column, x: Column) -> Column:
        return F.struct(F.concat(acc["all"], F.array(acc["sum"] + x)).alias("all"), (acc["sum"] + x).alias("sum"))

    def inside(block: Column) -> Column:
        begin = F.struct(F.array().cast("array<bigint>").alias("all"), F.lit(0).cast("bigint").alias("sum"))
        return F.aggregate(F.slice(steps, block * _BLOCK + 1, _BLOCK), begin, add)

    # One entry for each block; the sums of those before it.
    begin = F.struct(F.array().cast("array<array<bigint>>").alias("all"), F.lit(0).cast("bigint").alias("sum"))

    def shift(acc: Column, part: Column) -> Column:
        moved = F.transform(part["all"], lambda x: x + acc["sum"])
        return F.struct(F.concat(acc["all"], F.array(moved)).alias("all"), (acc["sum"] + part["sum"]).alias("sum"))

    sums = F.flatten(F.aggregate(F.transform(blocks, inside), begin, shift)["all"])
    return F.when(F.size(steps) > 0, sums).otherwise(F.array().cast("array<bigint>"))


def _matches(text: Column, pattern: str, needs: str) -> Column:
    """(hit, start, before, after) of each match: its text, where it begins in code points, and the texts between matches beside it."""

    def placed(cut: Column) -> Column:
        number = F.size(cut["hits"])
        between = F.transform(F.slice(cut["gaps"], 1, number), lambda g: F.char_length(g).cast("bigint"))
        lengths = F.transform(cut["hits"], lambda h: F.char_length(h).cast("bigint"))
        ahead = F.slice(F.concat(F.array(F.lit(0).cast("bigint")), lengths), 1, number)
        steps = F.zip_with(between, ahead, lambda a, b: a + b)
        zipped = F.arrays_zip(
            cut["hits"].alias("hit"),
            _let(steps, _running).alias("start"),
            F.slice(cut["gaps"], 1, number).alias("before"),
            F.slice(cut["gaps"], 2, number).alias("after"),
        )
        return zipped.cast(_MATCHES)

    cut = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(needs), _let(cut, placed)).otherwise(F.array().cast(_MATCHES))


def _luhn(digits: Column) -> Column:
    """Whether the check digit of 14 to 19 digits is right."""

    def value(i: Column) -> Column:
        digit = F.substr(digits, F.char_length(digits) - i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    places = F.sequence(F.lit(1), F.char_length(digits))
    return F.aggregate(places, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def _holds(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return hit.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|\z)){4}\z")
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "phone":
        return F.char_length(digits).between(10, 15)
    return F.when(F.char_length(digits).between(14, 19), _luhn(digits)).otherwise(False)


_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"
_RUN = f"struct<base:{_SPANS},start:bigint,end:bigint,kind:int,value:string,patterns:array<string>>"


def base_spans(text: Column) -> Column:
    """(start, kind, end) of the base spans, in order."""

    def of(k: int, kind: str) -> Column:
        def span(m: Column) -> Column:
            found = F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), (m["start"] + F.char_length(m["hit"])).alias("end"))
            return F.when(_holds(kind, m["hit"]), found)

        return F.filter(F.transform(_matches(text, _LINEAR[kind], _NEEDS[kind]), span), lambda s: s.isNotNull()).cast(_SPANS)

    return F.sort_array(F.concat(*[of(k, kind) for k, kind in enumerate(KINDS)]))


def _shape(value: Column) -> Column:
    digits = F.char_length(F.regexp_replace(value, "[^0-9]", ""))
    dots = F.char_length(value) - F.char_length(F.replace(value, F.lit("."), F.lit("")))
    return (
        F.when(value.contains("@"), "at")
        .when((dots >= 3) & (digits >= 4), "dots")
        .when(digits >= 13, "long")
        .when(digits >= 7, "short")
    )


def runs(text: Column) -> Column:
    """The candidates' runs: their base spans, and (start, end, kind, value, patterns) of the candidate; see `_RUNS`."""

    def words(part: Column) -> Column:
        return F.regexp_extract_all(F.lower(part), F.lit(_WORD), F.lit(0))

    def named(run: Column) -> Column:
        # A null word or shape makes the pattern null.
        mark, one, two, after = F.concat(run["shape"], F.lit(" ")), run["one"], run["two"], run["next"]
        patterns = F.array(
            F.concat(mark, one, F.lit(" _")),
            F.concat(mark, two, F.lit(" "), one, F.lit(" _")),
            F.concat(mark, F.lit("_ "), after),
            F.concat(mark, one, F.lit(" _ "), after),
        )
        end = run["start"] + F.char_length(run["value"])
        kind = F.array_min(F.transform(run["base"], lambda s: s["kind"]))
        return F.struct(run["base"], run["start"], end, kind, F.lower(run["value"]), F.array_compact(patterns)).cast(_RUN)

    def run(m: Column) -> Column:
        def shifted(s: Column) -> Column:
            return F.struct((s["start"] + m["start"]).alias("start"), s["kind"], (s["end"] + m["start"]).alias("end"))

        bare = F.ltrim(m["hit"], F.lit(_LEAD))
        value = F.rtrim(bare, F.lit(_TRAIL))
        before, after = words(F.right(m["before"], F.lit(CONTEXT))), words(F.left(m["after"], F.lit(CONTEXT)))
        parts = F.struct(
            F.transform(base_spans(m["hit"]), shifted).cast(_SPANS).alias("base"),
            (m["start"] + F.char_length(m["hit"]) - F.char_length(bare)).alias("start"),
            value.alias("value"),
            _shape(value).alias("shape"),
            F.try_element_at(before, F.lit(-1)).alias("one"),
            F.try_element_at(before, F.lit(-2)).alias("two"),
            F.get(after, F.lit(0)).alias("next"),
        )
        return _let(parts, named)

    return F.transform(_matches(text, _CANDIDATE, "[0-9@]"), run)


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, doc_id, base, runs), staged."""
    rows, _ = with_rid(docs, id_col, text_col)
    found = stage(rows.select("rid", "doc_id", runs(F.col("text")).alias("runs")), "spans")
    # Runs are in order and apart, so their spans are in order too.
    return found.withColumn("base", F.flatten(F.transform("runs", lambda r: r["base"])))


def learnt_patterns(
    edges: DataFrame, values: DataFrame, rounds: int = ROUNDS, least_score: int = LEAST_SCORE, least_seeds: int = LEAST_SEEDS
) -> DataFrame:
    """(pattern, kind, score) of the patterns that count after so many rounds, from distinct edges (pattern, value) and seeds (value, kind)."""
    one = F.lit(1).alias("seeds")
    scores = values.select("value", "kind", F.lit(1000).alias("score"), one)
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    counting = None
    for turn in range(rounds):
        # A value may have scores of several kinds, so they come as one array.
        packed = scores.groupBy("value").agg(F.collect_list(F.struct("kind", "score", "seeds")).alias("scores"))
        met = heavy_joined(edges, stage(packed, "scores"), ["value"]).select("pattern", F.explode("scores").alias("s"))
        summed = met.groupBy("pattern", F.col("s.kind").alias("kind")).agg(F.sum("s.score").alias("sum"), F.sum("s.seeds").alias("seeds"))
        # Both sides have a pattern once, or once for each kind.
        scored = summed.join(sizes, "pattern").select("pattern", "kind", F.floor(F.col("sum") / F.col("n")).cast("int").alias("score"), "seeds")
        counting = stage(scored.filter((F.col("score") >= least_score) & (F.col("seeds") >= least_seeds)), "patterns")
        if turn + 1 == rounds:
            break
        packed = counting.groupBy("pattern").agg(F.collect_list(F.struct("kind", "score")).alias("scores"))
        reached = heavy_joined(edges, packed, ["pattern"]).select("value", F.explode("scores").alias("s"))
        best = reached.groupBy("value", F.col("s.kind").alias("kind")).agg(F.max("s.score").alias("score"))
        others = best.join(values.select("value"), "value", "left_anti").withColumn("seeds", F.lit(0))
        scores = stage(values.select("value", "kind", F.lit(1000).alias("score"), one).unionByName(others), "values")
    return counting


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds: int) -> DataFrame:
    """(rid, doc_id, base, added): the spans (start, kind, end) of each document. `bounds` are those of `learnt_patterns`."""
    found = _found(docs, id_col, text_col)
    seen = found.select("rid", F.explode("runs").alias("r")).select("rid", "r.start", "r.end", "r.kind", "r.value", "r.patterns")
    # A value that was seen as several kinds counts as the first.
    values = stage(seen.filter("kind is not null").groupBy("value").agg(F.min("kind").alias("kind")), "seeds")
    edges = stage(seen.select(F.explode("patterns").alias("pattern"), "value").distinct(), "edges")
    counting = learnt_patterns(edges, values, **bounds)
    open_ones = seen.filter("kind is null").join(values.select("value"), "value", "left_anti")
    places = stage(open_ones.select("rid", "start", "end", F.explode("patterns").alias("pattern")), "open")
    packed = counting.groupBy("pattern").agg(F.max(F.struct("score", (-F.col("kind")).alias("less"))).alias("best"))
    chosen = heavy_joined(places, packed, ["pattern"]).groupBy("rid", "start", "end").agg(F.max("best").alias("best"))
    span = F.struct("start", (-F.col("best.less")).cast("int").alias("kind"), "end")
    # One text's spans.
    added = chosen.groupBy("rid").agg(F.sort_array(F.collect_list(span)).alias("added"))
    return found.join(added, "rid", "left").select(
        "rid", "doc_id", "base", F.coalesce("added", F.array()).cast(_SPANS).alias("added")
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    said = F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(said, ",")


def digest(found: DataFrame) -> DataFrame:

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    every = F.sort_array(F.concat("base", "added"))
    return found.select(
        "doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(every).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
