"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Base. Counts of words, symbols, repeated lines and repeated three-word windows; a text with fewer than 50 words or with more
than half its words in repeated windows fails.

Thresholds. Each rule rejects a text whose feature is above a cutoff of its stratum (the language). Labelled texts that
pass the base are dealt into two halves by a hash of their id. The design half proposes: cutoffs are upper quantiles of
the good texts' feature, each valued by the bad texts it rejects less 20 times the good ones. The holdout half decides:
the false rejection rate of a cutoff is above the allowed rate a with an exact binomial p-value P(Bin(n, a) <= x), where x
of n good texts are rejected. Cutoffs are tested from the highest down and testing stops at the first that fails
(a fixed sequence needs no correction); over strata and rules the level is divided (Bonferroni), and a stratum's allowed rate
is shared out over its rules. Only rules whose value on the design half is at least a twentieth of its bad texts are tested, which the holdout has no part in. So with probability 1 - `level`, no stratum loses more than `risk` of its good texts by all rules
together. Of the cutoffs that pass, the one with the best value is taken; a stratum with too few labels for a proof gets no rule.
The labels must be a sample of the texts to be judged; copies among them make the proof weaker than it looks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.bloom import fresh_names, without
from flowloom.llm.rowids import keyed
from flowloom.sources.staging import stage, staged_result

RISK, LEVEL = 0.02, 0.05
MIN_WORDS, MAX_REPEATED = 50, 50
# A rejected good text costs as much as this many rejected bad ones gain; a rule must find this share of the bad ones.
_PRICE, _LEAST_SHARE = 20, 0.05
_QUANTILES = (0.9, 0.95, 0.98, 0.99, 0.995, 0.998, 0.999, 1.0)
# White space that separates words, and the symbols that are counted.
_SPACES, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
_HAS_WORD = r"[^\x20\x09-\x0D]"
_PLACE_BITS = 24
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often it is used inside lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def _same(array: Column, key, element: Column, i: Column) -> Column:
    """The key of an element of a sorted array equals that of a neighbour."""
    ahead, behind = key(F.get(array, i + 1)) == key(element), key(F.get(array, i - 1)) == key(element)
    return F.coalesce(ahead, F.lit(False)) | F.coalesce(behind, F.lit(False))


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more.

    Windows are sorted as one number each, 40 bits of hash and 24 of place; only those with an equal neighbour are
    compared as text. Longer texts have all windows compared. Windows found twice, by place, cover 3 words each or up to the next.
    """

    def gram(w: Column, i: Column) -> list[Column]:
        return [F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)]

    def candidates(w: Column, last: Column) -> Column:
        mask = F.lit((1 << (64 - _PLACE_BITS)) - 1)
        number = lambda i: F.shiftleft(F.xxhash64(*gram(w, i)).bitwiseAND(mask), _PLACE_BITS).bitwiseOR(i.cast("long"))
        key = lambda x: F.shiftright(x, _PLACE_BITS)
        fast = _let(
            F.sort_array(F.transform(F.sequence(F.lit(0), last), number)),
            lambda s: F.transform(
                F.filter(s, lambda x, i: _same(s, key, x, i)),
                lambda x: x.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int"),
            ),
        )
        return F.when(last < (1 << _PLACE_BITS), fast).otherwise(F.sequence(F.lit(0), last))

    def covered(w: Column) -> Column:
        texts = lambda places: F.sort_array(
            F.transform(places, lambda p: F.struct(F.concat_ws(" ", *gram(w, p)).alias("g"), p.alias("p")))
        )
        found = lambda t: F.sort_array(
            F.transform(F.filter(t, lambda e, i: _same(t, lambda x: x["g"], e, i)), lambda e: e["p"])
        )
        widths = lambda ps: F.transform(
            ps, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(ps, i + 1) - p, F.lit(3))).cast("long")
        )
        total = lambda ps: F.aggregate(widths(ps), F.lit(0).cast("long"), lambda a, x: a + x)
        repeated = lambda places: F.when(F.size(places) == 0, F.lit(0).cast("long")).otherwise(
            _let(texts(places), lambda t: _let(found(t), total))
        )
        return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(_let(candidates(w, F.size(w) - 3), repeated))

    return _let(words, covered)


def measures(text: Column) -> Column:
    """A struct of the base counts and of what the rules use; a null text has no words."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    chars = F.char_length(text)
    blank = F.translate(text, _SPACES, " " * len(_SPACES))
    words = F.filter(F.split(blank, " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(_HAS_WORD))
    line_counts = _let(lines, lambda ls: F.struct(F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup")))
    word_counts = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeat")))
    upper = F.char_length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    return F.struct(
        word_counts.alias("words"),
        F.char_length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
        (chars - F.char_length(F.translate(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        line_counts.alias("lines"),
        upper.cast("long").alias("n_upper"),
        (chars - F.char_length(F.translate(text, "!?", ""))).cast("long").alias("n_marks"),
    )


def _fields(m: str) -> dict[str, Column]:
    """The base counts of a struct of measures."""
    return {
        "n_words": F.col(f"{m}.words.n").cast("long"),
        "word_chars": F.col(f"{m}.word_chars"),
        "n_symbols": F.col(f"{m}.n_symbols"),
        "n_dup_lines": F.col(f"{m}.lines.dup").cast("long"),
        "n_repeat_words": F.col(f"{m}.words.repeat"),
    }


def _base_failed(m: str) -> Column:
    counts = _fields(m)
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED * counts["n_words"])


def _features(m: str) -> dict[str, Column]:
    """What the rules compare, larger is worse."""
    counts = _fields(m)
    words = F.greatest(counts["n_words"], F.lit(1))
    return {
        "symbols": counts["n_symbols"] / words,
        "dup_lines": counts["n_dup_lines"] / F.greatest(F.col(f"{m}.lines.n"), F.lit(1)),
        "repeats": counts["n_repeat_words"] / words,
        "capitals": F.col(f"{m}.n_upper") / F.greatest(counts["word_chars"], F.lit(1)),
        "marks": F.col(f"{m}.n_marks") / words,
        "long_words": counts["word_chars"] / words,
        "short_words": -counts["word_chars"] / words,
    }


def binomial_below(n: Column, x: Column, rate: Column) -> Column:
    """P(Bin(n, rate) <= x) for x below n * rate; 1 above, where nothing can be proven."""
    step, none = F.log(rate / (1 - rate)), n * F.log(1 - rate)
    start = F.struct(none.alias("log"), F.exp(none).alias("sum"))

    def add(state: Column, k: Column) -> Column:
        log = state["log"] + F.log((n - k + 1) / k) + step
        return F.struct(log.alias("log"), (state["sum"] + F.exp(log)).alias("sum"))

    ks = F.when(x > 0, F.sequence(F.lit(1).cast("long"), x)).otherwise(F.array().cast("array<bigint>"))
    return F.when(x < n * rate, F.aggregate(ks, start, add, lambda state: state["sum"])).otherwise(1.0)


def cutoffs(labelled: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """From (id, stratum, good, feature columns in `features`, a map): (stratum, feature, cutoff) that are proven."""
    rows = labelled.select(
        "stratum", "good", (F.pmod(F.xxhash64("id"), F.lit(2)) == 0).alias("design"), F.explode("features").alias("feature", "value")
    )
    proposed = rows.filter("design and good").groupBy("stratum", "feature").agg(
        F.array_distinct(F.percentile_approx("value", list(_QUANTILES), 10_000)).alias("cuts")
    )
    # Cutoff k is passed by the values that lie above k + 1 of the sorted cutoffs.
    above = F.size(F.filter("cuts", lambda c: F.col("value") > c))
    flag = lambda condition: F.count_if(condition)
    counts = rows.join(proposed, ["stratum", "feature"]).groupBy("stratum", "feature", "cuts", above.alias("above")).agg(
        flag(F.col("design") & F.col("good")).alias("design_good"),
        flag(F.col("design") & ~F.col("good")).alias("design_bad"),
        flag(~F.col("design") & F.col("good")).alias("held_good"),
    )
    group = counts.groupBy("stratum", "feature", "cuts").agg(
        F.collect_list(F.struct("above", "design_good", "design_bad", "held_good")).alias("bins"),
        F.sum("held_good").alias("n"), F.sum("design_bad").alias("bad"),
    )
    each = group.select("stratum", "feature", "n", "bad", "bins", F.posexplode("cuts").alias("k", "cutoff"))

    def rejected(field: str) -> Column:
        bins = F.filter("bins", lambda b: b["above"] > F.col("k"))
        return F.aggregate(F.transform(bins, lambda b: b[field]), F.lit(0).cast("long"), lambda a, x: a + x)

    valued = each.select(
        "stratum", "feature", "cutoff", "n", "bad", rejected("held_good").alias("x"),
        (rejected("design_bad") - _PRICE * rejected("design_good")).alias("value"),
    )
    # A few rows for each stratum.
    valued = stage(valued, "cuts")
    useful = valued.groupBy("stratum", "feature").agg(F.max("value").alias("best"), F.first("bad").alias("all_bad"))
    useful = useful.filter((F.col("best") > 0) & (F.col("best") >= _LEAST_SHARE * F.col("all_bad"))).drop("all_bad")
    shares = useful.groupBy("stratum").agg((F.lit(risk) / F.count("*")).alias("rate"))
    tests = max(1, useful.count())
    chosen = valued.join(useful, ["stratum", "feature"]).join(shares, "stratum")
    p_value = binomial_below(F.col("n"), F.col("x"), F.col("rate"))
    tested = chosen.select("stratum", "feature", "cutoff", "value", (p_value <= level / tests).alias("proven"))
    down = Window.partitionBy("stratum", "feature").orderBy(F.desc("cutoff"))
    passed = tested.withColumn("all", F.min("proven").over(down)).filter("all and value > 0")
    return passed.groupBy("stratum", "feature").agg(F.max_by("cutoff", F.struct("value", "cutoff")).alias("cutoff"))


def judged(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
    label_col: str = "quality", keep: tuple[str, ...] | None = None, risk: float = RISK, level: float = LEVEL,
) -> tuple[DataFrame, str]:
    """The rows of `docs` (the columns in `keep`, or all) with one more column, a struct, and that column's name.

    The struct holds the five base counts, `base_failed`, `kept` and `broken`, the names of the rules a text breaks. A null or
    empty text has no words and fails the base. A null stratum is one of its own. Labels that are null, or name no text, say
    nothing; a text with several labels counts as bad if one says so, and so do all texts under a repeated id. The measured rows
    are staged once; nothing is shuffled but labels and measures.
    """
    name = fresh_names(docs, "_quality", "_qualitystratum", "_qualityid")[0]
    stratum = F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")) if stratum_col in docs.columns else F.lit("")
    chosen = [F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)]
    scored = stage(docs.select(*chosen, measures(F.col(f"`{text_col}`")).alias(name), stratum.alias(f"{name}stratum"), F.col(f"`{id_col}`").alias(f"{name}id")), "measures")
    marks = labels.filter(f"`{id_col}` is not null and `{label_col}` is not null")
    marks = marks.groupBy(F.col(f"`{id_col}`").alias(f"{name}id")).agg((F.min(f"`{label_col}`") == 1).alias("good"))
    entries = [x for f, value in _features(name).items() for x in (F.lit(f), value.cast("double"))]
    slim = scored.filter(~_base_failed(name)).select(
        F.col(f"{name}id"), F.col(f"{name}stratum").alias("stratum"), F.create_map(*entries).alias("features")
    )
    labelled = slim.join(marks, f"{name}id").withColumnRenamed(f"{name}id", "id")
    both = F.map_from_entries(F.collect_list(F.struct("feature", "cutoff"))).alias(f"{name}limits")
    # One row for each stratum that has rules.
    limits = staged_result(
        docs.sparkSession, lambda: cutoffs(labelled, risk, level).groupBy("stratum").agg(both), "cutoffs"
    ).withColumnRenamed("stratum", f"{name}stratum")
    joined = scored.join(limits, f"{name}stratum", "left")
    limit = F.col(f"{name}limits")
    broken = F.filter(
        F.array(*[F.when(value > F.element_at(limit, f), F.lit(f)) for f, value in _features(name).items()]), lambda f: f.isNotNull()
    )
    failed = _base_failed(name)
    verdict = [*[c.alias(n) for n, c in _fields(name).items()], failed.alias("base_failed")]
    verdict += [broken.alias("broken"), (~failed & (F.size(broken) == 0)).alias("kept")]
    return joined.select(*chosen, F.struct(*verdict).alias(name)), name


def passing(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of `docs`, all columns, that are kept; arguments as for `judged`.

    Only measures are staged, and only the texts of rows that may be rejected are shuffled.
    """
    rows, rid = keyed(docs, id_col)
    verdicts, name = judged(rows, labels, id_col, keep=(rid,), **settings)
    gone = stage(verdicts.filter(f"not {name}.kept").select(rid), "rejected")
    return without(rows, gone, rid).select(*[F.col(f"`{c}`") for c in docs.columns])
