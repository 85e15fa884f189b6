"""URL verdicts by rules for hosts and paths, then by a list of canonical URLs behind a blocked Bloom filter.

The filter is broadcast; its size is bounded whatever the length of the list (see `bloom`). Pages whose URL it does not
let through are done without a shuffle. The others go to an exact hash join with the list, which removes the false positives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.bloom import MAX_BLOCKS, probed
from flowloom.sources.staging import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host and path without `www.` and `m.`, a closing `/` or `.html`; null without a host."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"(/|\.html)$", "")))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest of (verdict, host, path prefix) that fits, as a struct (rule, verdict); null if none does.

    A rule fits its host and all subdomains. Of rules of one length, the first given holds.
    """
    fits = [
        (F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")), ((host == h) | host.endswith("." + h)) & path.startswith(p))
        for v, h, p in sorted(rules, key=lambda rule: -len(rule[1] + rule[2]))
    ]
    return F.coalesce(*[F.when(condition, rule) for rule, condition in fits]) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def judged(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
    most: int = MAX_BLOCKS,
) -> DataFrame:
    """Per row: id, host, path, rule, verdict. `listed` has canonical URLs to block in `canonical`; nulls in it say nothing.

    The rules' verdict comes first; without one, a listed page is blocked and any other allowed. A null URL or one without
    `://` has an empty host and path, fits no rule and is allowed. Rows that repeat are judged each; null ids stay null. Only the
    two columns are read. An empty list blocks nothing.
    """
    # Read for its size, the filter and the join.
    names = stage(listed.select("canonical").filter("canonical is not null").distinct(), "listed")
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)).withColumn("key", canonical(F.col("host"), F.col("path")))
    ruled = rows.filter("fit is not null").withColumn("verdict", F.col("fit.verdict"))
    possible, clear = probed(rows.filter("fit is null"), F.col("key"), names, "canonical", most)
    columns = ["id", "host", "path", "fit"]
    passed = clear.select(*columns, F.lit("allow").alias("verdict"))
    exact = names.select(F.col("canonical").alias("key"), F.lit(True).alias("on_list"))
    checked = possible.join(exact, "key", "left")
    checked = checked.select(*columns, F.when(F.col("on_list"), "block").otherwise("allow").alias("verdict"))
    done = ruled.select(*columns, "verdict").union(passed).union(checked)
    return done.select(F.col("id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"), "verdict")


def repeated_urls(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """A list: canonical URLs under which two or more pages stand."""
    url = F.col(f"`{url_col}`").cast("string")
    keys = pages.select(canonical(host_of(url), path_of(url)).alias("canonical")).filter("canonical is not null")
    return keys.groupBy("canonical").agg(F.count("*").alias("n")).filter("n > 1").select("canonical")
