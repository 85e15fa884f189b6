"""Registered queries of this subpackage, one for each operator, and their DuckDB texts where SQL can say the same."""

from __future__ import annotations

import importlib
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.llm import op1_decontaminate, op2_tokenfile, op3_quality, op4_counts, op5_bpe, op6_chat, op7_urls, op8_jaccard, op9_suffix, op10_substring, op11_prefixes, op12_pii, op13_repair
from flowloom.llm.conversation_sql import OP11_SQL, OP13_SQL
from flowloom.sources.staging import fresh_path


def find_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it. A cluster needs it installed or sent with --py-files."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
        # Workers give freed batches back to the system instead of keeping them.
        spark.sparkContext.environment["ARROW_DEFAULT_MEMORY_POOL"] = "system"


# Documents that go to a Python worker at a time, unless the user has set it.
_BATCH_SETTING, _BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    # SET lists what was set, not the defaults.
    if _BATCH_SETTING not in {row["key"] for row in spark.sql("SET").collect()}:
        spark.conf.set(_BATCH_SETTING, _BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "ids")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    op2_tokenfile.write_ids(table(spark, sf_dir, "documents"), path, tokenizer)
    return op2_tokenfile.digest(op2_tokenfile.read_ids(spark, path))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows, name = op3_quality.judged(docs, labels, keep=("doc_id",))
    return rows.select("doc_id", *[f"{name}.{c}" for c in (*op3_quality.COUNTS, "base_failed", "kept")])


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op5_bpe.digest(op5_bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


SAID = "\\### Assistant: </turn> ok"


def chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as an event log: a row is a message, streamed in deltas of 256 characters.

    A user's message is first sent up to its first delta and then edited; an assistant's first delta is discarded and made again.
    """
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")
    )
    own = spark.createDataFrame([(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)], rows.schema)
    rows = rows.union(own)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("message", F.row_number().over(order))
    pieces = F.regexp_extract_all("text", F.lit("(?s).{1,256}"), F.lit(0))

    def events(kind: str, texts: Column, first: int) -> Column:
        return F.transform(
            texts, lambda t, i: F.struct((i + first).cast("bigint").alias("seq"), F.lit(kind).alias("kind"), t.alias("text"))
        )

    draft = events("delta", F.slice(pieces, 1, 1), 0)
    edit, again = events("edit", F.array("text"), 1), events("regenerate", F.array(F.lit("")), 1)
    made = F.when(F.col("role") == "user", F.concat(draft, edit)).otherwise(F.concat(draft, again, events("delta", pieces, 2)))
    log = rows.select("conv_id", "message", "role", F.explode(made).alias("e"))
    return log.select("conv_id", F.col("message").cast("bigint"), "e.seq", "e.kind", "role", "e.text")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_chat.digest(op6_chat.render(op6_chat.fold(chat_events(spark, sf_dir))))


#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list is made of the canonical URLs under which two or more pages stand."""
    pages = table(spark, sf_dir, "pages")
    return op7_urls.judged(pages, RULES, op7_urls.repeated_urls(pages))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_suffix.digest(op9_suffix.remove_repeats(table(spark, sf_dir, "documents")))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_substring.digest(op10_substring.remove_repeats(table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_pii.digest(op12_pii.personal_data(table(spark, sf_dir, "documents")))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return op13_repair.repair_digest(op13_repair.damaged(rows), rows)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


def queries() -> dict:
    return {
        "pipeline": pipeline,
        "op1_decontamination": op1_decontamination,
        "op2_token_files": op2_token_files,
        "op3_quality_rules": op3_quality_rules,
        "op4_token_counts": op4_token_counts,
        "op5_bpe_roundtrip": op5_bpe_roundtrip,
        "op6_chat_format": op6_chat_format,
        "op7_url_filter": op7_url_filter,
        "op8_ngram_jaccard": op8_ngram_jaccard,
        "op9_suffix_array": op9_suffix_array,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_personal_data": op12_personal_data,
        "op13_structure_repair": op13_structure_repair,
    }


OP6_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, 4 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + 2
           + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) + 8 AS n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, text FROM rows)
), said AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learnt,
    sum(n) AS chars
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256,
  CAST(chars AS BIGINT) AS formatted_chars
FROM said
"""

OP7_SQL = r"""
WITH cut AS (
  SELECT page_id, coalesce(instr(url, '://'), 0) AS pos, url FROM pages
), named AS (
  SELECT page_id,
    CASE WHEN pos = 0 THEN '' ELSE translate(regexp_extract(substr(url, pos + 3), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
    CASE WHEN pos = 0 THEN '' ELSE regexp_extract(substr(url, pos + 3), '^[^/?#]*([^?#]*)', 1) END AS path
  FROM cut
), keyed AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/|\.html)$', '') END AS key,
    CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
    END AS rule
  FROM named
), listed AS (
  SELECT key FROM keyed WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN keyed.key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM keyed
"""


OP8_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)] END) AS s
  FROM cut
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON r = a
)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

OP9_SQL = """
WITH bytes AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), starts AS (
  SELECT doc_id, i, md5(b[i : i + 399]) AS k
  FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 398)) AS i FROM bytes WHERE octet_length(b) >= 400)
), gone AS (
  SELECT s.doc_id, s.i FROM starts s JOIN (SELECT k FROM starts GROUP BY k HAVING count(*) > 1) USING (k)
), marked AS (
  SELECT *, CASE WHEN i > lag(i, 1, -400) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 1 ELSE 0 END AS opens FROM gone
), runs AS (
  SELECT doc_id, min(i) AS first, max(i) + 400 AS behind
  FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run
), parts AS (
  SELECT doc_id, first, behind, lag(behind, 1, 1) OVER (PARTITION BY doc_id ORDER BY first) AS since FROM runs
), cut AS (
  SELECT doc_id, sum(behind - first) AS n_removed, count(*) AS n_spans, max(behind) AS last,
    string_agg(hex(b[since : first - 1]), '' ORDER BY first) AS kept
  FROM parts JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN kept IS NULL THEN b ELSE unhex(kept || hex(b[last :])) END) AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)
"""

OP10_SQL = r"""
WITH cut AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS n
  FROM (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 33, 1))) AS i FROM cut))
), gone AS (
  SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, i + unnest(range(35)) AS j FROM windows WHERE n > 1) GROUP BY doc_id
), words AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS j FROM cut
), kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY j) AS k, count(*) AS n
  FROM words LEFT JOIN (SELECT doc_id, unnest(js) AS j, true AS out FROM gone) USING (doc_id, j) WHERE out IS NULL GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_chat_format": OP6_SQL,
        "op7_url_filter": OP7_SQL,
        "op8_ngram_jaccard": OP8_SQL,
        "op9_suffix_array": OP9_SQL,
        "op10_substring_dedup": OP10_SQL,
        "op11_prefix_trie": OP11_SQL,
        "op13_structure_repair": OP13_SQL,
    }
