"""A corpus pipeline: five stages over `documents`, each working on all rows that the one before it kept.

Every stage is a function (spark, docs, sf_dir) -> DataFrame. `run` writes each stage's result as Parquet in the shared
folder and rereads it as the next one's input. All stages but the last return the columns of `documents`; texts that a
stage shortens have their `n_chars` counted anew.

1. quality rules: texts that fail the base or a proven threshold go.
2. n-gram Jaccard join: of texts linked by five-word shingles at 0.8 or more, the smallest row of each component stays.
3. substring dedup: words covered by a 35-word window that occurs elsewhere go; the rest keeps its own white space.
4. benchmark decontamination: texts that hold a benchmark passage go.
5. BPE encoding and decoding: ids of each text, and the text they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm import op1_decontaminate, op3_quality, op5_bpe, op8_jaccard, op10_substring
from flowloom.llm.queries import table
from flowloom.sources.staging import staged_result


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_quality.passing(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_jaccard.first_of_each(docs, similarity=(80, 100), ngram=5)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shorter = op10_substring.shortened(docs)
    return shorter.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids, decoded."""
    encoded = op5_bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: No SQL says what the thresholds and alignments do; tests compare the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = staged_result(spark, lambda docs=docs, step=step: step(spark, docs, sf_dir), name)
    return docs
