"""From raw documents to token ids: five stages, each of which works on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A text
that a stage shortens gets its number of characters anew. Near-duplicates are judged on shingles of five words.

Defined results: documents with a null, empty or blank text fail the quality rules and go there. Rows without a doc_id
stay in every stage. Rows that share an id are judged one by one,
and are one document for the near-duplicates. Null languages and sources are groups of their own. Of equal documents the
smallest id stays. An empty table passes through all stages as an empty one. Columns beside those of documents are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import byte_bpe, decontamination, line_dedup, minhash, quality_rules
from tallywright.llm.storage import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs.select(*COLUMNS))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(line_dedup.without_passages(docs.select(*COLUMNS)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.representatives(docs.select(*COLUMNS), minhash.MinHash(shingle=5, similar=80))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _documents(decontamination.cleaned(docs.select(*COLUMNS), benchmark))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.round_trip(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = docs.select("doc_id", "lang", "source", encoded("text").alias("e"))
    return rows.select("doc_id", "lang", "source", F.size("e.ids").cast("long").alias("n_tokens"), "e.ids", F.col("e.same").alias("round_trip"))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near-duplicates", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", token_stage),
]

#: MinHash and the merges of the tokenizer cannot be expressed in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"stage-{number}")
    return docs
