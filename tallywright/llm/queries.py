"""The operators as registered queries over the given tables, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    conversation_repair,
    decontamination,
    factorisation_machine,
    line_dedup,
    minhash,
    oracles,
    periodic_runs,
    quality_rules,
    sharding,
    suffix_dedup,
    token_files,
    toxicity,
    warc,
)
from .storage import written
from .training import held_out

SHARDS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = sharding.placed(docs, "doc_id", [1.0] * SHARDS, ties=("text_crc32",))
    rows = sharding.sharded(rows, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = written(quality_rules.measured(docs).drop("text", "n_chars"), "quality-counts")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.judged(counts).select(*columns)


def op1_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = minhash.grouped(docs, minhash.MinHash(shingle=2))
    component = F.col("component").alias("component_id")
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", component, (F.col("id") == F.col("component")).alias("kept"))


def op2_warc_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(warc.planned(table(spark, sf_dir, "pages"), least=1000))
    return warc.read_archives(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    rows = suffix_dedup.deduplicated(docs, suffix_dedup.Repeats(length=100))
    return rows.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _verdicts(scored: DataFrame, threshold: float) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op4_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.log2("n_chars").cast("int").alias("length_class"))
    labels = table(spark, sf_dir, "labels")
    return _verdicts(factorisation_machine.scored(docs, labels, "quality", metadata=("length_class",)), 0.7)


def op5_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _verdicts(toxicity.scored(docs, table(spark, sf_dir, "labels"), "toxic"), 0.3)


def op6_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontamination.with_hits(docs, table(spark, sf_dir, "benchmark"), window=10)
    items = F.array_join(F.array_sort(F.transform("hits.items", lambda i: i.cast("string"))), ",")
    return rows.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        decontamination.n_hit().alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        (decontamination.n_hit() > 0).alias("contaminated"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encode, decode = byte_bpe.functions(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = table(spark, sf_dir, "documents").select("doc_id", encode("text").alias("ids"))
    rows = rows.select("doc_id", "ids", decode("ids").alias("decoded"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return rows.select("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", kept)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_files.write_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_files(manifest).select(
        "doc_id", "start", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as the query damages them: some dropped, emptied, without ends of sentences, doubled or given to the user."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = (F.crc32(F.concat_ws(":", some("conv_id"), some("turn")).cast("binary")) % 20).alias("harm")
    rows = conversations.select("conv_id", "turn", some("role").alias("role"), some("text").alias("text"), harm).where("harm <> 0")
    text = F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    plan = conversation_repair.Repair()
    cut = conversation_repair.segments(damaged(conversations), plan)
    parts = written(conversation_repair.linked(cut), "conversation-parts")
    plans = written(conversation_repair.planned(parts, plan), "conversation-plans")
    audits = conversation_repair.audited(parts, plans)
    digests = conversation_repair.digests(conversation_repair.repaired(cut, plans), parts).withColumnRenamed("conv_id", "hashed")
    found = audits.join(digests, F.col("conv_id").eqNullSafe(F.col("hashed"))).withColumnRenamed("conv_id", "of_conv")
    every = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("of_conv")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; the last words of one document in ten or so repeat themselves, as the query plants them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", (h % 10).alias("turn"), F.floor(h / 10).alias("g"))
    words = F.when(F.col("turn") == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    head = (F.col("g") % F.nullif("n", F.lit(0))).cast("int")
    rows = rows.withColumn("a", head).withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    whole = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n")), " ")
    return rows.select("doc_id", F.when((F.col("turn") == 0) & (F.col("n") > 0), whole).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs.with_runs(planted(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return rows.select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_circulant_minhash": op1_circulant_minhash,
    "op2_warc_ranges": op2_warc_ranges,
    "op3_suffix_array": op3_suffix_array,
    "op4_factorisation_machine": op4_factorisation_machine,
    "op5_ftrl_toxicity": op5_ftrl_toxicity,
    "op6_suffix_automaton": op6_suffix_automaton,
    "op7_rendezvous_sharding": op7_rendezvous_sharding,
    "op8_quality_rules": op8_quality_rules,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_line_chunks": op10_line_chunks,
    "op11_token_files": op11_token_files,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = dict(oracles.SQL)
