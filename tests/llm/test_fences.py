"""The cutoffs of op8 come from the groups' sketches: they differ between groups, change smoothly with size, and decide."""

from pyspark.sql import functions as F

from tallywright.llm import quality_rules

OTHERS = [f"cast(0 as long) as {s.name}" for s in quality_rules.SHARES[1:]]


def test_two_sources_with_different_levels(spark):
    docs = spark.range(602).select(
        F.col("id").alias("doc_id"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") % 2 == 0, "marked").otherwise("plain").alias("source"),
        F.when(F.col("id") >= 600, 300).when(F.col("id") % 2 == 0, F.col("id") % 100).otherwise(0).cast("long").alias("symbol_share"),
        *map(F.expr, OTHERS),
        F.lit(False).alias("base_failed"),
    )
    rows = quality_rules.judged(docs).collect()
    cutoffs = {r.source: r.max_symbol_share for r in rows}
    # own quartiles 20 and 70 or 0 and 0, those of the language 0 and 50, for 301 documents and 220 more
    high, low, plain = (301 * 70 + 220 * 50) // 521, 301 * 20 // 521, 220 * 50 // 521
    assert cutoffs == {"marked": high + 8 * (high - low), "plain": plain + 8 * plain}
    assert {r.source: r.kept for r in rows if r.symbol_share == 300} == {"marked": True, "plain": False}


def test_no_size_at_which_cutoffs_jump(spark):
    """A group that grows by one document at a time goes from its language's cutoff to its own."""
    last = None
    for size in (1, 20, 199, 200, 201, 1500):
        own = spark.range(size).select(F.lit("small").alias("source"), (F.col("id") * 0 + 60).alias("symbol_share"))
        rest = spark.range(5000).select(F.lit("rest").alias("source"), (F.col("id") * 0).alias("symbol_share"))
        docs = own.unionAll(rest).select(F.lit("en").alias("lang"), "source", "symbol_share", *map(F.expr, OTHERS), F.lit(False).alias("base_failed"))
        cutoff = quality_rules.fences(docs).where("source = 'small'").first().max_symbol_share
        assert cutoff == size * 60 // (size + 220) + 8 * 20
        assert last is None or last[1] <= cutoff and (size - last[0] > 1 or cutoff - last[1] <= 1)
        last = size, cutoff


def test_cutoffs_differ_between_the_groups_of_a_table(spark):
    """On documents with labels: word lengths have a cutoff of their own in most groups, no good document is lost, no bad one kept."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = quality_rules.measured(docs).drop("text").cache()
    cutoffs = quality_rules.fences(counts)
    assert cutoffs.select("max_word_length").distinct().count() > 40
    lengths = quality_rules.judged(counts).where(~F.col("base_failed") & (F.col("word_length") > F.col("max_word_length")))
    assert lengths.count() > 100
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    found = quality_rules.judged(counts).where(~F.col("base_failed")).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    counts.unpersist()
    assert {(r.quality, r.kept) for r in found} == {(0, False), (1, True)}
