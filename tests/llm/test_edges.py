"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for each operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallywright.llm import (
    byte_bpe,
    decontamination,
    factorisation_machine,
    line_dedup,
    minhash,
    quality_rules,
    sharding,
    suffix_dedup,
    toxicity,
    warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
LONG = " ".join(f"word{k % 977}" for k in range(20_000))
ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \n\t\n ", None, "a", 5),
    (4, PASSAGE + "\nsecond line\nthird line\n", "en", None, 80),
    (5, PASSAGE + "\nsecond line\nthird line\n", "en", "a", 80),
    (5, PASSAGE + "\nsecond line\nthird line\n", "en", "a", 80),
    (None, "no key here", "en", "a", 11),
    (6, LONG, "en", "a", len(LONG)),
    (7, LONG + " tail", "en", "a", len(LONG) + 5),
    (8, "élan ñandú 日本 \U0001f600 " * 5, "es", "b", 90),
    (9, "\r\n\x00\x1f\x85 x", None, None, 6),
]
CLASHES = ("n_words", "kept", "score", "hits", "spans", "n_lines", "shard", "slot", "base_failed", "symbol_share", "key", "band")
#: Names that operators use within.
INNER = ("_lang", "_source", "max_symbol_share", "_counts", "counts", "_first", "_slice", "_place", "slice", "first", "place", "k0")
INNER += ("_key", "_y", "_order", "_spans", "_packed", "_cut", "packed", "found", "cut", "id", "_gone", "component", "row", "_row")
INNER += ("_ld_by", "_ld_chunks", "_ld_lines", "_ld_gone", "_ld_key", "_ld_row", "_ld_id", "part", "no", "before", "path")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in (*CLASHES, *INNER)})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, PASSAGE), (2, None), (None, "alpha beta"), (3, "eta theta"), (3, "eta theta"), (4, "")]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, k % 2, (k + 1) % 2) for k in range(1, 10)] + [(None, 1, 1), (4, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_rules(docs, none):
    rows = quality_rules.judged(quality_rules.measured(docs)).select("doc_id", "n_words", "base_failed", "kept").collect()
    assert len(rows) == len(ROWS)
    assert {r.doc_id for r in rows if r.base_failed} >= {1, 2, 3, 4, 9}
    assert {r.doc_id for r in rows if r.kept} == set()  # the long texts repeat themselves throughout
    assert quality_rules.kept_documents(none).count() == 0


def test_quality_stage_counts_once(spark, sf_dir):
    """One pass of Python over the texts, and no shuffle of texts: the verdicts are those of the query."""
    from tallywright.llm.queries import QUERIES

    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = quality_rules.kept_documents(table)
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "ArrowEvalPython" not in plan and "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    verdicts = QUERIES["op8_quality_rules"](spark, sf_dir).where("kept").select("doc_id")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in verdicts.collect())
    assert kept.columns == table.columns


def test_line_chunks(docs, none):
    rows = line_dedup.deduplicated(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[1].text is None and by[1].n_lines == 0 and by[2].text == "" and by[2].n_lines == 1
    assert by[4].text == ROWS[3][1]
    assert line_dedup.deduplicated(none).count() == 0


def test_minhash(docs, none):
    rows = {r.id: r for r in minhash.grouped(docs).collect()}
    assert len(rows) == 10
    assert rows[5].component == 4 and rows[7].component == 6
    assert all(rows[k].component == k and rows[k].n_shingles == 0 for k in (1, 2, 3))
    assert minhash.representatives(docs).count() == len(ROWS) - 3
    assert minhash.grouped(none).count() == 0


def test_suffix_array(docs, none):
    rows = suffix_dedup.deduplicated(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert bytes(by[1].kept) == b"" and bytes(by[4].kept) == ROWS[3][1].encode() == bytes(by[4].kept)
    assert len(by[7].spans) == 1 and suffix_dedup.deduplicated(none).count() == 0


def test_decontamination(docs, none, benchmark):
    rows = decontamination.with_hits(docs, benchmark).select("doc_id", "hits.*").collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS)
    assert by[4]["items"] == [1, 3] and [(s.begin, s.end) for s in by[4].spans] == [(0, 12)]
    assert by[1].n_words == 0 and by[1].spans == []
    cleaned = {r.doc_id: r.text for r in decontamination.cleaned(docs, benchmark).collect()}
    assert cleaned[1] is None and cleaned[2] == "" and 4 not in cleaned
    assert decontamination.cleaned(none, benchmark).count() == 0
    assert decontamination.with_hits(docs, benchmark.limit(0)).where(F.size("hits.items") > 0).count() == 0
    blocks = decontamination.with_hits(docs, benchmark, block_words=12).select("doc_id", "hits.*").collect()
    assert sorted(map(str, blocks)) == sorted(map(str, rows))


def test_classifiers(docs, none, labels):
    for scored in (
        lambda d, t: factorisation_machine.scored(d, t, "quality", metadata=("source",)),
        lambda d, t: toxicity.scored(d, t, "toxic"),
    ):
        rows = scored(docs, labels).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
        assert scored(none, labels).count() == 0
        assert {r.score for r in scored(docs, labels.limit(0)).collect()} == {0.5}


def test_sharding(docs, none):
    rows = sharding.placed(docs, "doc_id", [1, 2, 0], slices=4).collect()
    assert len(rows) == len(ROWS) and {r.shard for r in rows} <= {0, 1}
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.placed(none, "doc_id", [1]).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of("doc_id", [])


def test_warc(spark):
    schema = "page_id long, url string, html string, url2 string"
    big = "<p>" + "y" * 2000
    pages = [(1, None, None, "x"), (2, "a\r\nb", big, "x"), (3, "c", big, "x"), (3, "c", big, "x"), (None, "d", "z", "x"), (4, "e", "z", "x")]
    manifest = warc.write_archives(warc.planned(spark.createDataFrame(pages, schema)))
    rows = warc.read_archives(manifest, range_bytes=150).collect()
    assert len(rows) == len(pages)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in rows)
    assert kinds == [
        (0, "response", None, 1),
        (1, "response", None, 0),
        (2, "revisit", 3, 2003),
        (3, "response", None, 2003),
        (3, "response", None, 2003),
        (4, "response", None, 1),
    ]
    nothing = warc.write_archives(warc.planned(spark.createDataFrame([], schema)))
    assert warc.read_archives(nothing).count() == 0


def test_columns_of_the_caller_come_back(docs, labels, benchmark):
    """Every extra column has its values after every operator that gives documents back, unless it is named like a result."""
    outs = {
        "measured": quality_rules.measured(docs),
        "judged": quality_rules.judged(quality_rules.measured(docs)),
        "kept": quality_rules.kept_documents(docs),
        "lines": line_dedup.deduplicated(docs),
        "passages": line_dedup.without_passages(docs),
        "sharded": sharding.placed(docs, "doc_id", [1, 2]),
        "suffixes": suffix_dedup.deduplicated(docs),
        "representatives": minhash.representatives(docs),
        "toxicity": toxicity.scored(docs, labels, "toxic"),
        "quality": factorisation_machine.scored(docs, labels, "quality", metadata=("source", "_key")),
        "cleaned": decontamination.cleaned(docs, benchmark),
    }
    for name, out in outs.items():
        assert len(set(out.columns)) == len(out.columns), name
        inner = [c for c in INNER if c != "max_symbol_share" or name != "judged"]
        assert set(inner) <= set(out.columns), name
        assert out.where(" or ".join(f"`{c}` is distinct from 'x'" for c in inner)).count() == 0, name


def test_byte_bpe(spark, docs, none):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encode, decode = byte_bpe.functions(spark, path, public_tokenizers.PATTERN)
    rows = docs.select("text", encode("text").alias("ids")).select("text", "ids", decode("ids").alias("back")).collect()
    assert all(r.back == (r.text or "") for r in rows) and all(r.ids == [] for r in rows if not r.text)
    assert none.select(encode("text").alias("ids")).count() == 0


def test_pipeline_stages(spark, docs, none, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES, 1):
        for frame in (docs, none):
            out = stage(spark, frame, str(tmp_path))
            if number < len(corpus_pipeline.STAGES):
                assert out.columns == list(corpus_pipeline.COLUMNS), name
            assert out.count() <= frame.count()
