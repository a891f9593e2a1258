"""Quality rules with cutoffs that adapt to each language and source.

Every document gets counts (`measured`), of which four shares are judged (`SHARES`). A mergeable quantile sketch per
language and source is a histogram over fixed bins: two sketches merge by adding their counts, so partial aggregation,
order and retries cannot change it, and its quantiles are exact to one bin. A group's quartiles are drawn towards those of
its language and of all documents as if it had `lang_weight` and `all_weight` documents more of these, so that they follow
its own documents the more it has, without a size at which they change. The cutoff is the upper fence `q75 + spread *
max(q75 - q25, unit)`: the unit is the least spread that is taken for one, as most shares are 0 in most documents. A wide
ceiling keeps a group of mostly bad documents from being taken for normal; there is no other fixed cutoff.
The fences, one row per group, are joined to the documents.

Defined results: a null or empty text has no words and fails the base rule. Null languages and sources are groups of
their own. Repeated rows are judged one by one. Extra columns stay, whatever their names; one named like a result is
replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import written
from .words import encoded

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
ROWS_AT_ONCE = 256
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Share:
    """A judged share in thousandths: the least spread that counts, and the ceiling of its cutoff."""

    name: str
    of: str
    by: str
    unit: int
    ceiling: int


SHARES = (
    Share("symbol_share", "n_symbols", "n_words", 20, 700),
    Share("dup_line_share", "n_dup_lines", "n_lines", 45, 700),
    Share("repeat_share", "n_repeat_words", "n_words", 45, 500),
    Share("word_length", "word_chars", "n_words", 100, 20_000),
)


@dataclass(frozen=True)
class Rules:
    """min_words and max_repeat: the base rule. spread: fence width in quartile distances. lang_weight, all_weight: documents
    that the language's and all quartiles count for beside the group's own. bin_width: thousandths that one bin holds."""

    min_words: int = 50
    max_repeat: int = 50
    spread: int = 8
    lang_weight: int = 200
    all_weight: int = 20
    bin_width: int = 5


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pair = code[:-1] * len(ids) + code[1:]
    if len(ids) < 2_000_000:
        window = pair[:-1] * len(ids) + code[2:]
    else:  # the cube would leave 63 bits
        window = np.unique(pair, return_inverse=True)[1][:-1].astype(np.int64) * len(ids) + code[2:]
    _, at, count = np.unique(window, return_inverse=True, return_counts=True)
    twice = count[at] > 1
    hit = np.zeros(len(words), bool)
    for shift in range(3):
        hit[shift : shift + len(twice)] |= twice
    return int(hit.sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    data = encoded(text)
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip(BLANKS)]
    characters = len(text or "") - sum(data.count(BLANKS[i : i + 1]) for i in range(len(BLANKS)))
    symbols = sum(data.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    return len(words), characters, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def _counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Counts of texts, of few at once: a worker never holds a whole batch of texts beside its Arrow form."""
    for texts in batches:
        for at in range(0, len(texts), ROWS_AT_ONCE):
            rows = [counts_of(text) for text in texts.slice(at, ROWS_AT_ONCE).to_pylist()]
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], list(COUNTS))
        pa.default_memory_pool().release_unused()


_counted.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
counts = F.arrow_udf(_counted, T.StructType([T.StructField(name, T.LongType()) for name in COUNTS]))


def measured(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """docs with the counts, the shares and `base_failed`."""
    measures = [*COUNTS, *(s.name for s in SHARES), "base_failed", "kept"]
    names = [c for c in docs.columns if c.lower() not in measures]
    # the caller's columns travel in one struct, so that no name of theirs meets one of these
    frame = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), counts("text").alias("counts"))
    frame = frame.select("row", "counts.*").withColumns({s.name: share(s) for s in SHARES})
    frame = frame.withColumn("base_failed", base_failed(rules))
    return frame.select(*(F.col(f"row.`{c}`") for c in names), *(c for c in frame.columns if c != "row"))


def share(s: Share) -> Column:
    """Whole thousandths, rounded down; 0 where nothing is counted."""
    return F.when(F.col(s.by) > 0, F.expr(f"{s.of} * 1000 div {s.by}")).otherwise(F.lit(0).cast("long"))


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat * F.col("n_words"))


def sketches(measured_docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per language, source, share and filled bin, of the documents that pass the base rule."""
    bins = F.array(*(F.struct(F.lit(s.name).alias("share"), bin_of(s, rules).alias("bin")) for s in SHARES))
    return (
        measured_docs.where(~F.col("base_failed"))
        .select("lang", "source", F.explode(bins).alias("b"))
        .groupBy("lang", "source", "b.share", "b.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bin_of(s: Share, rules: Rules) -> Column:
    """Shares beyond twice the ceiling share the last bin, so that a sketch has a bounded number of bins."""
    return F.expr(f"least({s.name}, {2 * s.ceiling}) div {rules.bin_width}")


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    return sketch.groupBy(*keys, "share", "bin").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, rules: Rules, *keys: str) -> DataFrame:
    """Lower edges of the bins that hold the quartiles, and the documents, per group and share."""
    by = ", ".join([*keys, "share"])
    running = sketch.withColumn("upto", F.expr(f"sum(n) over (partition by {by} order by bin)"))
    running = running.withColumn("total", F.expr(f"sum(n) over (partition by {by})"))
    edge = lambda part: F.min(F.when(4 * F.col("upto") >= part * F.col("total"), F.col("bin"))) * rules.bin_width
    return running.groupBy(*keys, "share").agg(
        edge(1).alias("q25"), edge(3).alias("q75"), F.max("total").alias("documents")
    )


def fences(measured_docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """lang, source and one cutoff `max_<share>` per share; a row for every group that has documents passing the base rule."""
    fine = sketches(measured_docs, rules)
    source = quartiles(fine, rules, "lang", "source")
    lang = quartiles(merged(fine, "lang"), rules, "lang")
    every = quartiles(merged(fine), rules)
    named = lambda frame, prefix: frame.select(
        *(F.col(k).alias(f"{prefix}_{k}") for k in frame.columns if k in ("lang", "share")),
        *(F.col(k).alias(f"{prefix}_{k}") for k in ("q25", "q75", "documents")),
    )
    rows = source.join(
        named(lang, "l"), F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("share") == F.col("l_share"))
    ).join(named(every, "e"), F.col("share") == F.col("e_share"))
    weights = f"(documents + {rules.lang_weight + rules.all_weight})"
    drawn = lambda q: f"((documents * {q} + {rules.lang_weight} * l_{q} + {rules.all_weight} * e_{q}) div {weights})"
    rows = rows.withColumn("low", F.expr(drawn("q25"))).withColumn("high", F.expr(drawn("q75")))
    spread = lambda s: F.greatest(F.col("high") - F.col("low"), F.lit(s.unit).cast("long"))
    fence = lambda s: F.max(F.when(F.col("share") == s.name, F.col("high") + rules.spread * spread(s)))
    return rows.groupBy("lang", "source").agg(
        *(F.least(F.lit(s.ceiling).cast("long"), fence(s)).alias(f"max_{s.name}") for s in SHARES)
    )


def judged(measured_docs: DataFrame, rules: Rules = Rules(), limits: DataFrame | None = None) -> DataFrame:
    """measured documents with the cutoffs of their group and `kept`."""
    limits = fences(measured_docs, rules) if limits is None else limits
    results = [*(f"max_{s.name}" for s in SHARES), "kept"]
    names = [c for c in measured_docs.columns if c.lower() not in results]
    rows = measured_docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))
    same = [F.col(f"row.{c}").eqNullSafe(F.col(c)) for c in ("lang", "source")]
    within = F.lit(True)
    for s in SHARES:
        within = within & F.coalesce(F.col(f"row.{s.name}") <= F.col(f"max_{s.name}"), F.lit(False))
    kept = (~F.col("row.base_failed") & within).alias("kept")
    return rows.join(limits, same, "left").select(*(F.col(f"row.`{c}`") for c in names), *results[:-1], kept)


def kept_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their own columns. Writes now: the documents with their counts, once, so that texts are
    counted once and never shuffled, and the fences, whose few rows meet the documents where they stand."""
    frame = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "text", "lang", "source")
    counted = written(measured(frame, rules).drop("text"), "quality-counts")
    limits = written(fences(counted.drop("_row"), rules), "quality-fences")
    return judged(counted, rules, limits).where("kept").select("_row.*")
