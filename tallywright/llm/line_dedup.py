"""Repeated passages of several lines, found as content-defined chunks of lines.

A text's lines are hashed; a rolling hash over the hashes of `width` neighbouring lines ends a chunk after a line where
it is 0 modulo `lines_per_chunk`. The ends depend on the lines around them alone, so a passage that is shifted by other
lines is cut in the same places. Chunks of at least `least` lines that occur more than once, in whatever documents, stay
where they come first (smallest key, then place) and are removed elsewhere, after a comparison of their bytes.

Everything here is built-in SQL functions. Chunks are compared by digest first, so only digests of all chunks are
shuffled; bytes travel for repeated chunks alone, one original per digest, and join the documents by key. A digest that a
third of all documents share is counted on the map side and joined in joins that Spark can split.

Defined results: a null text stays null and has no lines; an empty text is one empty line and stays. A text of which all
is removed becomes empty; no document is dropped. Rows that share a key are taken for one document: what repeats only
among them stays. Extra columns stay, whatever their names; those named like a result are replaced.

Chunks alone lose passages: the lines at a passage's ends share a chunk with lines around it, and a chunk of one line does
not count. `deduplicated` keeps this result, which the SQL of op10_line_chunks defines. `without_passages`, which the
pipeline uses, looks at the rolling hash after every line: each window of `least` neighbouring lines that occurs earlier
(smaller key, then place) is removed, so a repeated passage of `least` lines or more goes whole, wherever it is cut. The
first occurrence of every line stays. Rows without a key are taken for one document there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Chunking:
    width: int = 2
    lines_per_chunk: int = 3
    least: int = 2


def chunked(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """docs with `_ld_chunks`: an array of (n, text), the chunks of the text in order."""
    rolled = f"md5(cast(array_join(slice(_ld_hashes, greatest(i - {chunking.width - 1}, 1), least(i, {chunking.width})), '') as binary))"
    ends = f"""filter(sequence(1, size(_ld_lines)), i -> i = size(_ld_lines)
        or cast(conv(substr({rolled}, 1, 8), 16, 10) as bigint) % {chunking.lines_per_chunk} = 0)"""
    chunks = """zip_with(_ld_ends, slice(array_prepend(_ld_ends, 0), 1, size(_ld_ends)),
        (e, b) -> named_struct('n', e - b, 'text', array_join(slice(_ld_lines, b + 1, e - b), '\n')))"""
    rows = _computed(docs, _ld_lines=F.split("text", "\n", -1))
    rows = _computed(rows, _ld_hashes=F.expr("transform(_ld_lines, l -> md5(cast(l as binary)))"))
    rows = _computed(rows, _ld_ends=F.expr(ends))
    return _computed(rows, _ld_chunks=F.expr(chunks)).drop("_ld_lines", "_ld_hashes", "_ld_ends")


def _computed(rows: DataFrame, **values: Column) -> DataFrame:
    """rows with further columns that are worked out once per row: as a one-element array made rows, they are not put into
    the functions that use them, which would work them out once per line."""
    made = F.explode(F.array(F.struct(*(value.alias(name) for name, value in values.items()))))
    return rows.select("*", made.alias("_ld_made")).select(*(F.col(f"`{c}`") for c in rows.columns), "_ld_made.*")


def _places(docs: DataFrame, key: str, chunking: Chunking, *more: Column) -> DataFrame:
    """A row per chunk of enough lines: the key, its number in the text and what `more` takes of `_ld_chunk`."""
    chunks = chunked(docs.select(F.col(f"`{key}`").alias("_ld_key"), "text"), chunking)
    rows = chunks.select("_ld_key", F.posexplode("_ld_chunks").alias("_ld_at", "_ld_chunk"))
    return rows.where(F.col("_ld_chunk.n") >= chunking.least).select("_ld_key", "_ld_at", *more)


def repeated(docs: DataFrame, key: str = "doc_id", chunking: Chunking = Chunking()) -> DataFrame:
    """One row per document that has chunks to remove: `_ld_key` and `_ld_gone`, their numbers and the originals' text."""
    digest = F.md5(F.col("_ld_chunk.text").cast("binary")).alias("_ld_digest")
    places = _places(docs, key, chunking, digest)
    place = F.struct("_ld_key", "_ld_at")
    firsts = places.groupBy("_ld_digest").agg(
        F.min(place).alias("_ld_first"), F.max(place).alias("_ld_last")
    ).where(F.col("_ld_first") != F.col("_ld_last"))
    copies = places.join(firsts, "_ld_digest").where(place != F.col("_ld_first")).select("_ld_digest", "_ld_key", "_ld_at")
    wanted = firsts.groupBy(F.col("_ld_first._ld_key").alias("_ld_of")).agg(F.collect_set("_ld_first._ld_at").alias("_ld_these"))
    sources = docs.select(F.col(f"`{key}`").alias("_ld_of"), "text").join(wanted, "_ld_of")
    originals = chunked(sources, chunking).select(
        F.explode(F.transform("_ld_these", lambda at: F.get("_ld_chunks", at)["text"])).alias("_ld_text")
    )
    originals = originals.where("_ld_text is not null").select(
        F.md5(F.col("_ld_text").cast("binary")).alias("_ld_digest"), "_ld_text"
    ).groupBy("_ld_digest").agg(F.first("_ld_text").alias("_ld_text"))
    gone = copies.join(originals, "_ld_digest")
    return gone.groupBy("_ld_key").agg(
        F.collect_set(F.struct(F.col("_ld_at").alias("at"), F.col("_ld_text").alias("text"))).alias("_ld_gone")
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", chunking: Chunking = Chunking()) -> DataFrame:
    """docs with the remaining text, and `n_lines`, `n_removed_lines`, `n_removed_chunks`."""
    gone = repeated(docs, key, chunking).withColumnRenamed("_ld_key", "_ld_by")
    rows = _carried(docs, key).join(gone, F.col("_ld_id") == F.col("_ld_by"), "left")
    rows = chunked(rows, chunking)
    same = "exists(_ld_gone, g -> g.at = i and g.text = c.text)"  # the comparison of bytes
    kept = F.expr(f"if(_ld_gone is null, _ld_chunks, filter(_ld_chunks, (c, i) -> not {same}))")
    lines = lambda chunks: F.coalesce(F.expr(f"aggregate({chunks}, 0L, (n, c) -> n + c.n)"), F.lit(0).cast("long"))
    rows = rows.withColumn("_ld_kept", kept)
    rows = rows.withColumns(
        {
            "n_lines": lines("_ld_chunks"),
            "n_removed_lines": lines("_ld_chunks") - lines("_ld_kept"),
            "n_removed_chunks": F.coalesce(F.size("_ld_chunks") - F.size("_ld_kept"), F.lit(0)).cast("long"),
            "text": F.array_join(F.transform("_ld_kept", lambda c: c["text"]), "\n"),
        }
    )
    return _returned(rows, docs, "n_lines", "n_removed_lines", "n_removed_chunks")


def _carried(docs: DataFrame, key: str) -> DataFrame:
    """The text, the key and one struct of all columns, so that no name of the caller's meets one of these."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_ld_row"), F.col(f"`{key}`").alias("_ld_id"), "text")


def _returned(rows: DataFrame, docs: DataFrame, *results: str) -> DataFrame:
    """The caller's columns with the text as it is now, and the results."""
    own = (F.col("text") if c.lower() == "text" else F.col(f"_ld_row.`{c}`") for c in docs.columns if c.lower() not in results)
    return rows.select(*own, *results)


def _windows(docs: DataFrame, chunking: Chunking) -> DataFrame:
    """docs with `_ld_lines` and `_ld_windows`: the digests of all windows of `least` lines, in order."""
    rolled = f"unhex(md5(cast(array_join(slice(_ld_hashes, i, {chunking.least}), '') as binary)))"
    last = f"size(_ld_lines) - {chunking.least - 1}"
    rows = _computed(docs, _ld_lines=F.split("text", "\n", -1))
    rows = _computed(rows, _ld_hashes=F.expr("transform(_ld_lines, l -> md5(cast(l as binary)))"))
    windows = F.expr(f"if({last} >= 1, transform(sequence(1, greatest({last}, 1)), i -> {rolled}), array())")
    return _computed(rows, _ld_windows=windows).drop("_ld_hashes")


def repeated_windows(docs: DataFrame, key: str = "doc_id", chunking: Chunking = Chunking()) -> DataFrame:
    """One row per document that has windows to remove: `_ld_by` and `_ld_gone`, their first lines (from 1) and the
    originals' text."""
    rows = docs.select(F.col(f"`{key}`").alias("_ld_key"), "text")
    places = _windows(rows, chunking).select("_ld_key", F.posexplode("_ld_windows").alias("_ld_at", "_ld_digest"))
    place = F.struct("_ld_key", "_ld_at")
    firsts = places.groupBy("_ld_digest").agg(
        F.min(place).alias("_ld_first"), F.max(place).alias("_ld_last")
    ).where(F.col("_ld_first") != F.col("_ld_last"))
    copies = places.join(firsts, "_ld_digest").where(place != F.col("_ld_first")).select("_ld_digest", "_ld_key", "_ld_at")
    wanted = firsts.groupBy(F.col("_ld_first._ld_key").alias("_ld_of")).agg(F.collect_set("_ld_first._ld_at").alias("_ld_these"))
    sources = _windows(rows.join(wanted, F.col("_ld_key").eqNullSafe(F.col("_ld_of"))), chunking)
    text = f"array_join(slice(_ld_lines, at + 1, {chunking.least}), '\n')"
    found = f"transform(filter(_ld_these, at -> at < size(_ld_windows)), at -> named_struct('d', _ld_windows[at], 'text', {text}))"
    originals = sources.select(F.explode(F.expr(found)).alias("_ld_o")).groupBy(F.col("_ld_o.d").alias("_ld_digest"))
    gone = copies.join(originals.agg(F.first("_ld_o.text").alias("_ld_text")), "_ld_digest")
    return gone.groupBy(F.col("_ld_key").alias("_ld_by")).agg(
        F.collect_set(F.struct((F.col("_ld_at") + 1).alias("at"), F.col("_ld_text").alias("text"))).alias("_ld_gone")
    )


def without_passages(docs: DataFrame, key: str = "doc_id", chunking: Chunking = Chunking()) -> DataFrame:
    """docs with the remaining text, and `n_lines` and `n_removed_lines`."""
    gone = repeated_windows(docs, key, chunking)
    rows = _carried(docs, key).join(gone, F.col("_ld_id").eqNullSafe(F.col("_ld_by")), "left")
    rows = _computed(rows, _ld_lines=F.split("text", "\n", -1))
    width = chunking.least
    same = f"array_join(slice(_ld_lines, g.at, {width}), '\n') = g.text"  # the comparison of bytes
    hit = f"flatten(transform(filter(_ld_gone, g -> {same}), g -> sequence(g.at, g.at + {width - 1})))"
    left = f"transform(array_except(sequence(1, size(_ld_lines)), {hit}), i -> _ld_lines[i - 1])"
    rows = _computed(rows, _ld_kept=F.expr(f"if(_ld_gone is null or text is null, _ld_lines, {left})"))
    size = lambda lines: F.coalesce(F.when(F.col(lines).isNotNull(), F.size(lines)), F.lit(0)).cast("long")
    rows = rows.withColumns(
        {
            "n_lines": size("_ld_lines"),
            "n_removed_lines": size("_ld_lines") - size("_ld_kept"),
            "text": F.array_join("_ld_kept", "\n"),
        }
    )
    return _returned(rows, docs, "n_lines", "n_removed_lines")
