"""Repeated passages of lines beside brute force: every one goes whole, wherever it lies."""

import random

import pytest

import corpus_pipeline
from tallywright.llm import line_dedup


def brute(docs):
    """key -> text without the windows of two lines that occur earlier."""
    seen, out = {}, {}
    for key, text in sorted(docs):
        lines = text.split("\n")
        windows = list(zip(lines, lines[1:]))
        gone = {j for i, w in enumerate(windows) if seen.setdefault(w, (key, i)) != (key, i) for j in (i, i + 1)}
        out[key] = "\n".join(line for j, line in enumerate(lines) if j not in gone)
    return out


def planted(seed):
    rng = random.Random(seed)
    fresh = lambda n: [" ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(10**6)) for _ in range(9)) for _ in range(n)]
    docs, passages, key = [], {}, 0
    for size in range(2, 9):
        for _ in range(12):
            passage = fresh(size)
            for _ in range(2):
                docs.append((key, "\n".join(fresh(rng.randrange(1, 6)) + passage + fresh(rng.randrange(1, 6)))))
                key += 1
            passages[key - 1] = passage
    return docs, passages


def line_stage(spark, docs):
    rows = [(k, t, "en", "s", len(t)) for k, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    found = {r.doc_id: r for r in corpus_pipeline.line_stage(spark, frame, "").collect()}
    assert all(r.n_chars == len(r.text) for r in found.values())
    return {k: r.text for k, r in found.items()}


def test_recall_of_planted_passages(spark):
    docs, passages = planted(3)
    left = line_stage(spark, docs)
    assert sum(any(line in left[k] for line in p) for k, p in passages.items()) == 0  # recall 1 at each size from 2 to 8
    assert left == brute(docs)


@pytest.mark.parametrize("seed", [1, 2])
def test_few_different_lines(spark, seed):
    rng = random.Random(seed)
    docs = [(k, "\n".join(rng.choice(["a", "b", "", "long line", "é"]) for _ in range(rng.randrange(1, 9)))) for k in range(40)]
    assert line_stage(spark, docs) == brute(docs)


def test_rows_without_key_and_shared_keys(spark):
    docs = [(None, "p\nq\nr"), (1, "p\nq\nx"), (2, "s\nt"), (2, "s\nt"), (3, None), (4, ""), (5, "y\nq\nr")]
    rows = line_dedup.without_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = sorted(((r.doc_id or 0, r.text or "", r.n_lines, r.n_removed_lines) for r in rows))
    assert found == [(0, "p\nq\nr", 3, 0), (1, "x", 3, 2), (2, "s\nt", 2, 0), (2, "s\nt", 2, 0), (3, "", 0, 0), (4, "", 1, 0), (5, "y", 3, 2)]
    assert {r.doc_id: r.text for r in rows}[3] is None
