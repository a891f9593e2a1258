"""Periodic runs against a brute-force version, the planted query, edge cases."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import periodic_runs
from tallywright.llm.periodic_runs import Runs
from tallywright.llm.queries import QUERIES


def brute(words, least=24, repeats=3):
    """Every maximal stretch of every period, kept if no smaller period fits it."""
    found, n = [], len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if j > i and end - start >= max(least, repeats * q):
                fits = lambda p: all(words[k] == words[k + p] for k in range(start, end - p))  # noqa: E731, B023
                if not any(map(fits, range(1, q))):
                    found.append((start, end - start, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(6))
def test_runs(seed):
    rng, plan, seen = random.Random(seed), Runs() if seed % 2 else Runs(5, 3), 0
    for _ in range(250):
        letters, words = rng.choice("ab abc abcdefgh".split()), []
        for _ in range(rng.randrange(9)):
            stretch = [rng.choice(letters) for _ in range(rng.randrange(1, 14))]
            words += (stretch * 9)[: rng.randrange(1, 9 * len(stretch))]
        wanted = brute(words, plan.least, plan.repeats)
        n, runs, left = periodic_runs.judged("\t ".join(words), plan)
        dropped = {k for s, length, q in wanted for k in range(s + q, s + length)}
        assert (n, runs) == (len(words), wanted)
        assert left.decode() == " ".join(w for k, w in enumerate(words) if k not in dropped)
        seen += len(wanted)
    assert seen > 100


def test_splitting_is_by_the_segment():
    # `b` and `c` are frequent in the whole text, but rare between the splitting words
    words = "z0 a b a b z1 c a c z2 b c b".split() * 1 + ["a"] * 30
    ids = periodic_runs.numbers_of([w.encode() for w in words])
    assert periodic_runs.surviving(ids, Runs()) == [(13, 43)]


@pytest.mark.parametrize("make", [lambda n: np.zeros(n, np.int64), lambda n: np.arange(n) % (n // 4), lambda n: np.arange(n) % 7 // 2])
def test_long_texts_take_near_linear_time(make):
    began = time.process_time()
    (run,) = periodic_runs.runs_of(make(200_000), Runs())
    assert run[:2] == (0, 200_000) and time.process_time() - began < 30


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    return words


def test_query(spark, sf_dir):
    sha = lambda data: hashlib.sha256(data).hexdigest()
    rows = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    planted = 0
    for doc in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        words, row = expected(doc.doc_id, doc.text), rows.pop(doc.doc_id)
        runs = brute(words) if len(words) < 1500 else periodic_runs.runs_of(periodic_runs.numbers_of(words), Runs())
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == sha("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode())
        dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
        assert row.collapsed_sha256 == sha(b" ".join(w for k, w in enumerate(words) if k not in dropped))
        if runs:
            s, k, q = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, k, q, 1000 * k // q)
            planted += 1
        else:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
    assert not rows and planted > 5


def test_edges(spark):
    texts = [None, "", " \n\x0b", "a", "a " * 24, "a " * 23, "é b\n" * 12, "x\x1cy " * 8, "a b c " * 40_000]
    rows = [(k, text, "1", "2", "3") for k, text in enumerate(texts)] + [(4, "a " * 24, "1", "2", "3"), (None, "q " * 30, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, found string, row string")
    out = periodic_runs.with_runs(docs).select("row.doc_id", "row.runs", F.col("runs").alias("found_runs"), "n_words", "collapsed").collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    tell = lambda k: [tuple(r) for r in by[k].found_runs]
    assert [tell(k) for k in range(4)] == [[]] * 4 and by[0].collapsed == "" and by[2].n_words == 0
    assert tell(4) == [(0, 24, 1)] and by[4].collapsed == "a" and tell(5) == []
    assert tell(6) == [(0, 24, 2)] and by[6].collapsed == "é b" and tell(7) == []
    assert tell(8) == [(0, 120_000, 3)] and by[8].runs == "1" and tell(None) == [(0, 30, 1)]
    assert periodic_runs.with_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        Runs(repeats=2)
