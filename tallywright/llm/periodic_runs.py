"""Periodic runs of words: recursive frequency splitting, then a scan by lags of what survives.

A run is a stretch of consecutive words with smallest period q, of at least `least` words and `repeats` periods, that no
neighbouring word extends. Each of its words occurs at least `repeats` times in it (or as often as fits). So a word that
occurs less often within a segment is in no run of that segment, and splits it; the parts are judged anew, by their own
counts, until no word splits them. Parts shorter than `least` are gone. No run is lost or cut: a run extended over a
splitting word would hold it often enough.

What survives is scanned by lags up to a `repeats`-th of its length. A run of period q covers two blocks of q words in a row
that start at multiples of q, so only the blocks' rolling hashes are compared at a lag (a logarithm of the length in all);
where two agree, the words themselves are compared in both directions, which gives the exact ends. Blocks inside a run found
at a lag that divides the present one belong to that run, whose period is the smaller, and are not looked at again.

Documents are independent: one pass over the texts without a shuffle. Memory is bounded by `ROWS_AT_ONCE` texts of a batch.

Defined results: null, empty and blank texts have no words, no runs and an empty text. Repeated rows are judged alike.
Words are runs of `[^\\x20\\x09-\\x0D]`, compared byte by byte. Columns of the input are kept, whatever their names: they
come back in one struct `row`. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import blank_separated

ROWS_AT_ONCE = 256
#: Fixed values of the rolling hash, modulo 2^64: odd, so that the inverse exists.
BASE = 0x9E3779B97F4A7C15
RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


@dataclass(frozen=True)
class Runs:
    """least: words of the shortest run. repeats: periods of the shortest run, at least 3 (the lag scan needs two blocks
    at multiples of the period within a run)."""

    least: int = 24
    repeats: int = 3

    def __post_init__(self):
        if self.least < 1 or self.repeats < 3:
            raise ValueError("a run has at least one word and three periods")


def numbers_of(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(word, len(known)) for word in words], np.int64)


def surviving(ids: np.ndarray, plan: Runs) -> list[tuple[int, int]]:
    """Segments of at least `least` words without a word that is too rare in its segment."""
    # a run of L words and period q holds each of its words L // q >= repeats times
    done, places, segment, kept = [], np.arange(len(ids)), np.zeros(len(ids), np.int64), len(ids) + 1
    while len(places):
        key = segment * kept + ids[places]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        frequent = counts[inverse] >= plan.repeats
        split = np.zeros(segment[-1] + 1, bool)
        split[segment[~frequent]] = True
        stable = ~split[segment]
        done += _bounds(places[stable], plan.least)
        places = places[frequent & ~stable]
        if not len(places):
            break
        # segments anew: a gap in the places or another old segment begins one; short ones are dropped
        starts = np.flatnonzero(np.concatenate(([True], np.diff(places) > 1)))
        lengths = np.diff(np.append(starts, len(places)))
        segment = np.repeat(np.arange(len(starts)), lengths)
        long = lengths[segment] >= plan.least
        places, segment = places[long], segment[long]
        if len(segment):
            segment = np.unique(segment, return_inverse=True)[1]
    return sorted(done)


def _bounds(places: np.ndarray, least: int) -> list[tuple[int, int]]:
    if not len(places):
        return []
    starts = np.flatnonzero(np.concatenate(([True], np.diff(places) > 1)))
    ends = np.append(starts[1:], len(places))
    return [(int(places[a]), int(places[b - 1]) + 1) for a, b in zip(starts, ends) if b - a >= least]


class Scan:
    """Runs of one segment by lags."""

    def __init__(self, ids: np.ndarray, plan: Runs):
        self.ids, self.plan, n = ids, plan, len(ids)
        powers = np.empty(n + 1, np.uint64)
        powers[0] = 1
        with np.errstate(over="ignore"):
            powers[1:] = np.cumprod(np.full(n, BASE, np.uint64))
            mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * powers[:n])))
        self.powers = powers

    def candidates(self, lag: int) -> np.ndarray:
        """Places that are multiples of the lag where the block of `lag` words has the hash of the next block."""
        at = np.arange(0, len(self.ids) - 2 * lag + 1, lag)
        with np.errstate(over="ignore"):
            first = (self.sums[at + lag] - self.sums[at]) * self.powers[lag]
            return at[first == self.sums[at + 2 * lag] - self.sums[at + lag]]

    def _reach(self, at: int, lag: int, step: int) -> int:
        """How many places from `at` on in one direction hold the word that stands `lag` later."""
        ids, last, width, count = self.ids, len(self.ids) - lag, 64, 0
        while True:
            begin, end = (at, min(at + width, last)) if step > 0 else (max(at - width + 1, 0), at + 1)
            if begin >= end:
                return count
            same = ids[begin:end] == ids[begin + lag : end + lag]
            same = same if step > 0 else same[::-1]
            wrong = int(np.argmin(same))
            if not same[wrong]:
                return count + wrong
            count, at, width = count + len(same), at + step * len(same), width * 2

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period), by period."""
        n, plan, found, wide = len(self.ids), self.plan, [], []
        for lag in range(1, n // plan.repeats + 1):
            places = self.candidates(lag)
            if not len(places):
                continue
            # two blocks within a run whose period divides the lag belong to that run; runs too short for them go for good
            wide = [run for run in wide if run[1] - run[0] >= 2 * lag]
            for begin, end, period in wide:
                if lag % period == 0:
                    places = places[(places < begin) | (places > end - 2 * lag)]
            end = -1
            for at in places.tolist():
                if at < end - lag:
                    continue  # inside the stretch just found
                forward = self._reach(at, lag, 1)
                if forward < lag:
                    continue  # equal hashes of different blocks
                begin, end = at - self._reach(at - 1, lag, -1), at + forward + lag
                if end - begin >= max(plan.least, plan.repeats * lag):
                    found.append((begin, end - begin, lag))
                    wide.append((begin, end, lag))
        return found


def runs_of(ids: np.ndarray, plan: Runs) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), by start, then period."""
    found = []
    for begin, end in surviving(ids, plan):
        found += [(begin + start, length, period) for start, length, period in Scan(ids[begin:end], plan).runs()]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without what any run holds after its first period."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()
    return b" ".join([words[k] for k in kept])


def judged(text: str | None, plan: Runs) -> tuple[int, list[tuple[int, int, int]], bytes]:
    words = blank_separated(text)
    runs = runs_of(numbers_of(words), plan) if len(words) >= plan.least else []
    return len(words), runs, collapsed(words, runs)


def found(text: Column, plan: Runs = Runs()) -> Column:
    """Of a text column: a struct of n_words, runs and the collapsed text."""
    kind = T.StructType.fromDDL(RESULT)
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    arrow = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for at in range(0, len(texts), ROWS_AT_ONCE):
                rows = []
                for item in texts.slice(at, ROWS_AT_ONCE):
                    n, runs, left = judged(item.as_py(), plan)
                    runs = [{"start": s, "length": k, "period": q} for s, k, q in runs]
                    rows.append({"n_words": n, "runs": runs, "collapsed": left.decode("utf-8", "surrogatepass")})
                yield pa.array(rows, arrow)

    judge.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(judge, kind)(text)


def with_runs(docs: DataFrame, text: str = "text", plan: Runs = Runs()) -> DataFrame:
    """`row` (the input's columns), n_words, runs (by start, then period), collapsed, and `strongest`: the run with the
    greatest length / period (ties: smallest start, then period; null without runs)."""
    rows = docs.select(F.struct("*").alias("row"), found(F.col(text), plan).alias("found"))
    stronger = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    first = F.try_element_at(F.col("found.runs"), F.lit(1))
    strongest = F.aggregate("found.runs", first, lambda best, run: F.when(stronger(run, best), run).otherwise(best))
    return rows.select("row", "found.*", strongest.alias("strongest"))
