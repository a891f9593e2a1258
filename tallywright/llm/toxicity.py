"""Toxicity by logistic regression, trained with FTRL-proximal, over hashed word n-grams and skip-grams.

A text's features are its words, its pairs of neighbouring words and its pairs of words with one word between them (A-Z
in lower case), hashed into `2**bits` buckets; a feature is there or not. FTRL-proximal keeps a gradient sum and a sum of
squared gradients per bucket: each coordinate has a rate of its own, and the L1 penalty holds the weight of a bucket at 0
until enough evidence has come. What is left is a short list of buckets and weights, which is broadcast.

Defined results: null and empty texts, and texts without words, get the bias alone. Without labelled rows every score
is 0.5. Repeated rows score alike; other columns stay, one named `score` is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .training import fitted, labelled_sample, sigmoid
from .words import lower_words

BUCKETS = T.ArrayType(T.IntegerType())


@dataclass(frozen=True)
class Ftrl:
    """bits: 2**bits buckets. rate and smoothing: of the per-coordinate rates. l1, l2: penalties. sample: labelled rows to
    train on at most."""

    bits: int = 20
    rate: float = 1.0
    smoothing: float = 1.0
    l1: float = 3.0
    l2: float = 0.05
    epochs: int = 3
    sample: int = 18_000
    seed: int = 11


def features(text: str | None, bits: int) -> np.ndarray:
    """Distinct buckets in rising order; bucket 0 is the bias."""
    words = lower_words(text)
    number: dict[bytes, int] = {}
    h = np.array([number[w] if w in number else number.setdefault(w, zlib.crc32(w)) for w in words], np.uint64)
    grams = [h * SPREAD]
    if len(h) > 1:
        grams.append((h[:-1] * PAIR_A) ^ (h[1:] * PAIR_B))
    if len(h) > 2:
        grams.append((h[:-2] * SKIP_A) ^ (h[2:] * SKIP_B))
    mixed = np.concatenate(grams)
    mixed ^= mixed >> np.uint64(29)
    mixed *= SPREAD
    found = np.unique((mixed >> np.uint64(64 - bits)).astype(np.int32))
    return np.concatenate((np.zeros(1, np.int32), found[found > 0]))


#: Odd multipliers of the hashes; any would do.
SPREAD, PAIR_A, PAIR_B, SKIP_A, SKIP_B = (
    np.uint64(k)
    for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
)


def learn(rows: Sequence[tuple[np.ndarray, int]], ftrl: Ftrl) -> tuple[np.ndarray, np.ndarray]:
    """Buckets with a weight other than 0, and the weights."""
    z, n = np.zeros(1 << ftrl.bits), np.zeros(1 << ftrl.bits)
    rng = np.random.default_rng(ftrl.seed)
    for _ in range(ftrl.epochs):
        for k in rng.permutation(len(rows)):
            at, y = rows[k]
            weights = _weights(z[at], n[at], ftrl)
            gradient = sigmoid(float(weights.sum())) - y
            square = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(square) - np.sqrt(n[at])) / ftrl.rate * weights
            n[at] = square
    weights = _weights(z, n, ftrl)
    at = np.flatnonzero(weights)
    return at.astype(np.int32), weights[at].astype(np.float32)


def _weights(z: np.ndarray, n: np.ndarray, ftrl: Ftrl) -> np.ndarray:
    free = np.abs(z) > ftrl.l1
    return np.where(free, (np.sign(z) * ftrl.l1 - z) / ((ftrl.smoothing + np.sqrt(n)) / ftrl.rate + ftrl.l2), 0.0)


def scored(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", ftrl: Ftrl = Ftrl(), key: str = "doc_id"
) -> DataFrame:
    """docs with `score`, the probability of label 1."""

    def buckets(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, ftrl.bits) for t in texts], dtype=object)

    buckets.__annotations__ = {"texts": pd.Series, "return": pd.Series}

    def fit(examples: pd.DataFrame) -> bytes:
        at, weights = learn([(np.asarray(a), y) for a, y in zip(examples["at"], examples["_y"])], ftrl)
        return at.tobytes() + weights.tobytes()

    sample = labelled_sample(docs.select(f"`{key}`", "text"), labels, label, ftrl.sample, key)
    model = fitted(sample.select(F.pandas_udf(buckets, BUCKETS)("text").alias("at"), "_y", "_order"), fit)
    if model is None:
        return docs.withColumn("score", F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        half = len(shared.value) // 2
        weights = np.zeros(1 << ftrl.bits, np.float32)
        weights[np.frombuffer(shared.value[:half], np.int32)] = np.frombuffer(shared.value[half:], np.float32)
        for texts in batches:
            yield pd.Series([sigmoid(float(weights[features(t, ftrl.bits)].sum())) for t in texts], dtype="float64")

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn("score", F.pandas_udf(score, T.DoubleType())("text"))
