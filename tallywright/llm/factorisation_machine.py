"""Text quality from a factorisation machine over hashed words, structure statistics and metadata.

    score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

The pairs are never formed: per factor their sum is half of (sum_i v_i x_i)^2 - sum_i v_i^2 x_i^2, linear in the words of
a text. Words (A-Z in lower case) are hashed into `2**bits` buckets and weighted by their frequency, scaled to length 1.
The structure statistics have buckets of their own and are cut into steps, so that the machine can tell too little from
too much. Metadata columns named by the caller are hashed as name and value. Training is AdaGrad over the sample of
`training.labelled_sample`; the model has a fixed size and is broadcast.

Defined results: null and empty texts, and texts without words, have statistics only and get a score from those. Without
labelled rows every score is 0.5. Null metadata is a value of its own. Repeated rows score alike; other columns stay, one
named `score` is replaced.
"""

from __future__ import annotations

import io
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality_rules import SYMBOLS, repeated_words
from .training import fitted, labelled_sample, sigmoid
from .words import encoded, lower_words

VECTOR = T.StructType([T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.FloatType()))])


@dataclass(frozen=True)
class Machine:
    """bits: 2**bits word buckets. factors: rank of the interactions. sample: labelled rows to train on at most."""

    bits: int = 16
    factors: int = 6
    sample: int = 8_000
    epochs: int = 4
    rate: float = 0.1
    decay: float = 1e-5
    seed: int = 7


#: Steps that each statistic is cut into.
STEPS = 12


def statistics(text: str | None) -> list[float]:
    """Shares between 0 and 1 and scaled logarithms."""
    data = encoded(text)
    words, n = data.split(), max(1, len(data))
    lines = [line for line in data.split(b"\n") if line.strip()]
    count = max(1, len(words))
    letters = sum(map(data.count, UPPER))
    return [
        np.log1p(len(words)) / 10,
        sum(map(len, words)) / count / 15,
        sum(data.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS))) / n,
        letters / n,
        sum(map(data.count, DIGITS)) / n,
        sum(map(data.count, MARKS)) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        repeated_words(words) / count,
        len(set(words)) / count,
        np.log1p(n / max(1, len(lines))) / 10,
    ]


UPPER = [bytes([b]) for b in range(0x41, 0x5B)]
DIGITS = [bytes([b]) for b in range(0x30, 0x3A)]
MARKS = [bytes([b]) for b in b"!?.,;:"]
STATISTICS = 10


def vector(text: str | None, meta: Sequence[str], machine: Machine) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: statistics first, then words, then metadata."""
    words = Counter(lower_words(text))
    first = STATISTICS * STEPS
    steps = [k * STEPS + min(STEPS - 1, int(max(0.0, s) ** 0.5 * STEPS)) for k, s in enumerate(statistics(text))]
    mask = (1 << machine.bits) - 1
    at = steps + [first + (zlib.crc32(w) & mask) for w in words] + [first + (zlib.crc32(m.encode()) & mask) for m in meta]
    x = np.ones(len(at), np.float32)
    counts = np.fromiter(words.values(), np.float32, len(words))
    x[: len(steps)] = 1 / STATISTICS**0.5
    x[len(steps) : len(steps) + len(words)] = counts / max(1e-9, float(np.sqrt(counts @ counts)))
    x[len(steps) + len(words) :] = 0.2
    return np.array(at, np.int32), x


class Model:
    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def raw(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        vx = self.v[at] * x[:, None]
        total = vx.sum(0)
        return self.w0 + float(self.w[at] @ x) + 0.5 * float(total @ total - (vx * vx).sum()), vx, total

    def saved(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, w0=self.w0, w=self.w.astype(np.float32), v=self.v.astype(np.float32))
        return out.getvalue()

    @staticmethod
    def loaded(data: bytes) -> Model:
        got = np.load(io.BytesIO(data))
        return Model(float(got["w0"]), got["w"], got["v"])


def learn(rows: Sequence[tuple[np.ndarray, np.ndarray, int]], machine: Machine) -> Model:
    size = STATISTICS * STEPS + (1 << machine.bits)
    rng = np.random.default_rng(machine.seed)
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.02, (size, machine.factors)))
    g0, gw, gv = 1e-6, np.full(size, 1e-6), np.full((size, machine.factors), 1e-6)
    for _ in range(machine.epochs):
        for k in rng.permutation(len(rows)):
            at, x, y = rows[k]
            score, vx, total = model.raw(at, x)
            error = sigmoid(score) - y
            g0 += error * error
            model.w0 -= machine.rate * error / g0**0.5
            # a bucket that two words share is stepped once, by the later one
            step = error * x + machine.decay * model.w[at]
            gw[at] += step * step
            model.w[at] -= machine.rate * step / np.sqrt(gw[at])
            step = error * (x[:, None] * (total - vx)) + machine.decay * model.v[at]
            gv[at] += step * step
            model.v[at] -= machine.rate * step / np.sqrt(gv[at])
    return model


def scored(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    metadata: Sequence[str] = (),
    machine: Machine = Machine(),
    key: str = "doc_id",
) -> DataFrame:
    """docs with `score`, the probability of label 1."""
    texts = [F.col("text"), F.array(*(F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0"))) for c in metadata)).cast("array<string>")]

    def vectors(text: pd.Series, meta: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([vector(t, m, machine) for t, m in zip(text, meta)], columns=["at", "x"])

    vectors.__annotations__ = {"text": pd.Series, "meta": pd.Series, "return": pd.DataFrame}

    def fit(examples: pd.DataFrame) -> bytes:
        rows = [(np.asarray(v["at"]), np.asarray(v["x"], np.float64), y) for v, y in zip(examples["v"], examples["_y"])]
        return learn(rows, machine).saved()

    inputs = docs.select(f"`{key}`", texts[0].alias("_text"), texts[1].alias("_meta"))
    sample = labelled_sample(inputs, labels, label, machine.sample, key)
    model = fitted(sample.select(F.pandas_udf(vectors, VECTOR)("_text", "_meta").alias("v"), "_y", "_order"), fit)
    if model is None:
        return docs.withColumn("score", F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        machine_model = Model.loaded(shared.value)
        for text, meta in batches:
            yield pd.Series([sigmoid(machine_model.raw(*vector(t, m, machine))[0]) for t, m in zip(text, meta)], dtype="float64")

    score.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return docs.withColumn("score", F.pandas_udf(score, T.DoubleType())(*texts))
