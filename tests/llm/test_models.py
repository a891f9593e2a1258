"""The trained operators beside plain versions: pair by pair, and a dictionary of coordinates."""

import dataclasses
import math
import random

import numpy as np

from tallywright.llm import factorisation_machine as fm
from tallywright.llm import toxicity


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    for _ in range(30):
        size, factors = 200, 6
        model = fm.Model(float(rng.normal()), rng.normal(size=size), rng.normal(size=(size, factors)))
        at = rng.choice(size, rng.integers(0, 25), replace=False)
        x = rng.normal(size=len(at))
        wanted = model.w0 + sum(float(model.w[i]) * v for i, v in zip(at, x))
        for a in range(len(at)):
            for b in range(a):
                wanted += float(model.v[at[a]] @ model.v[at[b]]) * x[a] * x[b]
        assert math.isclose(model.raw(at, x)[0], wanted, rel_tol=1e-9, abs_tol=1e-9)


def test_saved_model_scores_alike():
    rng = np.random.default_rng(2)
    machine = dataclasses.replace(fm.Machine(), epochs=2)
    rows = []
    for k in range(60):
        at, x = fm.vector(" ".join(rng.choice(["good", "bad", "word", "other"], 8)), ["m=1"], machine)
        rows.append((np.asarray(at), np.asarray(x, np.float64), k % 2))
    model = fm.learn(rows, machine)
    again = fm.Model.loaded(model.saved())
    for at, x, _ in rows:
        assert math.isclose(model.raw(at, x)[0], again.raw(at, x)[0], rel_tol=1e-4, abs_tol=1e-4)


def plain_ftrl(rows, ftrl):
    """FTRL-proximal, one coordinate at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= ftrl.l1:
            return 0.0
        return (math.copysign(ftrl.l1, z[i]) - z[i]) / ((ftrl.smoothing + math.sqrt(n[i])) / ftrl.rate + ftrl.l2)

    order = np.random.default_rng(ftrl.seed)
    for _ in range(ftrl.epochs):
        for k in order.permutation(len(rows)):
            at, y = rows[k]
            weights = {int(i): weight(int(i)) for i in at}
            gradient = 1 / (1 + math.exp(-min(max(sum(weights.values()), -35), 35))) - y
            for i, w in weights.items():
                square = n.get(i, 0.0) + gradient * gradient
                z[i] = z.get(i, 0.0) + gradient - (math.sqrt(square) - math.sqrt(n.get(i, 0.0))) / ftrl.rate * w
                n[i] = square
    return {i: w for i in z if (w := weight(i))}


def test_ftrl_is_the_plain_version():
    rng, ftrl = random.Random(3), dataclasses.replace(toxicity.Ftrl(), bits=10, l1=0.5)
    rows = []
    for _ in range(300):
        bad = rng.random() < 0.3
        words = [rng.choice("abcdefghij") for _ in range(12)] + (["vile", "foul"] if bad else ["kind"])
        rows.append((toxicity.features(" ".join(words), ftrl.bits), int(bad)))
    at, weights = toxicity.learn(rows, ftrl)
    wanted = plain_ftrl(rows, ftrl)
    assert set(at.tolist()) == set(wanted) and len(wanted) < 1 << ftrl.bits
    assert all(math.isclose(w, wanted[i], rel_tol=1e-4, abs_tol=1e-6) for i, w in zip(at.tolist(), weights.tolist()))
