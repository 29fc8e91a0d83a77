"""Fitted models against plain rebuilds: FTRL, ridge and isotonic steps, robust distances."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality, rules
from tidemark.llm.ftrl import Ftrl, Rates
from tidemark.llm.quality import FourierRidge, pool
from tidemark.llm.rules import FLOORS, NAMES, robust_distances


def plain_ftrl(examples, outputs, rates):
    """One coordinate and output at a time, in dicts."""
    z, n = {}, {}

    def weight(key):
        v = z.get(key, 0.0)
        if abs(v) <= rates.l1:
            return 0.0
        rate = (rates.beta + math.sqrt(n.get(key, 0.0))) / rates.alpha
        return -(v - math.copysign(rates.l1, v)) / (rate + rates.l2)

    for x, target in examples:
        w = {(i, k): weight((i, k)) for i in x for k in range(outputs)}
        s = [sum(v * w[i, k] for i, v in x.items()) for k in range(outputs)]
        if outputs == 1:
            p = [1 / (1 + math.exp(-s[0]))]
        else:
            e = [math.exp(v - max(s)) for v in s]
            p = [v / sum(e) for v in e]
        for i, v in x.items():
            for k in range(outputs):
                g = v * (p[k] - target[k])
                grown = n.get((i, k), 0.0) + g * g
                sigma = (math.sqrt(grown) - math.sqrt(n.get((i, k), 0.0))) / rates.alpha
                z[i, k] = z.get((i, k), 0.0) + g - sigma * w[i, k]
                n[i, k] = grown
    return weight


def test_ftrl_equals_scalar_updates():
    rng = np.random.default_rng(1)
    for outputs, rates in ((1, Rates(2.0, 1.0, 0.3, 0.1)), (3, Rates(1.0, 1.0, 0.02, 0.05))):
        model, examples = Ftrl(20, outputs, rates), []
        for _ in range(300):
            at = rng.choice(20, rng.integers(1, 8), replace=False)
            values = rng.normal(size=len(at))
            target = [float(values.sum() > 0)] if outputs == 1 else np.eye(3)[int(abs(values.sum()) * 2) % 3].tolist()
            examples.append((dict(zip(at.tolist(), values.tolist())), target))
            model.learn(at, values, np.array(target))
        weight = plain_ftrl(examples, outputs, rates)
        want = [[weight((i, k)) for k in range(outputs)] for i in range(20)]
        assert np.allclose(model.weights(), want) and np.abs(want).max() > 0.1


def test_ridge_weights_equal_one_solution_over_all_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(quality.STATISTICS)))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float)
    df = spark.createDataFrame([(a.tolist(), b) for a, b in zip(x, y.tolist())], "x array<double>, label double")
    model = FourierRidge(x.mean(axis=0), x.std(axis=0), 40, 3.0)
    z = np.hstack([
        np.sqrt(2 / 40) * np.cos(np.clip((x - x.mean(axis=0)) / x.std(axis=0), -6, 6) @ model.w + model.b),
        np.ones((400, 1)),
    ])
    penalty = np.diag([0.7] * 40 + [1e-9])
    want = np.linalg.solve(z.T @ z + penalty, z.T @ y)
    for parts in (1, 23):
        assert np.allclose(quality._solve(df.repartition(parts), model, 0.7), want, atol=1e-8)


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, len(quality.STATISTICS)))
    z = FourierRidge(np.zeros(x.shape[1]), np.ones(x.shape[1]), 20_000, 3.0).features(x)[:, :-1]
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * 9))).max() < 0.05


def test_isotonic_steps_equal_the_minimax_formula():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n = rng.integers(1, 6, 12).astype(float)
        good = np.floor(rng.random(12) * (n + 1))
        want = [
            max(min(good[i : k + 1].sum() / n[i : k + 1].sum() for k in range(j, 12)) for i in range(j + 1))
            for j in range(12)
        ]
        x, y = pool(np.arange(12.0), good, n)
        # Values of the blocks, in order; the formula repeats each over its block.
        assert np.allclose(y, sorted(set(np.round(want, 12))), atol=1e-9)


def quantile(values, share):
    return np.sort(values)[max(0, math.ceil(share * len(values)) - 1)]


def moments(x):
    return len(x), x.mean(axis=0), np.cov(x.T, bias=True)


def squared(x, mean, cov):
    """Mahalanobis distances with the granted spread."""
    off = x - mean
    granted = cov + np.diag([f**2 for f in FLOORS.values()])
    return (off * np.linalg.solve(granted, off.T).T).sum(axis=1)


def plain_estimate(x, share=0.75, steps=3):
    middle = np.array([quantile(x[:, i], 0.5) for i in range(5)])
    spread = np.array([quantile(np.abs(x[:, i] - middle[i]), 0.5) for i in range(5)])
    d = (((x - middle) / np.maximum(1.4826 * spread, list(FLOORS.values()))) ** 2).sum(axis=1)
    for _ in range(steps):
        estimate = moments(x[d <= quantile(d, share)])
        d = squared(x, *estimate[1:])
    return estimate


def test_robust_distances_equal_a_plain_version(spark):
    rng = np.random.default_rng(5)
    group = np.array(["sa"] * 90 + ["sb"] * 25 + ["sc"] * 60 + ["sd"] * 2)
    language = np.where(np.isin(group, ["sa", "sb"]), "l1", "l2")
    x = rng.normal(size=(len(group), 5)) @ rng.normal(size=(5, 5)) + 3 * (group == "sb")[:, None]
    x[::17] += 25
    rows = [(i, g, l, "a", *map(float, v)) for i, (g, l, v) in enumerate(zip(group.tolist(), language.tolist(), x))]
    df = spark.createDataFrame(rows, "id int, g string, l string, a string, " + ", ".join(f"{n} double" for n in NAMES))
    groups = df.select("g", "l", "a").distinct()
    got = {r.id: r.distance for r in robust_distances(rules._with_estimates(df), groups, lean=40.0).collect()}

    def drawn(near, far, n):
        return (n * near + 40 * far) / (n + 40)

    every = plain_estimate(x)
    by_language = {l: plain_estimate(x[language == l]) for l in ("l1", "l2")}
    d = np.zeros(len(x))
    for g in "sa", "sb", "sc", "sd":
        own, wide = plain_estimate(x[group == g]), by_language[language[group == g][0]]
        mean, cov = (drawn(own[i], drawn(wide[i], every[i], wide[0]), own[0]) for i in (1, 2))
        d[group == g] = squared(x[group == g], mean, cov)
    raw = d.copy()
    for g in "sa", "sb", "sc", "sd":
        here, wide = group == g, language == language[group == g][0]
        half = drawn(
            quantile(raw[here], 0.5), drawn(quantile(raw[wide], 0.5), quantile(raw, 0.5), wide.sum()), here.sum()
        )
        d[here] /= max(half / rules.CHI2_HALF, 0.25)
    for g in "sa", "sb", "sc", "sd":
        here = np.flatnonzero(group == g)
        assert np.allclose([got[i] for i in here], d[here], rtol=1e-6), g
    assert set(np.flatnonzero(d > 80)) >= set(range(0, len(x), 17)) - set(np.flatnonzero(group == "sd"))
