"""The two fits against plain loops over numbers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidelane.llm import quality_classifier as quality
from tidelane.llm import toxicity


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def plain_ordinal(examples, s):
    """Weights by index and thresholds of the cumulative-link model; gradients by differences of the likelihood."""
    k = s.grades - 1
    reached = [min(max(sum(g >= j for *_, g in examples) / len(examples), 1e-3), 1 - 1e-3) for j in range(1, k + 1)]
    theta = [-math.log(r / (1 - r)) for r in reached]
    for j in range(1, k):
        theta[j] = max(theta[j], theta[j - 1] + s.gap)
    w, seen, seen_t = {}, {}, [1e-8] * k

    def loss(score, thresholds, g):
        r = [1.0, *(sigmoid(score - t) for t in thresholds), 0.0]
        return -math.log(r[g] - r[g + 1])

    def slope(f):
        h = 1e-5
        return (f(h) - f(-h)) / (2 * h)

    for _ in range(s.epochs):
        for first in range(0, len(examples), s.batch):
            part = examples[first : first + s.batch]
            step, step_t = {}, [0.0] * k
            for index, share, g in part:
                score = sum(w.get(i, 0.0) * x * s.scale for i, x in zip(index, share))
                d = slope(lambda h: loss(score + h, theta, g))
                for i, x in zip(index, share):
                    step[i] = step.get(i, 0.0) + d * x * s.scale / len(part)
                for j in range(k):
                    step_t[j] += slope(lambda h: loss(score, [t + h * (m == j) for m, t in enumerate(theta)], g)) / len(part)
            for i, d in step.items():
                d += s.l2 * w.get(i, 0.0)
                seen[i] = seen.get(i, 1e-8) + d * d
                w[i] = w.get(i, 0.0) - s.rate * d / math.sqrt(seen[i])
            for j in range(k):
                seen_t[j] += step_t[j] ** 2
                theta[j] -= 0.1 * s.rate * step_t[j] / math.sqrt(seen_t[j])
            for j in range(1, k):
                theta[j] = max(theta[j], theta[j - 1] + s.gap)
    return w, theta


@pytest.mark.parametrize("grades", [2, 3, 4])
def test_ordinal_weights_as_a_plain_loop_finds_them(grades):
    rng = random.Random(grades)
    settings = quality.Settings(bits=6, grades=grades, epochs=3, batch=16, scale=5.0)
    examples = []
    for _ in range(200):
        index = sorted(rng.sample(range(64), 5))
        grade = min(grades - 1, sum(i < 20 for i in index) // 2)
        examples.append((np.array(index), np.array([0.1, 0.3, 0.2, 0.2, 0.2]), float(grade)))
    model = quality.fit_rows(examples, settings)
    w, theta = plain_ordinal([(i.tolist(), x.tolist(), int(g)) for i, x, g in examples], settings)
    assert np.allclose(model.weights, [w.get(i, 0.0) for i in range(64)], atol=2e-3)
    assert np.allclose(model.thresholds, theta, atol=2e-3)
    assert (np.diff(model.thresholds) > 0).all()


def test_thresholds_stay_apart():
    assert np.allclose(quality.apart(np.array([1.0, 0.5, 0.5, 3.0]), 0.1), [1.0, 1.1, 1.2, 3.0])
    rows = [(np.array([1]), np.array([1.0]), g) for g in (0.0, 2.0) * 40]  # no row of the middle grade
    assert (np.diff(quality.fit_rows(rows, quality.Settings(bits=4)).thresholds) > 0).all()


def plain_ftrl(examples, s):
    z, n = {}, {}
    positive = sum(y for _, y in examples)
    bias, bias_n = math.log((positive + 1) / (len(examples) - positive + 9)), 0.0
    l1 = min(s.l1, max(s.least_l1, s.l1 * math.sqrt(len(examples) / 12_000)))

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= l1:
            return 0.0
        return (math.copysign(l1, zi) - zi) / ((s.beta + math.sqrt(n.get(i, 0.0))) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for index, y in examples:
            now = {i: weight(i) for i in index}
            x = {i: s.pair if i >= 1 << (s.bits - 1) else 1.0 for i in index}
            error = sigmoid(bias + sum(now[i] * x[i] for i in index)) - y
            for i in index:
                g = error * x[i]
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / s.alpha * now[i]
            bias_n += error * error
            bias -= s.alpha * error / (s.beta + math.sqrt(bias_n))
    return {i: weight(i) for i in z if weight(i)}, bias


def test_ftrl_weights_as_a_plain_loop_finds_them():
    rng = random.Random(3)
    settings = toxicity.Settings(bits=6, l1=0.5, least_l1=0.5)
    examples = []
    for _ in range(200):
        index = sorted(rng.sample(range(64), 6))
        examples.append((index, float(any(i in (3, 17, 40) for i in index))))
    model = toxicity.fit_rows([(np.array(i), y) for i, y in examples], settings)
    weights, bias = plain_ftrl(examples, settings)
    assert set(model.index.tolist()) == set(weights) and len(weights) < 64
    assert np.allclose(model.weight, [weights[i] for i in model.index.tolist()]) and math.isclose(model.intercept, bias)
