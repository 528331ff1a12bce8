"""Analytic derivatives of the purchase models, and the target rule."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnloom.functions.scalar import prepared_targets
from churnloom.operators import value
from churnloom.session import materialize


@pytest.fixture(scope="module")
def counts(spark):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(120):
        f = int(rng.integers(0, 6))
        t = float(rng.uniform(1, 9))
        rows.append((f, float(rng.uniform(0, t)) if f else 0.0, t, float(rng.gamma(2, 0.5) + 0.01), int(rng.integers(1, 4))))
    return materialize(spark.createDataFrame(rows, "f int, r double, t double, m double, n long"))


def bgnbd(row, p):
    f, r, t = row["f"], row["r"], row["t"]
    rr, alpha, a, b = p
    base = math.lgamma(f + rr) - math.lgamma(rr) + rr * math.log(alpha) + math.lgamma(a + b) + math.lgamma(b + f) - math.lgamma(b) - math.lgamma(a + b + f)
    alive = math.exp(-(f + rr) * math.log(t + alpha))
    died = a / (b + f - 1) * math.exp(-(f + rr) * math.log(r + alpha)) if f else 0.0
    return base + math.log(alive + died)


def gamma_gamma(row, p):
    f, m = row["f"], row["m"]
    shape, q, v = p
    pf = f * shape
    return math.lgamma(pf + q) - math.lgamma(pf) - math.lgamma(q) + q * math.log(v) + pf * math.log(f * m) - math.log(m) - (pf + q) * math.log(f * m + v)


@pytest.mark.parametrize("name", ["bgnbd", "gamma_gamma"])
def test_derivatives_equal_finite_differences(counts, name):
    if name == "bgnbd":
        used, model, plain, p = counts, value.bgnbd_likelihood(), bgnbd, np.array([0.8, 2.5, 0.7, 1.9])
    else:
        used, model, plain, p = counts.where("f > 0"), value.gamma_gamma_likelihood(), gamma_gamma, np.array([1.7, 3.2, 2.1])
    rows = used.collect()
    total = sum(r["n"] for r in rows)

    def mean(at):
        return sum(r["n"] * plain(r, at) for r in rows) / total

    got, slope, curve = value.likelihood_sums(used, model, p)
    assert got == pytest.approx(mean(p), abs=1e-8)
    h = 1e-4
    unit = np.eye(len(p)) * h
    for i, u in enumerate(unit):
        assert slope[i] == pytest.approx((mean(p + u) - mean(p - u)) / (2 * h), abs=1e-6)
        for j, w in enumerate(unit):
            cross = (mean(p + u + w) - mean(p + u - w) - mean(p - u + w) + mean(p - u - w)) / (4 * h * h)
            assert curve[i, j] == pytest.approx(cross, abs=2e-5)


def test_score_equations_hold_at_the_fit(counts):
    scale = 10.0 / counts.agg(F.max("t")).first()[0]
    model = value.bgnbd_likelihood(scale)
    params, best = value._maximise(counts, [1.0, 3.0, 0.5, 2.0], model, 0.01, 40, 1e-8)
    p = np.array(params)
    at, slope, _ = value.likelihood_sums(counts, model, p)
    assert np.abs(p * (slope - 0.02 * p)).max() < 1e-6 and best == pytest.approx(at - 0.01 * p @ p, abs=1e-9)


def test_targets_are_words_unless_all_are_numbers(spark):
    rows = [(" SÍ ", "yes", "1", "2.9", "t", 2.7, True), ("2.5", "N", "0", "-3.2", "yes", -1.2, False), ("maybe", "si", "1", "4", "no", 0.0, True)]
    df = spark.createDataFrame(rows, "mixed string, words string, digits string, numbers string, letters string, real double, flag boolean")
    got = prepared_targets(df, df.columns)
    assert got.columns == df.columns
    assert list(zip(*map(tuple, got.collect()))) == [(1, None, None), (1, 0, 1), (1, 0, 1), (2, -3, 4), (None, 1, 0), (2, -1, 0), (1, 0, 1)]
    gap = spark.createDataFrame([("5",), (None,), ("1",)], "x string")
    assert [r.x for r in prepared_targets(gap, ["x"]).collect()] == [None, None, 1]
    assert prepared_targets(gap.limit(0), ["x"]).collect() == []
