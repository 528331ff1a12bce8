"""Statistics against plain-Python formulas on small frames."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnloom.functions import dist
from churnloom.functions.scalar import normal_quantile
from churnloom.operators import clean, describe, linear, ordered, stat_tests


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        x = rng.gauss(0, 1)
        g = "abc"[i % 3]
        rows.append((i, x, round(2 * x + rng.gauss(0, 1) * (1 + abs(x)), 1), g, "pq"[i % 2], rng.random() * 3))
    return spark.createDataFrame(rows, "k long, x double, y double, g string, h string, z double").cache()


def test_distributions_match_known_values():
    assert dist.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert dist.t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-9)
    assert dist.f_sf(3.4928284767356, 4, 10) == pytest.approx(0.04937, abs=1e-4)
    assert dist.beta_ppf(0.5, 2, 2) == pytest.approx(0.5, abs=1e-9)
    assert dist.gamma_p(3, 3) == pytest.approx(1 - math.exp(-3) * (1 + 3 + 4.5), abs=1e-12)


def tau_b(x, y):
    c = d = tx = ty = 0
    for (a, b), (e, f) in itertools.combinations(zip(x, y), 2):
        s = np.sign(a - e) * np.sign(b - f)
        c, d = c + (s > 0), d + (s < 0)
        tx, ty = tx + (a == e), ty + (b == f)
    n0 = len(x) * (len(x) - 1) / 2
    return (c - d) / math.sqrt((n0 - tx) * (n0 - ty))


@pytest.mark.parametrize("block,one_task", [(1000, 100_000), (7, 0), (7, 100_000)])
def test_kendall_blocks(frame, monkeypatch, block, one_task):
    monkeypatch.setattr(ordered, "ONE_TASK_ROWS", one_task)
    data = frame.select(F.round("x", 0).alias("x"), F.round("y", 0).alias("y"))
    rows = data.collect()
    expected = tau_b([r.x for r in rows], [r.y for r in rows])
    assert describe.kendall_pair(data, "x", "y", block).first().r == pytest.approx(expected, abs=1e-12)


def test_ols_hc3_against_numpy(frame):
    rows = frame.collect()
    x = np.column_stack([np.ones(240), [r.x for r in rows], [r.z for r in rows], [r.g == "b" for r in rows], [r.g == "c" for r in rows]]).astype(float)
    y = np.array([r.y for r in rows])
    inv = np.linalg.inv(x.T @ x)
    beta = inv @ x.T @ y
    e = y - x @ beta
    h = np.sum((x @ inv) * x, axis=1)
    cov = inv @ (x.T @ (x * ((e / (1 - h)) ** 2)[:, None])) @ inv
    result = linear.ols(frame, "y", ["x", "z", "g"], keep=["k"])
    got = {r.term: r for r in result.coefficients.collect()}
    for i, name in enumerate(["const", "x", "z", "g_b", "g_c"]):
        assert got[name].coef == pytest.approx(beta[i], abs=1e-4)
        assert got[name].std_error == pytest.approx(math.sqrt(cov[i, i]), abs=1e-4)
    cooks = e**2 * h / (5 * (e @ e / 235) * (1 - h) ** 2)
    seen = {r.k: r.cooks_distance for r in result.residuals.collect()}
    assert seen[17] == pytest.approx(cooks[[r.k for r in rows].index(17)], rel=1e-9)
    aux = np.linalg.lstsq(x, e**2, rcond=None)[0]
    r2 = 1 - np.sum((e**2 - x @ aux) ** 2) / np.sum((e**2 - np.mean(e**2)) ** 2)
    assert linear.breusch_pagan(result)[0] == pytest.approx(240 * r2, rel=1e-6)
    assert linear.white(result)[2] <= 14
    assert linear.dispersion_audit(result, group=None)["tests"].count() == 3


def test_vif_matches_regression_and_flags_copies(frame):
    got = {r.column_name: r.vif for r in linear.collinearity(frame, ["x", "y", "z"])["vif"].collect()}
    rows = frame.collect()
    a = np.column_stack([[r.x for r in rows], [r.y for r in rows], [r.z for r in rows]])
    inverse = np.linalg.inv(np.corrcoef(a.T))
    for i, c in enumerate("xyz"):
        assert got[c] == pytest.approx(inverse[i, i], abs=1e-4)
    twin = linear.collinearity(frame.withColumn("w", F.col("x") * 2 + F.col("z")), ["x", "z", "w", "y"])
    assert twin["vif"].first().vif == float("inf")
    assert len(twin["kept"]) == 3


def test_rank_tests_small_example(spark):
    rows = [("a", v) for v in (1.0, 2.0, 2.0, 3.0)] + [("b", v) for v in (2.0, 4.0, 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert stat_tests.mann_whitney(df, "v", "g").first().statistic == 2.0
    ranks = {"a": 1 + 3 + 3 + 5, "b": 3 + 6 + 7}
    h = 12 / 56 * (ranks["a"] ** 2 / 4 + ranks["b"] ** 2 / 3) - 24
    assert stat_tests.kruskal(df, "v", "g").first().statistic == pytest.approx(h / (1 - 24 / (343 - 7)), abs=1e-4)


def test_normality_votes(spark):
    rng = random.Random(1)
    rows = [(i, rng.gauss(5, 2), rng.expovariate(1)) for i in range(800)]
    df = spark.createDataFrame(rows, "k long, a double, b double")
    assert stat_tests.normality(df, "a").first().is_normal
    assert not stat_tests.normality(df, "b").first().is_normal
    x = np.array(sorted(r[1] for r in rows))
    z = (x - x.mean()) / x.std(ddof=1)
    cdf = np.array([dist.normal_cdf(v) for v in z])
    i = np.arange(1, 801)
    a2 = -800 - np.sum((2 * i - 1) * (np.log(cdf) + np.log(1 - cdf[::-1]))) / 800
    got = stat_tests.edf_statistics(df, "a").first()
    assert got.anderson_a2 == pytest.approx(a2, rel=1e-4)
    assert got.lilliefors_d == pytest.approx(max(np.max(i / 800 - cdf), np.max(cdf - (i - 1) / 800)), abs=1e-6)


def test_durbin_watson_follows_the_order(frame):
    values = [r.y for r in sorted(frame.collect(), key=lambda r: r.k)]
    expected = sum((b - a) ** 2 for a, b in zip(values, values[1:])) / sum(v * v for v in values)
    assert linear.durbin_watson(frame, "y", ["k"]).first().durbin_watson == pytest.approx(expected, abs=1e-4)


def test_power_lambda_is_the_likelihood_maximum(frame):
    values = np.array([r.z for r in frame.collect()]) + 0.1
    df = frame.select((F.col("z") + 0.1).alias("z"))
    lam = clean.power_lambda(df, "z", "box_cox")

    def score(k):
        t = np.log(values) if abs(k) < 1e-9 else (values**k - 1) / k
        return -len(values) / 2 * math.log(t.var()) + (k - 1) * np.log(values).sum()

    assert score(lam) >= max(score(k) for k in np.linspace(-2, 4, 601)) - 1e-3


def test_levene_and_welch(frame):
    groups = {}
    for r in frame.collect():
        groups.setdefault(r.g, []).append(r.y)
    z = {g: np.abs(np.array(v) - np.median(v)) for g, v in groups.items()}
    grand = np.concatenate(list(z.values())).mean()
    f = (sum(len(v) * (v.mean() - grand) ** 2 for v in z.values()) / 2) / (sum(((v - v.mean()) ** 2).sum() for v in z.values()) / 237)
    row = stat_tests.variance_homogeneity(frame, "y", "g").first()
    assert row.statistic == pytest.approx(f, abs=1e-4) and row.p_value == pytest.approx(dist.f_sf(f, 2, 237), abs=1e-4)
    assert stat_tests.compare_groups(frame, "y", "h").first().test in ("mann_whitney", "student_t", "welch_t")


def test_group_normality_votes_by_name(spark):
    rng = random.Random(2)
    rows = [("z", rng.gauss(0, 1)) for _ in range(400)] + [("a", rng.expovariate(1)) for _ in range(400)] + [("m", 1.0), ("m", 2.0)]
    got = {r.group: r for r in stat_tests.group_normality(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()}
    assert got["z"].is_normal and not got["a"].is_normal and not got["m"].is_normal
    assert got["a"].p_anderson == 0.0 and got["z"].p_lilliefors > 0.05


def test_codes_number_values_in_order(spark, monkeypatch):
    for limit in (0, 100):
        monkeypatch.setattr(ordered, "ONE_TASK_ROWS", limit)
        df = spark.createDataFrame([(v,) for v in ["b", "a", None, "c", "b"]], "v string")
        assert sorted((r.v or "", r.v_code) for r in clean.category_codes(df, "v").collect()) == [("", -1), ("a", 0), ("b", 1), ("b", 1), ("c", 2)]


def test_normality_uses_all_rows_whatever_the_partitions(spark):
    rng = random.Random(5)
    rows = [("a" if i % 3 else "b", rng.gauss(0, 1) if i % 3 else rng.expovariate(1)) for i in range(9000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = [sorted(map(tuple, stat_tests.group_normality(df.repartition(n), "v", "g").collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2]
    x = np.array(sorted(v for g, v in rows if g == "a"))
    scores = np.array([dist.normal_ppf((i - 0.375) / (len(x) + 0.25)) for i in range(1, len(x) + 1)])
    w = np.corrcoef(x, scores)[0, 1] ** 2
    assert stat_tests.shapiro_francia(df.where("g = 'a'"), "v")[0] == pytest.approx(w, rel=1e-7)
    assert {r[0]: r[1] for r in got[0]} == {"a": 6000, "b": 3000}


def test_normal_quantile_expression(spark):
    ps = [1e-9, 1e-4, 0.02, 0.0243, 0.3, 0.5, 0.77, 0.98, 1 - 1e-6]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(normal_quantile(F.col("p")).alias("z")).collect()
    for p, r in zip(ps, got):
        assert r.z == pytest.approx(dist.normal_ppf(p), rel=2e-8, abs=1e-9)


def test_many_groups_compare_without_a_list(spark):
    df = spark.range(60_000).select((F.col("id") % 15_000).cast("string").alias("g"), F.pmod(F.xxhash64("id"), F.lit(97)).cast("double").alias("v"))
    row = stat_tests.anova(df, "v", "g").first()
    assert row.groups == 15_000 and 0 <= row.p_value <= 1


def direct_power(x, k, method):
    if method == "box_cox":
        return np.log(x) if abs(k) < 1e-9 else (x**k - 1) / k
    up = np.log1p(np.abs(x)) if abs(k) < 1e-9 else ((np.abs(x) + 1) ** k - 1) / k
    down = np.log1p(np.abs(x)) if abs(k - 2) < 1e-9 else ((np.abs(x) + 1) ** (2 - k) - 1) / (2 - k)
    return np.where(x >= 0, up, -down)


def test_grid_moments_match_direct_powers():
    rng = np.random.default_rng(3)
    for x, method in ((rng.lognormal(2, 1, 500), "box_cox"), (rng.lognormal(2, 1, 500), "yeo_johnson"), (rng.normal(0, 4, 500), "yeo_johnson")):
        for low, high in ((-3.0, 5.0), (-0.4, 0.4), (1.96, 2.04)):
            grid = [low + (high - low) * i / 20 for i in range(21)]
            joined = clean._joined(clean._grid_moments(x[:123], grid, method), clean._grid_moments(x[123:], grid, method))
            want = [direct_power(x, k, method) for k in grid]
            assert joined[0].tolist() == [500.0] * 21
            assert np.allclose(joined[1], [t.mean() for t in want], rtol=1e-9)
            assert np.allclose(joined[2] / joined[0], [t.var() for t in want], rtol=1e-7)


def test_power_lambdas_of_several_columns_match_brute_force(spark):
    rng = np.random.default_rng(8)
    wide = {"a": rng.lognormal(1, 0.7, 400), "b": rng.normal(1, 3, 400), "c": rng.gamma(2.0, 3.0, 400)}
    rows = [tuple(None if i % 50 == j else float(wide[c][i]) for j, c in enumerate(wide)) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    got = clean.power_lambdas(df, list(wide))
    for j, c in enumerate(wide):
        x = np.array([r[j] for r in rows if r[j] is not None])
        low, high, best = -3.0, 5.0, 1.0
        for _ in range(4):
            grid = [low + (high - low) * i / 20 for i in range(21)]
            slope = (np.sign(x) * np.log1p(np.abs(x))).sum()
            best = max(grid, key=lambda k: -len(x) / 2 * np.log(direct_power(x, k, "yeo_johnson").var()) + (k - 1) * slope)
            step = (high - low) / 20
            low, high = best - step, best + step
        assert abs(got[c] - best) < 1e-9


def test_transforms_are_evaluated_once_per_row(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 60)], "x double")
    plan = clean.compare_power_transforms(df, "x")._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.upper().count("POWER(") <= 3
