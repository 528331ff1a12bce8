"""Quality and cleaning operators: nulls, ties, constants, empty and odd input."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnloom.functions.scalar import rnd, standard_name
from churnloom.operators import clean, describe, impute, models, neighbors, quality
from churnloom.plans import catalog_describe


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "a", 1.0, None, 5), (2, "a", 2.0, None, 5), (3, None, 2.0, None, 5), (4, "b", None, None, 5), (5, "A ", 100.0, None, 5)]
    return spark.createDataFrame(rows, "k long, t string, v double, empty double, same int")


def test_names():
    assert [standard_name(n) for n in ("Ingreso Mensual", " Región/Zona ", "año", "x__y")] == ["ingreso_mensual", "region_zona", "ano", "x_y"]


def test_rounding_is_half_to_even(spark):
    row = spark.range(1).select(rnd(F.lit(0.125), 2).alias("a"), rnd(F.lit(0.375), 2).alias("b")).first()
    assert (row.a, row.b) == (0.12, 0.38)


def test_profile_of_empty_and_constant_columns(odd):
    rows = {r.column_name: r for r in quality.quality_report(odd, "k").collect()}
    assert rows["empty"].nulls == 5 and rows["empty"].distinct_values == 0 and rows["empty"].sample == ""
    assert rows["t"].sample == "a, a, b" and rows["t"].pct_duplicate_values == 20.0
    assert {r.column_name for r in quality.constant_columns(odd).collect()} == {"empty", "same"}
    text = quality.text_standards(odd, ["t"]).first()
    assert (text.levels_original, text.levels_normalized) == (3, 2)


def test_empty_table_raises(spark):
    from churnloom.functions.scalar import require_rows

    with pytest.raises(ValueError):
        require_rows(spark.createDataFrame([], "a int"))


def test_psi_by_hand(spark):
    old = spark.createDataFrame([(float(i), "x" if i % 2 else "y") for i in range(100)], "v double, c string")
    new = spark.createDataFrame([(float(i), "x") for i in range(50, 150)], "v double, c string")
    rows = {r.column_name: r for r in quality.population_stability(old, new, ["v", "c"]).collect()}
    assert rows["c"].psi == pytest.approx(0.5 * math.log(2) + (-0.5) * math.log(1e-6 / 0.5), abs=1e-3)
    # The lower half of the deciles is empty in the new data; values above the old range are left out.
    assert rows["v"].psi == pytest.approx(sum((0.2 - 0.1) * math.log(2) for _ in range(5)) + 5 * (-0.1) * math.log(1e-6 / 0.1), rel=0.02)
    same = spark.createDataFrame([(3.0,)] * 30, "v double")
    assert quality.population_stability(same, same, ["v"]).first().psi == 0.0


def test_little_mcar_accepts_random_gaps(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    rows = [(float(a), None if rng.random() < 0.2 else float(b), float(c)) for a, b, c in x]
    assert quality.little_mcar(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).first().is_mcar_compatible
    rows = [(float(a), None if a > 0.5 else float(b), float(c)) for a, b, c in x]
    assert not quality.little_mcar(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).first().is_mcar_compatible


def test_outliers_keep_nulls_and_report(odd):
    out, report = clean.handle_outliers(odd, ["v"], "clip_iqr")
    assert out.where("v is null").count() == 1
    gone, _ = clean.handle_outliers(odd, ["v"], "remove_iqr")
    assert [r.k for r in gone.orderBy("k").collect()] == [1, 2, 3, 4]
    assert report.first().pct_outliers == 20.0


def test_fractional_difference_needs_full_history(spark):
    weights = clean.fractional_weights(0.4, 1e-4, 5)
    values = [float(i * i % 7) for i in range(30)]
    df = spark.createDataFrame([(i, None if i == 12 else v) for i, v in enumerate(values)], "k long, v double")
    got = {r.k: r.v_fracdiff for r in clean.fractional_difference(df, ["v"], ["k"], max_window=5, block_rows=8).collect()}
    for i in range(30):
        if i < 4 or i - 4 <= 12 <= i:
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(sum(w * values[i - j] for j, w in enumerate(weights)))


def test_shapes_and_kurtosis(spark):
    values = [1.0, 2.0, 2.0, 3.0, 9.0]
    row = describe.numeric_summary(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).first()
    x = np.array(values)
    n, d = 5, x - x.mean()
    g1 = (d**3).mean() / (d**2).mean() ** 1.5
    assert row.skewness == pytest.approx(g1 * math.sqrt(n * (n - 1)) / (n - 2), abs=1e-3)
    assert row.iqr == 1.0


@pytest.mark.parametrize("block", [5, 20_000])
def test_nearest_is_exact(spark, block):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(300, 2))
    points[:100] = [0.5, 0.5]
    values = rng.normal(size=300)
    asked = rng.normal(size=(60, 2))
    asked[0] = [0.5, 0.5]
    donors = spark.createDataFrame([(*map(float, p), float(v)) for p, v in zip(points, values)], "a double, b double, v double")
    queries = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(asked)], "k long, a double, b double")
    near = neighbors.nearest(queries, "k", donors, "v", ["a", "b"], 7, block=block, pivots=9)
    got = {r.k: r for r in near.select("k", neighbors.mean_of_neighbors(F.col("neighbors"), 7).alias("m"), "neighbors").collect()}
    assert len(got) == 60
    hot = values[:100].mean()
    for i, q in enumerate(asked):
        d = np.sqrt(((points - q) ** 2).sum(axis=1))
        cells = sorted([(d[0], hot, 100)] + [(d[j], values[j], 1) for j in range(100, 300)])
        left, total = 7, 0.0
        for _, v, n in cells:
            take = min(n, left)
            total += take * v
            left -= take
        assert got[i].m == pytest.approx(total / 7, abs=1e-9)


def test_knn_and_mice_fill_everything(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(200):
        a = float(rng.normal())
        rows.append((i, a, None if i % 10 == 0 else 3 * a + 1, None if i % 15 == 1 else a - 2))
    df = spark.createDataFrame(rows, "k long, a double, b double, c double")
    knn = impute.knn_impute(df, "k", ["a", "b", "c"], 3)
    assert knn.count() == 200 and knn.where("b is null or c is null").isEmpty()
    mice, rounds = impute.mice_impute(df, ["a", "b", "c"])
    assert mice.count() == 200 and rounds >= 1
    worst = mice.agg(F.max(F.abs(F.col("b") - 3 * F.col("a") - 1))).first()[0]
    assert worst < 1e-6


def test_mice_query_keeps_all_orders(spark, sf):
    out = catalog_describe.mice_impute(spark, sf)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    both = lines.join(out, "o_orderkey", "full").collect()
    assert all(r["lines"] == r["rows"] and r["mean_price"] is not None and r["mean_quantity"] is not None for r in both)
    assert any(r["o_orderkey"] % 30 == 1 for r in both)


def test_dummies_and_bins(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), (None, 3.0)], "c string, v double")
    out, names = clean.dummies(df, ["c"])
    assert names == ["c_b"] and [r.c_b for r in out.orderBy("v").collect()] == [1.0, 0.0, 0.0]
    binned, edges = clean.equal_frequency_bins(df, "v", 2)
    assert edges == [1.0, 2.0, 3.0] and [r.bin for r in binned.orderBy("v").collect()] == [0, 0, 1]


def test_knn_impute_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, *[None if rng.random() < 0.3 else round(rng.gauss(0, 1), 2) for _ in range(3)]) for i in range(80)]
    rows.append((80, None, None, None))
    df = spark.createDataFrame(rows, "k long, a double, b double, c double")
    got = {r.k: tuple(r)[1:] for r in impute.knn_impute(df, "k", ["a", "b", "c"], 4).collect()}
    for k, *x in rows:
        for j in range(3):
            if x[j] is not None:
                assert got[k][j] == x[j]
                continue
            near = []
            for other, *y in rows:
                both = [t for t in range(3) if x[t] is not None and y[t] is not None]
                if y[j] is not None and both:
                    near.append((sum((x[t] - y[t]) ** 2 for t in both) * 3 / len(both), str(other), y[j]))
            have = [y[j] for _, *y in rows if y[j] is not None]
            best = [v for _, _, v in sorted((round(d, 9), o, v) for d, o, v in near)[:4]] if near else have
            assert got[k][j] == pytest.approx(sum(best) / len(best), abs=1e-6)


def test_imputers_learn_on_train_rows_only(spark):
    train = spark.createDataFrame([(i, float(i), 2.0 * i) for i in range(30)], "k long, a double, b double")
    test = spark.createDataFrame([(100, 5.0, None), (101, 5.0, 9999.0)], "k long, a double, b double")
    for imputer in ("knn", "iterative"):
        filled = models.fill_learned(train, test, "k", ["a", "b"], imputer)[1]
        assert filled.where("k = 100").first().b == pytest.approx(10, abs=0.5)


def test_risk_flags_cover_every_dimension(spark):
    blocked = {r.dimension: r for r in quality.risk_flags(spark, {"decision": "blocked"}).collect()}
    assert len(blocked) == 12 and blocked["calibration"].state == blocked["health"].state == "Bloqueado"
    assert blocked["temporal_validation"].state == blocked["uncertainty"].state == "Seguimiento" and blocked["fairness"].state == "OK"
    fine = {
        "decision": "healthy", "is_mcar_compatible": True, "is_normal": True, "features_dropped": 1, "severe_drift_columns": 0, "folds": 3,
        "std_roc_auc": 0.05, "brier_score": 0.1, "mean_interval_width": 0.2, "top_vif": 4.9, "top_condition_index": 29.0, "critical_components": 0,
        "paradox": False, "tabular_alerts": 0, "fairness_max_gap": 0.1, "sampling_alerts": 0,
    }
    assert {r.state for r in quality.risk_flags(spark, fine).collect()} == {"OK"}
    for fact, value, dimension in (
        ("paradox", True, "coefficients"), ("top_condition_index", 30.0, "coefficients"), ("folds", 0, "temporal_validation"),
        ("tabular_alerts", 1, "tabular_contract"), ("fairness_max_gap", 0.11, "fairness"),
    ):
        rows = {r.dimension: r.state for r in quality.risk_flags(spark, {**fine, fact: value}).collect()}
        assert rows[dimension] == "Seguimiento" and list(rows.values()).count("OK") == 11


def test_tabular_alerts_and_continuous_balance(spark):
    df = spark.createDataFrame([(1, "1,5", "NA", 1.5), (1, "2,5", "n/a", 2.5)] + [(i, f"{i},5", "x", float(i)) for i in range(2, 20)], "`Bad Name` long, t string, u string, y double")
    one = quality.tabular_alerts(quality.audit(df, "Bad Name", None, ["Bad Name"])).first()
    assert one.nonstandard_headers == 1 and one.ids_with_duplicates == 1 and one.numeric_like_columns == 1 and one.inconsistent_null_tokens == 1
    assert quality.target_balance(df, "y").first().column_name == "y"


def test_little_mcar_patterns_on_the_executors(spark):
    rows = [(float(i), float(i * i % 17) if i % 4 else None, float(i % 5) if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    one = quality.little_mcar(df, ["a", "b", "c"]).first()
    a = np.array([[np.nan if v is None else v for v in r] for r in rows])
    mean = np.nanmean(a, axis=0)
    cov = np.array([[np.cov(a[~np.isnan(a[:, i]) & ~np.isnan(a[:, j])][:, [i, j]].T)[0, 1] if i != j else np.nanvar(a[:, i], ddof=1) for j in range(3)] for i in range(3)])
    stat, dof = 0.0, 0
    for flags in {tuple(np.isnan(r)) for r in a}:
        part = a[[tuple(np.isnan(r)) == flags for r in a]]
        seen = [i for i in range(3) if not flags[i]]
        d = part[:, seen].mean(axis=0) - mean[seen]
        stat, dof = stat + len(part) * d @ np.linalg.pinv(cov[np.ix_(seen, seen)]) @ d, dof + len(seen)
    assert one.statistic == pytest.approx(stat, abs=1e-3) and one.dof == dof - 3


def test_knn_impute_in_rounds_with_many_ties_and_repeated_keys(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(i % 190, *[None if rng.random() < 0.2 else float(rng.randrange(4)) for _ in range(3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double").repartition(4)
    want = sorted(map(str, impute.knn_impute(df, "k", ["a", "b", "c"], 4).collect()))
    monkeypatch.setattr(impute, "ROUND_ROWS", 30)
    monkeypatch.setattr(impute, "GAP_ROWS", 7)
    monkeypatch.setattr(impute, "DONOR_ROWS", 11)
    got = impute.knn_impute(df, "k", ["a", "b", "c"], 4)
    assert sorted(map(str, got.collect())) == want
    # Donors are never gathered into lists, so a task holds a batch of them.
    assert "collect_list" not in got._jdf.queryExecution().toString()


def test_nearest_in_rounds_returns_k_entries_per_query(spark, monkeypatch):
    rng = np.random.default_rng(5)
    points, asked = np.round(rng.normal(size=(400, 3)), 1), np.round(rng.normal(size=(70, 3)), 1)
    points = np.unique(points, axis=0)
    values = np.round(rng.random(len(points)), 1)
    donors = spark.createDataFrame([(*map(float, p), float(v)) for p, v in zip(points, values)], "a double, b double, c double, v double")
    queries = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(asked)] + [(99, None, 1.0, 1.0)], "k long, a double, b double, c double")
    monkeypatch.setattr(neighbors, "ROUND_BYTES", 4_000)
    near = neighbors.nearest(queries, "k", donors, "v", ["a", "b", "c"], 6, block=16, pivots=20)
    got = {r.k: [(e.distance, e.value) for e in r.neighbors] for r in near.collect()}
    assert sorted(got) == list(range(70))
    for i, q in enumerate(asked):
        d = np.sqrt(((points - q) ** 2).sum(axis=1))
        order = np.lexsort((values, d))[:6]
        assert got[i] == [(d[j], values[j]) for j in order]
    # Tasks keep the k nearest of their queries instead of sending k per query and cell.
    assert "CoGroups" not in near._jdf.queryExecution().toString()
