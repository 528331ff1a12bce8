"""Customer value, events, thresholds and next best action on hand-made frames."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from churnloom.operators import activation, events, scoring, value
from churnloom.plans.pipelines import event_run


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        age = rng.randint(50, 900)
        f = rng.choice([0, 0, 1, 2, 3, 6, 9])
        rows.append((i, f, rng.randint(1, age) if f else 0, age, round(20 + rng.random() * 80, 2)))
    return spark.createDataFrame(rows, "customer_id long, frequency long, recency long, age long, monetary double").cache()


def test_shrinkage_by_hand(spark):
    df = spark.createDataFrame([(1, 3, 60, 90, 50.0), (2, 0, 0, 30, 10.0)], "id long, frequency long, recency long, age long, monetary double")
    rows = {r.id: r for r in value.clv_shrinkage(df, [6]).collect()}
    alive = 1 / (1 + math.exp(-(-1.35 + 2.85 * 60 / 90 + 0.55 * math.log1p(3))))
    tx = alive * 4 / 90 * 180 * 4 / 6.5
    assert rows[1].p_alive == round(alive, 4)
    assert rows[1].clv_6m == pytest.approx(tx * (3 * 50 + 3 * 50) / 6 / 1.01**6, abs=0.006)
    assert rows[2].expected_value == pytest.approx(50 * 0.85)


def hyp2f1(a, b, c, z):
    term = total = 1.0
    for i in range(2000):
        term *= (a + i) * (b + i) / ((c + i) * (i + 1)) * z
        total += term
    return total


def test_bgnbd_expectation_formula(history):
    k = {"r": 0.8, "alpha": 60.0, "a": 0.6, "b": 2.5}
    f, r, t = (F.col(c).cast("double") for c in ("frequency", "recency", "age"))
    rows = history.select("frequency", "recency", "age", value.bgnbd_expected(f, r, t, 90.0, k).alias("e"), value.bgnbd_alive(f, r, t, k).alias("p"))
    for x in rows.limit(40).collect():
        n, rec, age = x.frequency, x.recency, x.age
        h = hyp2f1(k["r"] + n, k["b"] + n, k["a"] + k["b"] + n - 1, 90 / (60 + age + 90))
        top = (k["a"] + k["b"] + n - 1) / (k["a"] - 1) * (1 - ((60 + age) / (60 + age + 90)) ** (k["r"] + n) * h)
        odds = k["a"] / (k["b"] + n - 1) * ((60 + age) / (60 + rec)) ** (k["r"] + n) if n else 0
        assert x.e == pytest.approx(top / (1 + odds), rel=1e-6)
        assert x.p == pytest.approx(1 / (1 + odds), rel=1e-9)


def test_bgnbd_fit_beats_its_neighbours(history):
    k = value.fit_bgnbd(history)
    rows = history.collect()
    scale = 10 / max(r.age for r in rows)

    def score(r, alpha, a, b):
        total = 0.0
        for x in rows:
            n, rec, age = x.frequency, x.recency * scale, x.age * scale
            base = math.lgamma(r + n) - math.lgamma(r) + r * math.log(alpha) + math.lgamma(a + b) + math.lgamma(b + n) - math.lgamma(b) - math.lgamma(a + b + n)
            mix = (alpha + age) ** -(r + n) + (a / (b + n - 1) * (alpha + rec) ** -(r + n) if n else 0)
            total += base + math.log(mix)
        return total / len(rows) - 0.01 * (r * r + alpha * alpha + a * a + b * b)

    best = (k["r"], k["alpha"] * scale, k["a"], k["b"])
    top = score(*best)
    for i in range(4):
        for factor in (0.9, 1.1):
            moved = list(best)
            moved[i] *= factor
            assert score(*moved) <= top + 1e-6
    out = value.clv_bgnbd(history)
    assert out.first().clv_engine == "bgnbd_gamma_gamma" and out.where("clv_12m is null or clv_12m < 0").isEmpty()
    assert value.clv_bgnbd(history.limit(20)).first().clv_engine == "shrinkage"


@pytest.fixture(scope="module")
def race(spark):
    rows = [
        ("e1", "a", 0.5, 0, 2), ("e1", "b", 0.3, 1, 1), ("e1", "c", 0.2, 0, 3),
        ("e2", "a", 0.4, 1, 1), ("e2", "b", 0.4, 0, 2),
        ("e3", "a", 1.0, 1, 1),
        ("e4", "a", 0.6, 0, 1), ("e4", "b", 0.4, 0, 2),
        ("e5", "a", 0.6, 1, 1), ("e5", "b", 0.4, 1, 2),
        ("e6", "a", 0.1, 0, 4), ("e6", "b", 0.2, 0, 3), ("e6", "c", 0.3, 0, 2), ("e6", "d", 0.1, 1, 1), ("e6", "f", 0.3, 0, 5),
    ]
    return spark.createDataFrame(rows, "e string, c string, p double, y int, pos int")


def test_event_metrics_edge_cases(race):
    got = {r.e: r for r in events.event_metrics(race, "e", "c", "y", "p").collect()}
    assert set(got) == {"e1", "e2", "e6"}
    assert (got["e1"].winner_rank, got["e1"].reciprocal_rank) == (2, 0.5)
    assert got["e1"].ndcg_at_k == round(1 / math.log2(3), 6)
    # A tie shares the discounts of both places.
    assert got["e2"].winner_rank == 1 and got["e2"].ndcg_at_k == round((1 + 1 / math.log2(3)) / 2, 6)
    assert got["e6"].winner_rank == 5 and got["e6"].topk_hit == 0.0 and got["e6"].ndcg_at_k == 0.0


def test_event_board_hits(race):
    got = {r.e: r for r in events.event_board(race, "e", "c", "p", "pos").collect()}
    assert got["e1"].predicted_podium == "a > b > c" and got["e1"].actual_podium == "b > a > c"
    assert (got["e1"].exacta_ordered_hit, got["e1"].exacta_box_hit, got["e1"].podium_box_hit) == (0.0, 1.0, 1.0)
    assert got["e3"].predicted_exacta is None and got["e3"].exacta_box_hit == 0.0 and got["e3"].winner_hit == 1.0


def test_softmax_sums_to_one_and_rejects_nulls(race):
    out = events.event_softmax(race, "e", "p", 0.5)
    assert all(abs(r.s - 1) < 1e-12 for r in out.groupBy("e").agg(F.sum("probability").alias("s")).collect())
    with pytest.raises(PySparkException):
        events.event_softmax(race.withColumn("p", F.when(F.col("c") != "a", F.col("p"))), "e", "p").collect()


def test_threshold_sweep_counts_each_row_once(spark):
    rows = [(0.1, 0, 10.0), (0.15, 1, 20.0), (0.5, 1, None), (0.9, 0, 40.0), (0.95, 1, 50.0)]
    df = spark.createDataFrame(rows, "p double, y int, v double")
    out = {r.threshold: r for r in activation.threshold_sweep(df, "y", "p", "v", 5.0, 0.5).collect()}
    assert out[0.15].contacted == 4 and out[0.15].detected == 3
    assert out[0.15].recovered_value == (20 + 30 + 50) * 0.5 and out[0.15].net_value == 30.0
    assert out[0.85].contacted == 2 and out[0.85].precision == 0.5
    assert activation.recommended_threshold(activation.threshold_sweep(df, "y", "p", "v", 5.0, 0.5), 0.4).first().threshold == 0.55


def test_next_best_action_takes_first_on_ties(spark):
    df = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.1, 0.9), (3, 0.0, 0.0)], "id long, a double, b double")
    out = activation.next_best_action(
        df, {"a": F.col("a"), "b": F.col("b")}, {"a": 10.0, "b": 10.0}, {"a": 1.0, "b": 1.0}, {"a": "A", "b": "B"}
    )
    assert {r.id: r.nba for r in out.collect()} == {1: "A", 2: "B", 3: "Monitorear"}


def test_auc_and_calibration_edges(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.9, 1)], "p double, y int")
    assert scoring.roc_auc(df, "y", "p").first().roc_auc == 0.875
    one = df.where("y = 1")
    assert scoring.roc_auc(one, "y", "p").first().roc_auc is None
    assert scoring.reliability_curve(df, "y", "p", 2).count() == 2


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double")
    row = scoring.regression_metrics(df, "y", "p").first()
    assert row.mae == 0.6667 and row.r2 == 0.75 and row.mean_error == 0.0


def test_bgnbd_series_near_one_converges(spark):
    k = {"r": 0.8, "alpha": 5.0, "a": 1.6, "b": 2.4}
    one = spark.createDataFrame([(0.0, 0.0, 0.5)], "f double, r double, t double")
    e = one.select(value.bgnbd_expected(F.col("f"), F.col("r"), F.col("t"), 720.0, k).alias("e")).first().e
    z = 720 / (5 + 0.5 + 720)
    term = total = 1.0
    for i in range(20_000):
        term *= (k["a"] + k["b"] - 1 - k["r"] + i) * (k["a"] - 1 + i) / ((k["a"] + k["b"] - 1 + i) * (i + 1)) * z
        total += term
    assert e == pytest.approx((k["a"] + k["b"] - 1) / (k["a"] - 1) * (1 - (1 - z) ** (k["a"] - 1) * total), rel=1e-9)


def test_event_run_with_competitors_that_return(spark):
    rng = random.Random(4)
    rows = []
    for e in range(60):
        strength = [rng.random() for _ in range(5)]
        order = sorted(range(5), key=lambda i: -strength[i])
        rows += [(f"e{e}", f"c{i}", int(order[0] == i), order.index(i) + 1, strength[i], rng.random()) for i in range(5)]
    df = spark.createDataFrame(rows, "event string, who string, won int, place int, a double, b double")
    out = event_run(df, "event", "who", "won", "place", ["a", "b"], ["b"])
    held = out["event_report"].count()
    assert 5 <= held <= 30 and out["board"].agg(F.count("*")).first()[0] == held
    assert {"normality", "transforms", "correlation", "winners"} <= set(out) and out["winners"].first().rejects


def test_event_run_evaluates_its_input_once(spark):
    rows = [(e, f"c{i}", float((e * 7 + i * 3) % 11), float((e + i) % 5), int(i == e % 4), 1 + (i - e) % 4) for e in range(60) for i in range(4)]
    read = spark.sparkContext.accumulator(0)

    def count(x):
        read.add(1)
        return x

    df = spark.createDataFrame(rows, "event long, who string, a double, b double, won int, place int")
    df = df.withColumn("a", F.udf(count, "double")("a"))
    out = event_run(df, "event", "who", "won", "place", ["a", "b"], ["b"])
    assert out["tickets"].first()["n_events"] > 0 and out["transforms"].count() > 0
    assert read.value == len(rows)
