"""Stacked Newton fits against single fits, and what is built on them."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from churnloom.operators import models, newton
from churnloom.operators.scoring import probability_losses, roc_auc, score_metrics_by
from churnloom.session import materialize


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    out = []
    for i in range(700):
        a, b, n = rng.normal(50, 3), rng.normal(), rng.normal()
        c = "uvw"[int(rng.integers(3))] if i % 41 else None
        y = int(rng.random() < 1 / (1 + np.exp(-(0.6 * (a - 50) - b + (0.8 if c == "u" else 0)))))
        out.append((i, float(a), float(b) if i % 17 else None, float(n), c, y))
    return materialize(spark.createDataFrame(out, "k long, a double, b double, n double, c string, label int"))


def single(df, columns, l2, weight=None):
    estimator = LogisticRegression(regParam=l2, maxIter=500, tol=1e-14, **({"weightCol": weight} if weight else {}))
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), estimator]).fit(df).stages[-1]


def test_replicates_prefixes_and_penalties_equal_single_fits(rows):
    seeds = range(6)
    weights = F.array(*[models.poisson_weight("k", s) for s in seeds])
    d = newton.design(rows, ["a", "b", "n"], [], ["k"], _w=weights)
    fills = d.fills(d.rows)
    asked = [newton.Candidate(l2=0.01, fills=fills), newton.Candidate(columns=(0, 2), fills=fills), *[newton.Candidate(s, l2=1e-6, fills=fills) for s in seeds]]
    fits = newton.fit_stack(d.rows, d.width, asked, weights="_w")
    assert max(f.passes for f in fits) <= 10 and all(f.ok for f in fits)
    full = rows.fillna({"b": fills[1]})
    for f, m in [(fits[0], single(full, ["a", "b", "n"], 0.01)), *[(fits[2 + s], single(full.withColumn("w", models.poisson_weight("k", s)), ["a", "b", "n"], 1e-6, "w")) for s in seeds]]:
        assert np.allclose(f.coefficients, m.coefficients.toArray(), atol=1e-6) and abs(f.intercept - m.intercept) < 1e-4
    two = single(full, ["a", "n"], 0.0)
    assert np.allclose(fits[1].coefficients[[0, 2]], two.coefficients.toArray(), atol=1e-6) and fits[1].coefficients[1] == 0
    scored = newton.score_stack(d.rows, ["k", "label"], fits)
    p = scored.select(F.avg(F.log(F.when(F.col("label") == 1, F.col("scores")[1]).otherwise(1 - F.col("scores")[1])))).first()[0]
    assert p * 700 == pytest.approx(fits[1].log_likelihood, abs=1e-6)


def test_levels_collinear_and_constant_columns(rows):
    d = newton.design(rows.withColumn("one", F.lit(1.0)), ["a", "one"], ["c"], ["k"])
    (f,) = newton.fit_stack(d.rows, d.width, [newton.Candidate(fills=d.fills(d.rows))])
    assert f.ok and f.coefficients[d.slots["one"][0]] == 0 and len(d.slots["c"]) == 3
    mode = rows.groupBy("c").count().where("c is not null").orderBy(F.desc("count"), "c").first().c
    known = rows.fillna({"c": mode})
    for v in "vw":
        known = known.withColumn(v, (F.col("c") == v).cast("double"))
    m = single(known, ["a", "v", "w"], 0.0)
    got = f.coefficients[list(d.slots["c"])]
    assert np.allclose(got[1:] - got[0], m.coefficients.toArray()[1:], atol=1e-5)


def test_start_one_class_and_separation(spark, rows):
    d = newton.design(rows, ["a", "b", "n"], [], ["k"])
    fills = d.fills(d.rows)
    whole = newton.fit_stack(d.rows, d.width, [newton.Candidate(l2=1e-6)])
    again = newton.fit_stack(d.rows, d.width, [newton.Candidate(columns=(0, 1), l2=1e-6)], start=whole)
    fresh = newton.fit_stack(d.rows, d.width, [newton.Candidate(columns=(0, 1), l2=1e-6)])
    assert np.allclose(again[0].coefficients, fresh[0].coefficients, atol=1e-7) and again[0].passes < fresh[0].passes
    (f,) = newton.fit_stack(d.rows.withColumn("label", F.lit(1.0)), d.width, [newton.Candidate(fills=fills)])
    assert not f.ok
    apart = newton.design(spark.createDataFrame([(i, float(i), int(i > 20)) for i in range(40)], "k int, a double, label int"), ["a"], [])
    (f,) = newton.fit_stack(apart.rows, 1, [newton.Candidate(l2=1e-6)])
    assert f.ok and f.coefficients[0] > 1


def test_group_metrics_equal_single_ones(rows):
    scored = rows.select(F.col("label").alias("y"), F.round(1 / (1 + F.exp(-F.col("n"))), 2).alias("p"), (F.col("k") % 3).alias("g"))
    for r in score_metrics_by(scored, ["g"], "y", "p").collect():
        part = scored.where(F.col("g") == r.g)
        assert r.roc_auc == roc_auc(part, "y", "p").first().roc_auc
        assert (r.log_loss, r.brier_score) == tuple(probability_losses(part, "y", "p").first())


def test_fold_models_equal_separate_training(rows):
    found = models.cross_validated_auc(rows, "k", "label", ["a", "b", "c"], folds=3).collect()
    fold = F.floor(models.hash_unit("k", 42) * 3).cast("int")
    for r in found:
        t = models.train_classifier(rows, "k", "label", ["a", "b", "c"], calibrate=None, split=(rows.where(fold != r.fold), rows.where(fold == r.fold)))
        one = t.metrics.first()
        assert abs(r.roc_auc - one.roc_auc) < 2e-3 and abs(r.log_loss - one.log_loss) < 2e-3
    chosen = models.select_by_cv_then_bic(rows, "k", "label", ["a", "b", "n", "c"], (2, 3))
    assert chosen.where("is_selected").count() == 1


def test_purged_folds_name_the_last_training_day(rows):
    dated = rows.withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), (F.floor(F.col("k") / 20) * 5).cast("int")))
    folds, _ = models.purged_validation(dated, "k", "label", ["a", "b"], "d", blocks=4)
    for r in folds.collect():
        days = dated.where(F.col("d") < F.date_sub(F.lit(r.test_start), 7))
        assert r.train_end == days.agg(F.max("d")).first()[0] and r.n_train == days.count()
    parts = models.quantile_validation(dated, "k", "label", ["a", "c"], "d")
    assert parts.count() == 4 and parts.where("roc_auc < 0.5").isEmpty()
