"""Models by invariants, sources, and registered queries against SQL."""

import datetime
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracles import TABLES, canonical
from churnloom import session
from churnloom.operators import activation, describe, models, segments
from churnloom.plans import catalog_cases
from churnloom.plans.base import customers
from churnloom.session import materialize
from churnloom.sources import io
from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(600):
        a, b, n = rng.normal(), rng.normal(), rng.normal()
        c = "u" if rng.random() < 0.5 else "w"
        y = int(rng.random() < 1 / (1 + np.exp(-(1.8 * a - b + (0.8 if c == "u" else 0)))))
        rows.append((i, float(a), float(b) if i % 17 else None, float(n), c, y, 3 * float(a) + float(n)))
    return materialize(spark.createDataFrame(rows, "k long, a double, b double, n double, c string, y int, v double"))


def test_split_is_stable_and_disjoint(labelled):
    train, test = models.split_by_key(labelled, "k")
    a, b = {r.k for r in train.collect()}, {r.k for r in test.collect()}
    assert not a & b and len(a | b) == 600 and 100 < len(b) < 200
    assert {r.k for r in models.split_by_key(labelled.repartition(3), "k")[1].collect()} == b


def test_logistic_learns_and_explains(labelled):
    t = models.train_classifier(labelled, "k", "y", ["a", "b", "n", "c"])
    assert t.metrics.first().roc_auc > 0.75
    assert t.predictions.where("probability < 0 or probability > 1").isEmpty()
    plain = models.train_classifier(labelled, "k", "y", ["a", "b", "n", "c"], calibrate=None)
    long, per = models.linear_shap(plain, labelled, "k")
    assert models.shap_check(long, "k").first().is_consistent
    assert per.first().feature == "a" and {r.feature for r in per.collect()} == {"a", "b", "n", "c"}
    importance = models.permutation_importance(plain, labelled, "k", "y", ["a", "n"], repeats=1)
    assert importance.first().feature == "a"


def test_unseen_levels_become_zeros(labelled):
    odd = labelled.withColumn("c", F.when(F.col("k") % 40 == 0, F.concat(F.lit("new"), F.col("k").cast("string"))).otherwise(F.col("c")))
    assert models.train_classifier(odd, "k", "y", ["a", "c"], calibrate=None).predictions.count() > 100


def test_calibrators_are_monotone(labelled):
    t = models.train_classifier(labelled, "k", "y", ["a", "b"], calibrate=None)
    for build in (models.sigmoid_calibrator, models.isotonic_calibrator):
        c = build(t.predictions, "actual", "probability")
        rows = t.predictions.select(F.col("probability").alias("p"), c.alias("q")).orderBy("p").collect()
        assert all(x.q <= y.q + 1e-12 for x, y in zip(rows, rows[1:]))
    assert models.sigmoid_calibrator(t.predictions.limit(10), "actual", "probability") is None


def test_parsimony_weights_and_elimination(labelled):
    out = models.parsimony_study(labelled, "k", "y", ["a", "b", "n", "c"], (2,))
    assert out["summary"].agg(F.sum("akaike_weight")).first()[0] == pytest.approx(1, abs=1e-5)
    ranks = {r.feature: r.ranking for r in models.recursive_elimination(labelled, "k", "y", ["a", "b", "n"], 1).collect()}
    assert ranks["a"] == 1 and ranks["n"] == 3


def test_bootstrap_interval_order(spark, labelled):
    dated = labelled.withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("k").cast("int")))
    rows, summary = models.bootstrap_intervals(dated, "k", "y", ["a", "b"], "d", iterations=3)
    assert rows.where("p_low > p_mid or p_mid > p_high").isEmpty() and summary.first().iterations == 3
    weights = dated.select(models.poisson_weight("k", 1).alias("w")).agg(F.avg("w"), F.max("w")).first()
    assert 0.85 < weights[0] < 1.15 and weights[1] >= 3
    folds, total = models.purged_validation(dated, "k", "y", ["a", "b"], "d", blocks=3)
    assert total.first().n_folds == folds.count() == 2


def test_value_models_and_error_weights(labelled):
    assert models.error_weights(1.8) == (1.0, 1.8) and models.error_weights(0.5) == (2.0, 1.0) and models.error_weights(1.0) == (1.0, 1.0)
    table, _ = models.value_benchmark(labelled, "k", "v", ["a", "n"], ("linear", "lasso"))
    assert table.first().is_champion and table.first().mae_vs_baseline < 0.2


def test_simple_models_win_close_races(spark):
    table = spark.createDataFrame([("random_forest", 0.80), ("logistic", 0.79)], "model string, roc_auc double")
    assert models.promote_simple(table) == "logistic" and models.promote_simple(table, tolerance=0.001) == "random_forest"
    errors = spark.createDataFrame([("gradient_boosting", 10.0), ("lasso", 10.1), ("linear", 11.0)], "model string, rmse double")
    assert models.promote_simple(errors, "regression") == "lasso"
    assert models.benchmark_models("VALUE_prediction")[0] == "linear" and models.benchmark_models(models=["Logistic "]) == ("logistic",)


def test_quick_report_tables(spark, sf):
    out = describe.quick_report(spark.read.parquet(f"{sf}/part.parquet"), "p_partkey")
    assert set(out) == {"quality", "nulls", "numeric", "outliers", "categorical"}
    assert out["nulls"].agg(F.sum("nulls")).first()[0] == 0


def test_kmeans_separates(spark):
    rows = [(i, float(i % 3) * 10 + (i % 7) * 0.1, float(i % 3) * -5) for i in range(90)]
    m = segments.segment_matrix(spark.createDataFrame(rows, "k long, a double, b double"), ["a", "b"])
    assert segments.kmeans_options(m, (2, 3, 4)).first().k == 3
    out = segments.kmeans_segments(m, 3)
    assert out.groupBy(F.col("k") % 3).agg(F.count_distinct("cluster_id").alias("n")).where("n <> 1").isEmpty()


def test_sources_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 2.5), (2, "x", None)], "a int, b string, c double")
    io.write_csv(df, f"{tmp_path}/t")
    back = io.read_csv(spark, [f"{tmp_path}/missing", f"{tmp_path}/t"], df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    with pytest.raises(FileNotFoundError):
        io.read_csv(spark, f"{tmp_path}/none")
    assert io.write_tables({"t": df, "none": df.limit(0)}, f"{tmp_path}/o", "raw", "r1") == ["t"]
    io.append_run_log(spark, f"{tmp_path}/o", "r1", {"seed": 42}, {"auc": 0.7})
    assert spark.read.parquet(f"{tmp_path}/o/run_log").count() == 2
    io.write_json(spark, {"x": float("nan"), "y": [1, None]}, f"{tmp_path}/j")
    assert spark.read.text(f"{tmp_path}/j").first().value == '{"x": null, "y": [1, null]}'


def test_activation_case(spark, sf):
    data = materialize(customers(spark, sf), "customers")
    scores = data.select("customer_id", F.col("churned").alias("actual"), F.col("score").alias("probability"))
    out = catalog_cases.activation_run(data, catalog_cases.case(), scores)
    assert out["scorecard"].count() == data.count()
    assert out["playbook"].agg(F.sum("customers")).first()[0] == data.count()


def test_entry_runs(spark):
    assert entry(spark).count() > 0


CHECKED = [
    "clv_shrinkage", "null_profile", "psi_numeric", "date_gap", "numeric_summary", "fracdiff", "lag_features", "event_ranking_metrics",
    "event_board", "roc_auc", "purged_folds", "threshold_sweep", "retention_scorecard", "kruskal", "simpson_spearman", "durbin_watson",
]


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sf, name):
    df = queries()[name](spark, sf)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    cursor = con.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, cursor.fetchall())


def test_a_run_written_twice_keeps_its_rows_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    for run in ("r1", "r2", "r1"):
        assert io.write_tables({"t": df}, str(tmp_path), "raw", run) == ["t"]
    assert spark.read.parquet(f"{tmp_path}/raw/t").groupBy("run_id").count().where("count <> 2").isEmpty()
    assert io.to_json_text({"d": datetime.date(2024, 1, 2), 3: (float("nan"), {"z": object})}).startswith('{"d": "2024-01-02", "3": [null, {"z": "')


def test_unknown_case_and_labels(spark):
    with pytest.raises(ValueError):
        models.benchmark_models("weather")
    profile = spark.createDataFrame([(0, 5.0, 1.0), (1, 9.0, 2.0), (2, 9.0, 0.5), (3, 1.0, 3.0)], "cluster int, v double, s double")
    rules = [{"label": "top", "metric": "v"}, {"label": "none", "metric": "absent"}, {"label": "calm", "metric": "s", "direction": "min"}, {"label": "risk", "metric": "s"}]
    assert activation.greedy_labels(profile, "cluster", rules) == {0: "none", 1: "top", 2: "calm", 3: "risk"}


def test_scratch_tables_can_be_dropped(spark):
    df = materialize(spark.range(5).toDF("a"), "drop")
    folder = session.run_folder(spark)
    assert os.path.isdir(folder) and df.count() == 5
    assert session.drop_scratch(spark) and not os.path.exists(folder)
