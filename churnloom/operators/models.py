"""Model training, validation, uncertainty and explanation on ``pyspark.ml``.

Splits and resamples are hash-based on the row key: the same rows land in the same part whatever the
partitioning, and nothing is shuffled to split.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.scalar import clip, count_rows, hash_unit, num, numeric_columns, rnd, text_columns
from ..session import materialize, side_by_side
from .clean import effective_scaler, handle_outliers, lag_features, preprocessing_stages, spline_basis
from .impute import knn_impute, mice_impute
from .linear import gram
from .neighbors import mean_of_neighbors, nearest
from .newton import Candidate, design, fit_stack, long_scores, score_stack
from .quality import time_split
from .quantiles import bin_of, distinct_edges, quantiles
from .scoring import (
    classification_metrics,
    probability_losses,
    purged_folds,
    regression_metrics,
    roc_auc,
    score_metrics_by,
    temporal_summary,
)

#: Penalty of plain logistic models.
LOGISTIC_L2 = 1e-6


# Models compared per business case, and the complexity order used for ties.
CATALOG = {
    "classification_general": ("logistic", "random_forest", "gradient_boosting", "mlp"),
    "banking_classification": ("logistic", "random_forest", "gradient_boosting", "mlp"),
    "value_prediction": ("linear", "lasso", "gradient_boosting", "knn"),
}
COMPLEXITY = {
    "linear": 1, "logistic": 2, "lasso": 2, "ridge": 3, "elasticnet": 4, "knn": 5, "spline": 6,
    "gradient_boosting": 7, "random_forest": 8, "mlp": 11,
}


def benchmark_models(case: str = "classification_general", models: Sequence[str] = ()) -> tuple[str, ...]:
    """The models to compare: those named, else the catalogue entry of the business case.

    Catalogue entries that rest on external boosting libraries or on forecasting are not offered; an unknown case raises.
    """
    clean = lambda name: name.strip().lower()
    if not models and clean(case) not in CATALOG:
        raise ValueError(f"unknown case {case!r}; known: {sorted(CATALOG)}")
    return tuple(map(clean, models)) or CATALOG[clean(case)]


def split_by_key(df: DataFrame, key: str, test_size: float = 0.25, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    held_out = hash_unit(key, seed) < test_size
    return df.where(~held_out), df.where(held_out)


def classifier(algorithm: str, width: int = 0, seed: int = 42, weight: str | None = None, trees: int = 100):
    extra = {"weightCol": weight} if weight else {}
    base = {"featuresCol": "features", "labelCol": "label"}
    if algorithm in ("logistic", "spline"):
        return LogisticRegression(**base, maxIter=100, regParam=LOGISTIC_L2 if algorithm == "logistic" else 1e-3, **extra)
    if algorithm == "random_forest":
        return RandomForestClassifier(**base, numTrees=trees, maxDepth=8, seed=seed, **extra)
    if algorithm == "gradient_boosting":
        return GBTClassifier(**base, maxIter=20, maxDepth=3, seed=seed, **extra)
    if algorithm == "mlp":
        if weight:
            raise ValueError("mlp has no row weights")
        return MultilayerPerceptronClassifier(**base, layers=[width, 128, 64, 2], maxIter=50, seed=seed)
    raise ValueError(f"unknown classifier {algorithm}")


def regressor(algorithm: str, seed: int = 42, trees: int = 100):
    base = {"featuresCol": "features", "labelCol": "label"}
    if algorithm in ("linear", "spline"):
        return LinearRegression(**base, regParam=0.0 if algorithm == "linear" else 1.0)
    if algorithm in ("ridge", "lasso", "elasticnet"):
        mix = {"ridge": 0.0, "lasso": 1.0, "elasticnet": 0.5}[algorithm]
        return LinearRegression(**base, regParam=0.1, elasticNetParam=mix)
    if algorithm == "random_forest":
        return RandomForestRegressor(**base, numTrees=trees, maxDepth=8, seed=seed)
    if algorithm == "gradient_boosting":
        return GBTRegressor(**base, maxIter=20, maxDepth=3, seed=seed)
    raise ValueError(f"unknown regressor {algorithm}")


@dataclass(frozen=True)
class Trained:
    """A fitted model with held-out ``predictions`` (key, actual, predicted, probability...) and ``metrics``."""

    algorithm: str
    problem: str
    model: Transformer | None
    predictions: DataFrame
    metrics: DataFrame
    calibration: str | None = None
    features: list[str] = field(default_factory=list)


def feature_kinds(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    numbers, texts = set(numeric_columns(df)), set(text_columns(df))
    bad = [c for c in features if c not in numbers and c not in texts]
    if bad:
        raise ValueError(f"features must be numeric or text: {bad}")
    return [c for c in features if c in numbers], [c for c in features if c in texts]


def _balanced(train: DataFrame) -> Column:
    """Inverse class frequency as row weight."""
    one = train.agg(count_rows().alias("n"), F.sum("label").alias("p")).first()
    p, n = one["p"] or 0.0, one["n"]
    if p in (0.0, float(n)):
        raise ValueError("the target has one class")
    return F.when(F.col("label") == 1, n / (2.0 * p)).otherwise(n / (2.0 * (n - p)))


def _width(stages: list, train: DataFrame) -> int:
    one = Pipeline(stages=stages).fit(train).transform(train).select("features").first()
    return len(one["features"])


def _knn_scores(train: DataFrame, test: DataFrame, key: str, stages: list, k: int = 15) -> DataFrame:
    prep = Pipeline(stages=stages).fit(train)
    width = len(prep.transform(train).select("features").first()["features"])
    cells = vector_to_array("features")
    names = [f"_d{i}" for i in range(width)]
    spread = [cells[i].alias(n) for i, n in enumerate(names)]
    a = prep.transform(train).select("label", *spread)
    b = prep.transform(test).select(key, "label", *spread)
    near = nearest(b, key, a, "label", names, k).select(key, mean_of_neighbors(F.col("neighbors"), k, by_distance=True).alias("score"))
    return b.select(key, "label").join(near, key)


def fill_learned(train: DataFrame, test: DataFrame, key: str, numeric: Sequence[str], imputer: str) -> tuple[DataFrame, DataFrame]:
    """Both parts with ``knn`` or ``iterative`` imputation learned on the train rows alone; other imputers are pipeline stages."""
    if imputer not in ("knn", "iterative") or not numeric:
        return train, test
    if imputer == "knn":
        return tuple(materialize(knn_impute(part, key, numeric, donors=train), "filled") for part in (train, test))
    both = train.withColumn("_train", F.lit(True)).unionByName(test.withColumn("_train", F.lit(False)))
    filled = mice_impute(both, numeric, fit_on=F.col("_train"))[0]
    return filled.where("_train").drop("_train"), filled.where("NOT _train").drop("_train")


def train_classifier(
    df: DataFrame,
    key: str,
    target: str,
    features: Sequence[str],
    algorithm: str = "logistic",
    test_size: float = 0.25,
    seed: int = 42,
    calibrate: str | None = "auto",
    split: tuple[DataFrame, DataFrame] | None = None,
    scaler: str = "standard",
    trees: int = 100,
    **prep,
) -> Trained:
    """Split, preprocess, fit, calibrate on an inner split, score the held-out rows."""
    keep = list(dict.fromkeys([key, *features]))
    rows = df.select(*keep, num(target).alias("label")).where(F.col("label").isNotNull()) if split is None else None
    if split is None:
        train, test = split_by_key(materialize(rows, "train"), key, test_size, seed)
    else:
        train, test = (p.select(*keep, num(target).alias("label")).where(F.col("label").isNotNull()) for p in split)
    used = list(features)
    numeric, text = feature_kinds(train, used)
    train, test = fill_learned(train, test, key, numeric, prep.get("imputer", "median"))
    if algorithm == "spline":
        train, test, numeric = _spline_parts(train, test, numeric)
    fit_part, tune_part = train, None
    one = train.agg(count_rows().alias("n"), F.sum("label").alias("p")).first()
    if calibrate and one["n"] >= 80 and min(one["p"] or 0, one["n"] - (one["p"] or 0)) >= 10:
        inner = hash_unit(key, seed + 1) < 0.25
        fit_part, tune_part = train.where(~inner), train.where(inner)
    stages = preprocessing_stages(fit_part, numeric, text, scaler=effective_scaler(algorithm, scaler), **prep)
    model = None
    if algorithm == "knn":
        def scored(part: DataFrame) -> DataFrame:
            return _knn_scores(fit_part, part, key, stages).withColumnRenamed("score", "probability_raw")
    else:
        if algorithm == "random_forest":
            fit_part = fit_part.withColumn("_w", _balanced(fit_part))
        estimator = classifier(algorithm, _width(stages, fit_part) if algorithm == "mlp" else 0, seed,
                               "_w" if algorithm == "random_forest" else None, trees)
        model = Pipeline(stages=[*stages, estimator]).fit(fit_part)

        def scored(part: DataFrame) -> DataFrame:
            return model.transform(part).select(key, "label", vector_to_array("probability")[1].alias("probability_raw"))

    out = materialize(scored(test), "scored")
    method, calibrated = None, F.col("probability_raw")
    if tune_part is not None:
        method, calibrated = choose_calibrator(materialize(scored(tune_part), "tune"), "label", "probability_raw", calibrate)
    out = out.select(
        key, F.col("label").cast("int").alias("actual"), "probability_raw", calibrated.alias("probability")
    ).withColumn("predicted", (F.col("probability") >= 0.5).cast("int"))
    return Trained(algorithm, "classification", model, out, classification_metrics(out, "actual", "probability"), method, used)


def _spline_parts(train: DataFrame, test: DataFrame, numeric: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    both = train.withColumn("_part", F.lit(0)).unionByName(test.withColumn("_part", F.lit(1)))
    wide, names = spline_basis(both, numeric, fit_on=train)
    return wide.where(F.col("_part") == 0), wide.where(F.col("_part") == 1), names


def train_regressor(
    df: DataFrame, key: str, target: str, features: Sequence[str], algorithm: str = "linear", test_size: float = 0.25,
    seed: int = 42, scaler: str = "standard", trees: int = 100, split: tuple[DataFrame, DataFrame] | None = None, **prep,
) -> Trained:
    keep = list(dict.fromkeys([key, *features]))
    label = num(target).alias("label")
    if split is None:
        rows = materialize(df.select(*keep, label).where(F.col("label").isNotNull()), "train")
        train, test = split_by_key(rows, key, test_size, seed)
    else:
        train, test = (p.select(*keep, label).where(F.col("label").isNotNull()) for p in split)
    numeric, text = feature_kinds(train, features)
    train, test = fill_learned(train, test, key, numeric, prep.get("imputer", "median"))
    stages = preprocessing_stages(train, numeric, text, scaler=effective_scaler(algorithm, scaler), **prep)
    model = None
    if algorithm == "knn":
        out = _knn_scores(train, test, key, stages).select(key, F.col("label").alias("actual"), F.col("score").alias("predicted"))
    else:
        model = Pipeline(stages=[*stages, regressor(algorithm, seed, trees)]).fit(train)
        out = model.transform(test).select(key, F.col("label").alias("actual"), F.col("prediction").alias("predicted"))
    out = materialize(out, "scored")
    return Trained(algorithm, "regression", model, out, regression_metrics(out, "actual", "predicted"), None, list(features))


# --- calibration ----------------------------------------------------------------------------------


def sigmoid_calibrator(df: DataFrame, label: str, probability: str) -> Column | None:
    """Logistic curve of the score as a column expression; null below 40 rows or with one class."""
    p = clip(num(probability), 1e-6, 1 - 1e-6)
    rows = df.select(num(label).alias("label"), p.alias("p")).dropna()
    one = rows.agg(count_rows().alias("n"), F.sum("label").alias("s")).first()
    if one["n"] < 40 or one["s"] in (0.0, float(one["n"])):
        return None
    data = VectorAssembler(inputCols=["p"], outputCol="features").transform(rows)
    m = LogisticRegression(labelCol="label", regParam=1.0 / one["n"], maxIter=100, standardization=False).fit(data)
    score = F.lit(float(m.intercept)) + p * float(m.coefficients[0])
    return clip(1.0 / (1.0 + F.exp(-score)), 1e-6, 1 - 1e-6)


def isotonic_calibrator(df: DataFrame, label: str, probability: str) -> Column | None:
    """Monotone step-linear curve of the score, fitted on counts per distinct score."""
    p = clip(num(probability), 1e-6, 1 - 1e-6)
    rows = df.select(num(label).alias("label"), p.alias("p")).dropna()
    one = rows.agg(count_rows().alias("n"), F.sum("label").alias("s")).first()
    if one["n"] < 40 or one["s"] in (0.0, float(one["n"])):
        return None
    points = rows.groupBy("p").agg(F.avg("label").alias("label"), count_rows().cast("double").alias("w"))
    m = IsotonicRegression(labelCol="label", featuresCol="p", weightCol="w").fit(points)
    xs, ys = np.array(m.boundaries.toArray()), np.clip(m.predictions.toArray(), 1e-6, 1 - 1e-6)

    @F.pandas_udf("double")
    def curve(scores: pd.Series) -> pd.Series:
        return pd.Series(np.where(scores.isna(), np.nan, np.interp(scores.fillna(0.0), xs, ys)))

    return F.nanvl(curve(p), F.lit(None).cast("double"))


def choose_calibrator(df: DataFrame, label: str, probability: str, method: str = "auto") -> tuple[str | None, Column]:
    """The calibrator with the lowest Brier score on half of the calibration rows, only if it beats the raw score."""
    raw = clip(num(probability), 1e-6, 1 - 1e-6)
    first = F.pmod(F.hash(num(probability), *[F.col(c) for c in df.columns if c not in (label, probability)]), F.lit(2)) == 0
    fit_rows, check = df.where(first), df.where(~first)
    options: dict[str, Column] = {}
    for name, build in (("sigmoid", sigmoid_calibrator), ("isotonic", isotonic_calibrator)):
        if method in ("auto", name):
            c = build(fit_rows, label, probability)
            if c is not None:
                options[name] = c
    if not options:
        return None, raw
    y = num(label)
    row = check.agg(
        F.avg((raw - y) * (raw - y)).alias("raw"), *[F.avg((c - y) * (c - y)).alias(n) for n, c in options.items()]
    ).first()
    best = min(options, key=lambda n: math.inf if row[n] is None else row[n])
    if row["raw"] is None or row[best] is None or row[best] >= row["raw"]:
        return None, raw
    return best, options[best]


def calibration_comparison(predictions: DataFrame) -> DataFrame:
    """Brier score before and after calibration."""
    raw = probability_losses(predictions, "actual", "probability_raw").select(F.col("brier_score").alias("brier_raw"))
    new = probability_losses(predictions, "actual", "probability").select("brier_score")
    return raw.crossJoin(new).withColumn("delta", rnd(F.col("brier_raw") - F.col("brier_score"), 4))


# --- comparison and selection ---------------------------------------------------------------------


def benchmark(
    df: DataFrame, key: str, target: str, features: Sequence[str], models: Sequence[str], problem: str = "classification",
    test_size: float = 0.25, seed: int = 42, trees: int = 40,
) -> tuple[DataFrame, dict[str, Trained], dict[str, str]]:
    """Metrics per model on one split, best first; models that fail are listed with their reason."""
    data = materialize(df.select(*dict.fromkeys([key, target, *features])), "benchmark")
    split = split_by_key(data, key, test_size, seed)
    done: dict[str, Trained] = {}
    failed: dict[str, str] = {}
    train = train_classifier if problem == "classification" else train_regressor

    def attempt(m: str) -> Trained | str:
        try:
            t = train(data, key, target, features, m, seed=seed, split=split, trees=trees)
            t.metrics.first()
            return t
        except Exception as error:  # noqa: BLE001 - one failing model must not stop the comparison
            return str(error).splitlines()[0] if str(error) else type(error).__name__

    for m, t in zip(models, side_by_side([partial(attempt, m) for m in models])):
        if isinstance(t, Trained):
            done[m] = t
        else:
            failed[m] = t
    if not done:
        raise ValueError(f"no model could be trained: {failed}")
    table = None
    for m, t in done.items():
        row = t.metrics.select(F.lit(m).alias("model"), F.lit(COMPLEXITY.get(m, 99)).alias("complexity"), "*")
        table = row if table is None else table.unionByName(row)
    order = [F.desc("roc_auc"), F.desc("f1"), F.asc("complexity")] if problem == "classification" else [F.asc("rmse"), F.asc("mae"), F.asc("complexity")]
    return materialize(table, "benchmark_table").orderBy(*order), done, failed


def promote_simple(metrics: DataFrame, problem: str = "classification", tolerance: float = 0.015) -> str:
    """The champion, unless a simple model is within the tolerance of it."""
    rows = metrics.collect()
    best = rows[0]
    if problem == "classification":
        simple = [r for r in rows if r["model"] == "logistic"]
        if simple and best["roc_auc"] - simple[0]["roc_auc"] <= tolerance:
            return "logistic"
    else:
        simple = sorted((r for r in rows if r["model"] in ("linear", "lasso")), key=lambda r: r["rmse"])
        if simple and simple[0]["rmse"] - best["rmse"] <= max(best["rmse"] * tolerance, 1e-6):
            return simple[0]["model"]
    return best["model"]


def parsimony_study(
    df: DataFrame, key: str, target: str, features: Sequence[str], steps: Sequence[int] = (4, 8, 12, 18),
    test_size: float = 0.25, seed: int = 42,
) -> dict[str, DataFrame | list[str]]:
    """Nested logistic models on feature prefixes: AUC, losses, AIC, BIC, Akaike weights and their ensemble."""
    spark = df.sparkSession
    data = materialize(df.select(*dict.fromkeys([key, *features]), num(target).alias("label")).where(F.col("label").isNotNull()), "parsimony")
    train, test = split_by_key(data, key, test_size, seed)
    # Proper prefixes of at least two features, then all features.
    sizes = [n for n in range(2, len(features)) if n in steps] + [len(features)]
    numeric, text = feature_kinds(train, list(features))
    d = design(train, numeric, text, [key])
    fills = d.fills(d.rows)
    # All prefixes are fitted together: they are column sets of one design.
    fits = fit_stack(d.rows, d.width, [Candidate(columns=d.columns(features[:n]), fills=fills) for n in sizes])
    held = design(test, numeric, text, [key], levels=d.levels).rows.withColumn("actual", F.col("label").cast("int"))
    scored = materialize(score_stack(held, [key, "actual"], fits), "parsimony_scores")
    rows = []
    for size, f in zip(sizes, fits):
        k = 1 + int(np.sum(np.abs(f.coefficients) > 1e-10))
        ll = f.log_likelihood
        rows.append((size, ", ".join(features[:size]), round(-2 * ll + 2 * k, 4), round(-2 * ll + k * math.log(f.rows), 4), round(ll, 4), k))
    scores = scored.select(key, "actual", *[F.col("scores")[i].alias(f"p_{n}") for i, n in enumerate(sizes)])
    found = score_metrics_by(long_scores(scored, ["actual"], dict(enumerate(sizes))), ["model"], "actual", "p").collect()
    measured = {r["model"]: r for r in found}
    low = min(r[2] for r in rows)
    weights = [math.exp(-0.5 * (r[2] - low)) for r in rows]
    total = sum(weights)
    table = []
    for r, w in zip(rows, weights):
        m = measured[r[0]]
        table.append((f"logistic_top_{r[0]}", r[0], r[1], m["roc_auc"], m["log_loss"], m["brier_score"], r[2], r[3], r[4], r[5], round(w / total, 6)))
    summary = spark.createDataFrame(
        table,
        "candidate string, n_features int, features string, roc_auc double, log_loss double, brier_score double, "
        "aic double, bic double, log_likelihood double, n_parameters int, akaike_weight double",
    ).orderBy("bic", F.desc("roc_auc"), "log_loss")
    mix = sum((F.col(f"p_{r[0]}") * (w / total) for r, w in zip(rows, weights)), F.lit(0.0))
    ensemble = scores.select(key, "actual", mix.alias("probability"))
    best = min(zip(table, rows), key=lambda x: (x[0][7], -(x[0][3] or 0), x[0][4]))[1][0]
    return {
        "summary": summary, "ensemble": ensemble, "recommended": list(features[:best]),
        "ensemble_metrics": roc_auc(ensemble, "actual", "probability").select("roc_auc").crossJoin(probability_losses(ensemble, "actual", "probability")),
    }


def cross_validated_auc(df: DataFrame, key: str, target: str, features: Sequence[str], folds: int = 5, seed: int = 42) -> DataFrame:
    """AUC of a logistic model on hash folds, one row per fold."""
    found = _fold_metrics(df, key, target, [features], folds, seed)
    return found.select(F.col("_fold").alias("fold"), "roc_auc", "log_loss", "brier_score")


def _fold_metrics(df: DataFrame, key: str, target: str, subsets: Sequence[Sequence[str]], folds: int, seed: int) -> DataFrame:
    """Held-out metrics by ``subset`` (its place) and ``_fold``: logistic models of all subsets and folds fitted together.

    A fold's missing values are filled as its own training rows say.
    """
    every = list(dict.fromkeys(f for s in subsets for f in s))
    numeric, text = feature_kinds(df, every)
    rows = df.withColumn("_label", num(target))
    fold = F.floor(hash_unit(key, seed) * folds).cast("int")
    apart = F.array(*[(fold != i).cast("double") for i in range(folds)])
    d = design(rows, numeric, text, [key], "_label", _fold=fold, _weights=apart)
    fills = [d.fills(d.rows.where(F.col("_fold") != i)) for i in range(folds)]
    models = [Candidate(i, d.columns(s), LOGISTIC_L2, fills[i]) for s in subsets for i in range(folds)]
    fits = fit_stack(d.rows, d.width, models, "_label", "_weights")
    scored = score_stack(d.rows, ["_label", "_fold"], fits)
    own = [F.struct(F.lit(j).alias("subset"), F.col("scores")[F.lit(j * folds) + F.col("_fold")].alias("p")) for j in range(len(subsets))]
    usable = [F.struct(F.lit(j).alias("j"), F.lit(i).alias("i")) for j in range(len(subsets)) for i in range(folds) if fits[j * folds + i].ok]
    if not usable:
        raise ValueError("no fold has training rows of both classes")
    long = scored.select("_label", "_fold", F.inline(F.array(*own)))
    long = long.where(F.array_contains(F.array(*usable), F.struct(F.col("subset").alias("j"), F.col("_fold").alias("i"))))
    return score_metrics_by(long, ["subset", "_fold"], "_label", "p").orderBy("subset", "_fold")


def select_by_cv_then_bic(df: DataFrame, key: str, target: str, features: Sequence[str], steps: Sequence[int], tolerance: float = 0.015, folds: int = 3) -> DataFrame:
    """Mean fold AUC and BIC per prefix; the lowest BIC among prefixes within the tolerance of the best AUC is chosen."""
    study = {r["n_features"]: r["bic"] for r in parsimony_study(df, key, target, features, steps)["summary"].collect()}
    sizes = sorted(study)
    found = _fold_metrics(df, key, target, [features[:n] for n in sizes], folds, 42)
    means = {r["subset"]: r["auc"] for r in found.groupBy("subset").agg(F.avg("roc_auc").alias("auc")).collect()}
    rows = [(n, round(means[j], 4), study[n]) for j, n in enumerate(sizes)]
    best = max(r[1] for r in rows)
    chosen = min((r for r in rows if r[1] >= best - tolerance), key=lambda r: r[2])[0]
    return df.sparkSession.createDataFrame(
        [(*r, r[0] == chosen) for r in rows], "n_features int, mean_cv_auc double, bic double, is_selected boolean"
    )


def mutual_information(df: DataFrame, target: str, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each feature with the target from binned counts, highest first."""
    numbers = [c for c in features if c in numeric_columns(df)]
    cuts = quantiles(df, numbers, [i / bins for i in range(bins + 1)]) if numbers else {}

    def label(c: str) -> Column:
        if c in cuts:
            edges = distinct_edges(cuts[c].values())
            return bin_of(num(c), edges).cast("string") if len(edges) > 1 else F.lit("0")
        return F.coalesce(F.col(c).cast("string"), F.lit("<NA>"))

    cells = F.array(*[F.struct(F.lit(c).alias("feature"), label(c).alias("x")) for c in features])
    joint = (
        df.where(F.col(target).isNotNull())
        .select(F.explode(cells).alias("c"), F.col(target).cast("string").alias("y"))
        .select("c.*", "y").where(F.col("x").isNotNull())
        .groupBy("feature", "x", "y").agg(count_rows().cast("double").alias("n"))
    )
    joint = materialize(joint, "joint")
    # Per feature and per (feature, target value): as many rows as features and target values, whatever x holds.
    total = joint.groupBy("feature").agg(F.sum("n").alias("_all"))
    by_y = joint.groupBy("feature", "y").agg(F.sum("n").alias("_y"))
    by_x = joint.groupBy("feature", "x").agg(F.sum("n").alias("_x"))
    terms = joint.join(by_x, ["feature", "x"]).join(by_y, ["feature", "y"]).join(F.broadcast(total), "feature")
    terms = terms.withColumn("t", F.col("n") / F.col("_all") * F.log(F.col("n") * F.col("_all") / (F.col("_x") * F.col("_y"))))
    return terms.groupBy("feature").agg(rnd(F.sum("t"), 4).alias("mutual_information")).orderBy(F.desc("mutual_information"), "feature")


def recursive_elimination(df: DataFrame, key: str, target: str, features: Sequence[str], keep: int = 8, problem: str = "classification") -> DataFrame:
    """Drops the feature with the smallest |standardised coefficient| until ``keep`` remain; rank 1 is kept."""
    from .clean import dummies, fill_values

    numeric, text = feature_kinds(df, features)
    data = df.where(F.col(target).isNotNull()).select(key, num(target).alias("label"), *features)
    if text:
        data, added = dummies(data, text)
        numeric = numeric + added
    fills = fill_values(data, numeric)
    filled = data.select("label", *[F.coalesce(num(c), F.lit(float(fills.get(c, 0.0)))).alias(c) for c in numeric])
    left, ranks = list(numeric), {}
    keep = min(max(1, keep), len(left))
    if problem == "classification":
        d = design(filled, numeric, [])
        fits = None
        while len(left) > keep:
            # Each round starts from the larger model, so that a few passes are enough.
            fits = fit_stack(d.rows, d.width, [Candidate(columns=d.columns(left), l2=LOGISTIC_L2)], start=fits)
            if not fits[0].ok:
                raise ValueError("the target has one class")
            spread = fits[0].frame[1] * fits[0].frame[2]
            strength = np.abs(fits[0].coefficients) * spread
            worst = min(left, key=lambda c: strength[d.slots[c][0]])
            ranks[worst] = len(left) - keep + 1
            left.remove(worst)
    else:
        # Least squares need the cross-products only: one pass, then every elimination is arithmetic.
        g = gram(filled, numeric, F.col("label"))
        spread = np.sqrt(np.diag(g.xx) / max(g.n - 1, 1))
        while len(left) > keep:
            at = [numeric.index(c) for c in left]
            unit = np.where(spread[at] > 0, spread[at], 1.0)
            inner = g.xx[np.ix_(at, at)] / np.outer(unit, unit) / g.n
            slopes = np.linalg.lstsq(inner + 1e-9 * np.eye(len(at)), g.xy[at] / unit / g.n, rcond=None)[0]
            worst = int(np.argmin(np.abs(slopes)))
            ranks[left[worst]] = len(left) - keep + 1
            left.pop(worst)
    ranks.update({c: 1 for c in left})
    return df.sparkSession.createDataFrame(
        [(c, ranks[c], ranks[c] == 1) for c in numeric], "feature string, ranking int, selected boolean"
    ).orderBy("ranking", "feature")


def permutation_importance(trained: Trained, rows: DataFrame, key: str, target: str, features: Sequence[str] | None = None, repeats: int = 10, seed: int = 42) -> DataFrame:
    """Drop in AUC (or R2) when one feature is shuffled between rows.

    Rows are numbered once, in hash order. In each repeat a row's partner is another row by a one-to-one map of the
    numbers, so a repeat is one join; all features and repeats are scored in one pass and compared group by group.
    """
    from .ordered import positions, running_sums

    features = list(features or trained.features)
    inputs = list(dict.fromkeys(trained.features))
    data = rows.where(F.col(target).isNotNull()).select(key, num(target).alias("label"), *inputs)
    at = materialize(positions(data.withColumn("_h", hash_unit(key, seed)), ["_h", key], "_i").drop("_h"), "perm")
    n = at.count()
    rng = np.random.default_rng(seed)
    maps = []
    while len(maps) < repeats:
        step = int(rng.integers(1, max(n, 2)))
        if math.gcd(step, n) == 1:
            maps.append((len(maps), step, int(rng.integers(0, max(n, 1)))))
    # One row per repeat, and one for the unshuffled rows.
    plan = F.array(*[F.struct(F.lit(r).alias("repeat"), F.lit(m).cast("decimal(20,0)").alias("m"), F.lit(o).alias("o")) for r, m, o in maps])
    tried = at.withColumn("_plan", F.explode(plan)).withColumn(
        "_partner", F.pmod(F.col("_i").cast("decimal(20,0)") * F.col("_plan.m") + F.col("_plan.o"), F.lit(n)).cast("bigint")
    )
    other = at.select(F.col("_i").alias("_partner"), F.struct(*inputs).alias("_other"))
    mixed = tried.join(other, "_partner").withColumn("_feature", F.explode(F.array(*[F.lit(f) for f in features])))
    mixed = mixed.select(
        key, "label", F.col("_plan.repeat").alias("_repeat"), "_feature",
        *[F.when(F.col("_feature") == f, F.col(f"_other.{f}")).otherwise(F.col(f)).alias(f) for f in inputs],
    )
    plain = at.select(key, "label", F.lit(-1).alias("_repeat"), F.lit("").alias("_feature"), *inputs)
    out = trained.model.transform(mixed.unionByName(plain))
    group = ["_feature", "_repeat"]
    if trained.problem == "classification":
        scores = out.select(*group, F.col("label").cast("int").alias("y"), vector_to_array("probability")[1].alias("p"))
        counts = scores.groupBy(*group, "p").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
        ranked, _ = running_sums(counts, group, ["p"], ["neg"])
        value = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0)) / (F.sum("pos").cast("double") * F.sum("neg"))
        scored = ranked.groupBy(*group).agg(value.alias("value"))
    else:
        e = F.col("label") - F.col("prediction")
        scored = out.groupBy(*group).agg((1 - F.sum(e * e) / (F.var_pop("label") * F.count("label"))).alias("value"))
    found = scored.collect()
    base = next(r["value"] for r in found if r["_repeat"] == -1)
    drops = {f: [base - r["value"] for r in found if r["_feature"] == f] for f in features}
    result = [(f, round(float(np.mean(d)), 4), round(float(np.std(d)), 4)) for f, d in drops.items()]
    return at.sparkSession.createDataFrame(result, "feature string, importance double, std double").orderBy(F.desc("importance"), "feature")


def _date_fold_metrics(data: DataFrame, key: str, target: str, features: Sequence[str], train: Sequence[Column], test: Sequence[Column]) -> dict[int, Row]:
    """Held-out metrics by fold of logistic models that are fitted together, one for each pair of conditions.

    A fold's missing values are filled as its own training rows say; folds whose training rows have one class are left out.
    """
    numeric, text = feature_kinds(data, features)
    both = {"_weights": F.array(*[F.coalesce(c, F.lit(False)).cast("double") for c in train]), "_held": F.array(*[F.coalesce(c, F.lit(False)) for c in test])}
    d = design(data.withColumn("_label", num(target)), numeric, text, [key], "_label", **both)
    fills = [d.fills(d.rows.where(F.col("_weights")[i] > 0)) for i in range(len(train))]
    fits = fit_stack(d.rows, d.width, [Candidate(i, d.columns(features), LOGISTIC_L2, f) for i, f in enumerate(fills)], "_label", "_weights")
    names = {i: i for i, f in enumerate(fits) if f.ok}
    if not names:
        return {}
    long = long_scores(score_stack(d.rows, ["_label", "_held"], fits), ["_label", "_held"], names)
    found = score_metrics_by(long.where(F.col("_held")[F.col("model")]), ["model"], "_label", "p")
    return {r["model"]: r for r in found.collect()}


def purged_validation(
    df: DataFrame, key: str, target: str, features: Sequence[str], date: str, algorithm: str = "logistic", blocks: int = 4,
    purge_days: int = 7, embargo_days: int = 14, seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """One model per date block, trained strictly before the block minus the purge; fold metrics and their summary."""
    data = materialize(df.select(*dict.fromkeys([key, date, target, *features])).dropna(subset=[date, target]), "purged")
    folds = purged_folds(data, date, target, blocks, purge_days, embargo_days).where("is_valid").orderBy("block").collect()
    day = F.to_date(date)
    schema = "fold int, train_end date, test_start date, test_end date, embargo_end date, n_train bigint, n_test bigint, purged_rows bigint, embargoed_rows bigint, roc_auc double, log_loss double, brier_score double"
    if not folds:
        out = materialize(data.sparkSession.createDataFrame([], schema), "folds")
        return out, temporal_summary(out)
    before = [day < F.date_sub(F.lit(r["start"]), purge_days) for r in folds]
    # The last training day of each fold, from the daily counts.
    last = data.agg(*[F.max(F.when(c, day)).alias(f"d{i}") for i, c in enumerate(before)]).first()
    within = [day.between(r["start"], r["end"]) for r in folds]
    if algorithm == "logistic":
        measured = _date_fold_metrics(data, key, target, features, before, within)
    else:
        def trained(i: int) -> Row:
            parts = (data.where(before[i]), data.where(within[i]))
            t = train_classifier(data, key, target, features, algorithm, calibrate=None, seed=seed + folds[i]["block"], split=parts)
            return t.metrics.select("roc_auc", "log_loss", "brier_score").first()

        measured = dict(enumerate(side_by_side([partial(trained, i) for i in range(len(folds))])))
    rows = [
        (
            r["block"], last[f"d{i}"], r["start"], r["end"], r["end"] + datetime.timedelta(days=embargo_days), r["n_train"], r["n_test"],
            r["purged_rows"], r["embargoed_rows"], *(measured[i][m] for m in ("roc_auc", "log_loss", "brier_score")),
        )
        for i, r in enumerate(folds) if i in measured
    ]
    out = data.sparkSession.createDataFrame(rows, schema)
    out = materialize(out, "folds")
    return out, temporal_summary(out)


def quantile_validation(
    df: DataFrame, key: str, target: str, features: Sequence[str], date: str, folds: int = 4, purge_days: int = 7, min_train: int = 30, min_test: int = 10,
) -> DataFrame:
    """Folds between date quantiles; the purge is waived when it would leave too little training data."""
    data = materialize(df.select(*dict.fromkeys([key, date, target, *features])).dropna(subset=[date, target]), "qfolds")
    stamp = F.unix_micros(F.col(date).cast("timestamp"))
    q = quantiles(data.select(stamp.alias("m")), ["m"], [i / (folds + 1) for i in range(folds + 2)])["m"]
    cuts = list(q.values())
    held = [(stamp > cuts[i]) & (stamp <= cuts[i + 1]) for i in range(1, folds + 1)]
    full = [stamp <= cuts[i] for i in range(1, folds + 1)]
    purged = [stamp <= cuts[i] - purge_days * 8.64e10 for i in range(1, folds + 1)]
    y = num(target)
    found = data.agg(
        *[F.count_if(c).alias(f"{n}{i}") for n, cs in (("test", held), ("full", full), ("purged", purged)) for i, c in enumerate(cs)],
        *[F.count_distinct(F.when(c, y)).alias(f"{n}{i}") for n, cs in (("test_y", held), ("full_y", full), ("purged_y", purged)) for i, c in enumerate(cs)],
    ).first()
    train, test, names = [], [], []
    for i in range(folds):
        part = "purged" if found[f"purged{i}"] >= min_train else "full"
        if found[f"test{i}"] >= min_test and found[f"test_y{i}"] == 2 and found[f"{part}_y{i}"] == 2:
            train.append(purged[i] if part == "purged" else full[i])
            test.append(held[i])
            names.append(i + 1)
    if not names:
        raise ValueError("no fold has enough rows of both classes")
    measured = _date_fold_metrics(data, key, target, features, train, test)
    rows = [(names[i], r["roc_auc"], r["log_loss"], r["brier_score"]) for i, r in sorted(measured.items())]
    return data.sparkSession.createDataFrame(rows, "fold int, roc_auc double, log_loss double, brier_score double")


def _poisson_cuts() -> list[float]:
    """The distribution function of Poisson(1), to double precision."""
    return np.cumsum([math.exp(-1.0) / math.factorial(i) for i in range(19)]).tolist()


def poisson_weights(key: str, seed: int, n: int) -> Column:
    """``n`` Poisson(1) bootstrap weights from the row key, one for each seed from ``seed`` on."""
    cuts = F.array(*map(F.lit, _poisson_cuts()))
    units = F.transform(F.sequence(F.lit(seed), F.lit(seed + n - 1)), lambda s: hash_unit(key, s))
    return F.transform(units, lambda u: F.size(F.filter(cuts, lambda c: c <= u)).cast("double"))


def poisson_weight(key: str, seed: int) -> Column:
    """One Poisson(1) bootstrap weight from the row key, by inverting the distribution function."""
    return poisson_weights(key, seed, 1)[0]


def _logistic_replicates(train: DataFrame, recent: DataFrame, key: str, features: Sequence[str], iterations: int, seed: int) -> tuple[DataFrame, int]:
    """Scores of the recent rows by the base model and, sorted in ``_all``, by all replicates; and how many there are."""
    numeric, text = feature_kinds(train, features)
    weights = poisson_weights(key, seed, iterations) if iterations else F.array().cast("array<double>")
    d = design(train, numeric, text, [key], _weights=weights)
    fills = d.fills(d.rows)
    wanted = [Candidate(l2=LOGISTIC_L2, fills=fills), *[Candidate(i, l2=LOGISTIC_L2, fills=fills) for i in range(iterations)]]
    base, *more = fit_stack(d.rows, d.width, wanted, weights="_weights")
    if not base.ok:
        raise ValueError("the target has one class")
    more = [f for f in more if f.ok] or [base]
    rows = design(recent, numeric, text, [key], levels=d.levels).rows.withColumn("actual", F.col("label").cast("int"))
    scored = score_stack(rows, [key, "actual"], [base, *more])
    used = sum(f is not base for f in more)
    return scored.select(
        key, "actual", F.col("scores")[0].alias("probability_base"), F.sort_array(F.slice("scores", 2, len(more))).alias("_all")
    ), used


def _refitted_replicates(train: DataFrame, recent: DataFrame, key: str, features: Sequence[str], algorithm: str, iterations: int, seed: int) -> tuple[DataFrame, int]:
    """The same by one fit per replicate, for models without a common gradient."""
    numeric, text = feature_kinds(train, features)
    prep = Pipeline(stages=preprocessing_stages(train, numeric, text)).fit(train)
    ready = materialize(prep.transform(train).select(key, "label", "features"), "boot_train")
    scored = prep.transform(recent).select(key, F.col("label").cast("int").alias("actual"), "features")

    def add(out: DataFrame, model, name: str) -> DataFrame:
        return model.transform(out).withColumn(name, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")

    scored = add(scored, classifier(algorithm, seed=seed).fit(ready), "probability_base")
    names = []
    for i in range(iterations):
        weighted = ready.withColumn("_w", poisson_weight(key, seed + i)).where(F.col("_w") > 0)
        if weighted.select("label").distinct().count() < 2:
            continue
        scored = add(scored, classifier(algorithm, seed=seed + i + 1, weight="_w").fit(weighted), f"_s{i}")
        names.append(f"_s{i}")
    sample = F.sort_array(F.array(*names)) if names else F.array("probability_base")
    return scored.select(key, "actual", "probability_base", sample.alias("_all")), len(names)


def bootstrap_intervals(
    df: DataFrame, key: str, target: str, features: Sequence[str], date: str, algorithm: str = "logistic",
    iterations: int = 40, alpha: float = 0.10, seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Score intervals for the newest 35% of rows from refits on reweighted history; rows and a portfolio summary.

    Refits use Poisson row weights, so no resampled copy is made; each row's scores sit in one array,
    so the quantiles need no shuffle. Logistic replicates are fitted together, in as many passes as one of them needs.
    """
    data = df.select(*dict.fromkeys([key, date, *features]), num(target).alias("label")).dropna(subset=[date, "label"])
    train, recent = time_split(materialize(data, "boot"), date, 0.65, key)
    if algorithm == "logistic":
        scored, used = _logistic_replicates(train, recent, key, features, int(iterations), seed)
    else:
        scored, used = _refitted_replicates(train, recent, key, features, algorithm, int(iterations), seed)
    m = max(used, 1)

    def at(p: float) -> Column:
        place = (m - 1) * p
        low = int(math.floor(place))
        part = place - low
        return F.col("_all")[low] * (1 - part) + F.col("_all")[min(low + 1, m - 1)] * part

    rows = scored.select(
        key, "actual", rnd(F.col("probability_base"), 4).alias("probability_base"), rnd(at(alpha / 2), 4).alias("p_low"),
        rnd(at(0.5), 4).alias("p_mid"), rnd(at(1 - alpha / 2), 4).alias("p_high"),
    ).withColumn("width", rnd(F.col("p_high") - F.col("p_low"), 4))
    rows = materialize(rows, "intervals")
    summary = rows.agg(
        F.lit(used).alias("iterations"), rnd(F.avg("probability_base"), 4).alias("mean_probability"),
        rnd(F.avg("width"), 4).alias("mean_width"), rnd(F.avg((F.col("p_low") >= 0.5).cast("double")), 4).alias("share_low_at_half"),
        rnd(F.avg((F.col("p_high") >= 0.5).cast("double")), 4).alias("share_high_at_half"),
    )
    return rows, summary


# The four standard specifications.
SPECIFICATIONS = (
    {"name": "logistic_baseline", "algorithm": "logistic", "imputer": "median", "scaler": "standard", "power": False, "outliers": "clip_iqr"},
    {"name": "logistic_power_knn", "algorithm": "logistic", "imputer": "knn", "scaler": "robust", "power": True, "outliers": "winsorize"},
    {"name": "random_forest_baseline", "algorithm": "random_forest", "imputer": "median", "scaler": "none", "power": False, "outliers": "clip_iqr"},
    {"name": "gradient_boosting_iterative", "algorithm": "gradient_boosting", "imputer": "iterative", "scaler": "none", "power": True, "outliers": "clip_iqr"},
)


def multiverse(
    df: DataFrame, key: str, target: str, features: Sequence[str], outlier_columns: Sequence[str] = (),
    specifications: Sequence[Mapping] = SPECIFICATIONS, seed: int = 42, trees: int = 40,
) -> DataFrame:
    """The same model question under several reasonable preparations, ranked by AUC. Imputation and scaling are learned on train rows."""
    data = materialize(df.select(*dict.fromkeys([key, target, *features, *outlier_columns])), "multiverse")

    def scenario(s: Mapping) -> DataFrame:
        rows = handle_outliers(data, outlier_columns, s["outliers"])[0] if outlier_columns and s["outliers"] else data
        t = train_classifier(
            rows, key, target, features, s["algorithm"], seed=seed, scaler=s["scaler"], trees=trees, imputer=s["imputer"], power=s["power"],
        )
        return materialize(t.metrics.select(
            F.lit(s["name"]).alias("scenario"), F.lit(s["algorithm"]).alias("algorithm"), F.lit(s["imputer"]).alias("imputer"),
            F.lit(s["outliers"]).alias("outliers"), F.lit(s["power"]).alias("power"), "roc_auc", "f1", "accuracy", "log_loss", "brier_score",
        ), "scenario")

    out = reduce(DataFrame.unionByName, side_by_side([partial(scenario, s) for s in specifications]))
    return out.orderBy(F.desc("roc_auc"), "scenario")


# --- explanation ------------------------------------------------------------------------------------


def linear_shap(trained: Trained, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Exact additive contributions of a linear or logistic pipeline on every row (long form) and per feature."""
    model: PipelineModel = trained.model
    last = model.stages[-1]
    if not hasattr(last, "coefficients"):
        raise ValueError("linear contributions need a linear or logistic model")
    ready = model.transform(rows.withColumn("label", F.lit(0.0)))
    x = vector_to_array("features")
    beta = [float(b) for b in last.coefficients.toArray()]
    names = _feature_names(ready, len(beta))
    slim = materialize(ready.select(key, x.alias("x")), "shap")
    means = slim.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(beta))]).first()
    # One contribution per source column: one-hot cells of a column are added up.
    groups: dict[str, list[int]] = {}
    for i, n in enumerate(names):
        groups.setdefault(n, []).append(i)
    base = float(last.intercept) + sum(b * (means[f"m{i}"] or 0.0) for i, b in enumerate(beta))
    parts = {n: sum(((F.col("x")[i] - (means[f"m{i}"] or 0.0)) * beta[i] for i in cells), F.lit(0.0)) for n, cells in groups.items()}
    raw = F.lit(float(last.intercept))
    for i, b in enumerate(beta):
        raw = raw + F.col("x")[i] * b
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), c.alias("contribution")) for n, c in parts.items()])
    long = slim.select(key, F.lit(base).alias("base"), raw.alias("output"), F.inline(cells))
    per = long.groupBy("feature").agg(
        rnd(F.avg(F.abs("contribution")), 4).alias("mean_abs"), rnd(F.stddev_pop("contribution"), 4).alias("std"),
        rnd(F.avg("contribution"), 4).alias("mean"),
    ).orderBy(F.desc("mean_abs"), "feature")
    return long, per


def _feature_names(ready: DataFrame, width: int) -> list[str]:
    """Source column of each cell of ``features``, read from the column's attribute metadata."""
    attributes = ready.schema["features"].metadata["ml_attr"]["attrs"]
    names = [""] * width
    number = [c[3:] for c in ready.columns if c.startswith("_n_")]
    texts = [c[3:] for c in ready.columns if c.startswith("_c_")]
    for group in attributes.values():
        for a in group:
            label = a.get("name", "")
            for prefix, columns in (("_scaled_", number), ("_numbers_", number)):
                if label.startswith(prefix) and label[len(prefix):].isdigit():
                    names[a["idx"]] = columns[int(label[len(prefix):])]
            if label.startswith("_n_"):
                names[a["idx"]] = label[3:]
            for c in texts:
                if label.startswith(f"_h_{c}_"):
                    names[a["idx"]] = c
    if "" in names:
        # Scalers drop attribute names: numbers come first, in order.
        free = iter(number)
        names = [n or next(free) for n in names]
    return names


def shap_check(long: DataFrame, key: str) -> DataFrame:
    """Base plus contributions against the model output; consistent below 1e-3 on average and 1e-2 at most."""
    per = long.groupBy(key).agg(F.sum("contribution").alias("s"), F.any_value("base").alias("b"), F.any_value("output").alias("o"))
    gap = F.abs(F.col("b") + F.col("s") - F.col("o"))
    one = per.agg(F.avg(gap).alias("m"), F.max(gap).alias("x"), count_rows().alias("rows"))
    return one.select(
        "rows", rnd(F.col("m"), 6).alias("mean_gap"), rnd(F.col("x"), 6).alias("max_gap"),
        ((F.col("m") <= 1e-3) & (F.col("x") <= 1e-2)).alias("is_consistent"),
    )


def top_row_explanation(long: DataFrame, key: str) -> DataFrame:
    """Contributions of the row with the highest output, largest first, with their direction."""
    best = long.orderBy(F.desc("output"), key).limit(1).select(F.col(key).alias("_k"))
    rows = long.join(F.broadcast(best), F.col(key) == F.col("_k")).drop("_k")
    return rows.select(
        key, "feature", rnd(F.col("contribution"), 4).alias("contribution"),
        F.when(F.col("contribution") >= 0, "raises").otherwise("lowers").alias("direction"),
    ).orderBy(F.desc(F.abs("contribution")), "feature")


# --- value models and forecasting ---------------------------------------------------------------------


def error_weights(rmse_weight: float) -> tuple[float, float]:
    """Weights of MAE and RMSE for the wanted ratio of RMSE to MAE; ratios near one count both alike."""
    if rmse_weight <= 0:
        raise ValueError("rmse_weight must be positive")
    # The band of ratios read as even.
    low, high = 0.85, 1.35
    ratio = 1.0 if low < rmse_weight < high else float(rmse_weight)
    return max(1.0, 1.0 / ratio), max(1.0, ratio)


def value_benchmark(
    df: DataFrame, key: str, target: str, features: Sequence[str], models: Sequence[str] = ("random_forest", "gradient_boosting"),
    rmse_weight: float = 1.8, test_size: float = 0.25, seed: int = 42, trees: int = 40,
) -> tuple[DataFrame, dict[str, Trained]]:
    """Models against the train median: errors, weighted min-max score and the champion."""
    data = materialize(df.select(*dict.fromkeys([key, target, *features])).where(num(target).isNotNull()), "value")
    train, test = split_by_key(data, key, test_size, seed)
    middle = quantiles(train, [target], [0.5])[target][0.5]
    naive = regression_metrics(test.withColumn("_naive", F.lit(middle)), target, "_naive").first()

    def trained(m: str) -> tuple[Trained, Row]:
        t = train_regressor(data, key, target, features, m, seed=seed, trees=trees, split=(train, test))
        return t, t.metrics.first()

    found = dict(zip(models, side_by_side([partial(trained, m) for m in models])))
    done, rows = {m: t for m, (t, _) in found.items()}, {m: r for m, (_, r) in found.items()}
    wa, wr = error_weights(rmse_weight)

    def scaled(metric: str, m: str) -> float:
        values = [r[metric] for r in rows.values()]
        spread = max(values) - min(values)
        return 0.0 if spread == 0 else (rows[m][metric] - min(values)) / spread

    table = []
    for m, r in rows.items():
        score = round(scaled("mae", m) * wa + scaled("rmse", m) * wr, 4)
        table.append((m, r["mae"], r["rmse"], r["smape"], round(r["mae"] / naive["mae"], 4) if naive["mae"] else None, round(r["rmse"] / max(r["mae"], 1e-8), 4), score))
    champion = min(table, key=lambda r: (r[6], r[2], r[1]))[0]
    table.append(("median_baseline", naive["mae"], naive["rmse"], naive["smape"], 1.0, round(naive["rmse"] / max(naive["mae"], 1e-8), 4), None))
    out = df.sparkSession.createDataFrame(
        [(*r, r[0] == champion) for r in table],
        "model string, mae double, rmse double, smape double, mae_vs_baseline double, rmse_mae_ratio double, score double, is_champion boolean",
    )
    return out.orderBy(F.asc_nulls_last("score"), "rmse", "mae"), done


def forecast_lags(
    df: DataFrame, series: Sequence[str], date: str, target: str, lags: int = 6, horizon: int = 3, seasonality: int = 12,
    algorithm: str = "linear", key: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """One lag regression over many series; each series' last ``horizon`` rows are held out in time order."""
    from .ordered import rank_within

    lagged, names = lag_features(df, target, series, [date, *key], lags, seasonality)
    ranked = rank_within(lagged, series, [F.col(date).desc(), *[F.col(k).desc() for k in key]], "_back")
    data = materialize(ranked.withColumn("label", num(target)), "forecast")
    train, test = data.where(F.col("_back") > horizon), data.where(F.col("_back") <= horizon)
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    model = Pipeline(stages=[vectors, regressor(algorithm)]).fit(train)
    out = model.transform(test).select(*series, date, F.col("label").alias("actual"), F.col("prediction").alias("predicted"))
    return out, regression_metrics(out, "actual", "predicted")


def forecast_differences(df: DataFrame, series: Sequence[str], date: str, target: str, horizon: int = 3, key: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Autoregression on first differences (the AR(1) part of an integrated model) over many series."""
    from .ordered import group_moving, rank_within

    def build(window):
        return {"_previous": F.lag(num(target)).over(window), "_before": F.lag(num(target), 2).over(window)}

    steps = group_moving(df, series, [date, *key], 3, build)
    steps = steps.withColumns({"label": num(target) - F.col("_previous"), "_d": F.col("_previous") - F.col("_before")}).dropna(subset=["label", "_d"])
    ranked = rank_within(steps, series, [F.col(date).desc(), *[F.col(k).desc() for k in key]], "_back")
    data = materialize(ranked, "differences")
    train, test = data.where(F.col("_back") > horizon), data.where(F.col("_back") <= horizon)
    model = Pipeline(stages=[VectorAssembler(inputCols=["_d"], outputCol="features"), LinearRegression()]).fit(train)
    out = model.transform(test).select(
        *series, date, num(target).alias("actual"), (F.col("_previous") + F.col("prediction")).alias("predicted")
    )
    return out, regression_metrics(out, "actual", "predicted")

