"""Whole analyses: the same operators in the order an analyst runs them.

Every stage hands DataFrames to the next one. Tables that several stages read are written once.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import hash_unit, numeric_columns, require_columns, require_rows, rnd, text_columns
from ..operators import activation, clean, describe, events, linear, models, quality, scoring, segments, stat_tests, value
from ..operators.impute import mice_impute
from ..session import materialize, side_by_side
from ..sources import io


@dataclass(frozen=True)
class Contract:
    """Column roles and parameters of a case; nothing is guessed from the data."""

    key: str
    target: str
    features: Sequence[str]
    date: str
    segments: Sequence[str]
    outlier_columns: Sequence[str] = ()
    vif_columns: Sequence[str] = ()
    memory_columns: Sequence[str] = ()
    value_target: str = "value_12m"
    value_features: Sequence[str] = ()
    group: str = "segment"
    sensitive: Mapping[str, Column] = field(default_factory=dict)
    models: Sequence[str] = ("logistic", "random_forest", "gradient_boosting")
    value_models: Sequence[str] = ("random_forest", "gradient_boosting")
    parsimony_steps: Sequence[int] = (4, 8, 12, 18)
    tolerance: float = 0.015
    test_size: float = 0.25
    seed: int = 42
    trees: int = 100
    horizons: Sequence[int] = (6, 12)
    contact_cost: float = 22.0
    success_rate: float = 0.28
    max_contact_share: float = 0.30
    rmse_weight: float = 1.8
    bootstrap_iterations: int = 40
    interval_alpha: float = 0.10
    folds: int = 4
    purge_days: int = 7
    embargo_days: int = 14
    epsilon: float = 0.10
    health: quality.HealthLimits = quality.HEALTH_PROFILES["demo"]
    segment_ks: Sequence[int] = (2, 3, 4, 5)


def build_dataset(df: DataFrame, c: Contract) -> dict[str, DataFrame]:
    """Fractional-memory features, audit, dictionary and summaries of the case table."""
    require_columns(df, [c.key, c.target, c.date, *c.features, *c.segments])
    require_rows(df)
    data = clean.fractional_difference(df, c.memory_columns, [c.date, c.key]) if c.memory_columns else df
    data = materialize(data, "dataset")
    tables = quality.audit(data, c.key, c.target, [c.key], [c.date], c.segments)
    texts = text_columns(data)
    tables.update(
        data=data,
        dictionary=quality.data_dictionary(data, c.key, [c.key], c.target, [c.date]),
        numeric=describe.numeric_summary(data, [n for n in numeric_columns(data) if n != c.key]),
        categorical=describe.category_modes(data, texts),
        target_balance=quality.target_balance(data, c.target),
        dataset_summary=quality.dataset_summary(data, c.target, tables["leakage"]),
    )
    return tables


def choose_model(data: DataFrame, c: Contract) -> tuple[str, list[str], dict[str, DataFrame], models.Trained | None]:
    """Benchmark, nested logistic study and the simple model when it is close enough; the benchmark's fit where it is the choice."""
    (table, done, failed), study = side_by_side([
        lambda: models.benchmark(data, c.key, c.target, c.features, c.models, "classification", c.test_size, c.seed, c.trees),
        lambda: models.parsimony_study(data, c.key, c.target, c.features, c.parsimony_steps, c.test_size, c.seed),
    ])
    best = table.first()
    simple = study["summary"].first()
    name, features = best["model"], list(c.features)
    if best["roc_auc"] - simple["roc_auc"] <= c.tolerance:
        name, features = "logistic", list(study["recommended"])
    skipped = data.sparkSession.createDataFrame(list(failed.items()), "model string, reason string")
    return name, features, {"benchmark": table, "parsimony": study["summary"], "ensemble_metrics": study["ensemble_metrics"], "skipped": skipped}, done.get(name) if features == list(c.features) else None


def bi_run(
    data: DataFrame, c: Contract, algorithm: str, features: Sequence[str], audit: Mapping[str, DataFrame] | None = None
) -> tuple[models.Trained, dict[str, DataFrame]]:
    """Source audit (reused when given), cleaning, tests on the clean table, model with explanation, inference, conclusions."""
    source = audit or quality.audit(data, c.key, c.target, [c.key], [c.date], c.segments)
    tidy, treated = clean.etl(data, c.outlier_columns) if c.outlier_columns else (data, None)
    tidy = materialize(tidy, "tidy")
    collinear = linear.collinearity(tidy, c.vif_columns)
    trained = models.train_classifier(tidy, c.key, c.target, features, algorithm, c.test_size, c.seed, trees=c.trees)
    groups = stat_tests.compare_groups(tidy, c.value_target, c.group)
    regression = linear.ols(tidy, c.value_target, [f for f in c.vif_columns if f != c.value_target])
    out = {
        **{f"audit_{k}": v for k, v in source.items()},
        "eda_numeric": describe.numeric_summary(tidy, c.vif_columns),
        "eda_categorical": describe.categorical_summary(tidy, text_columns(tidy)),
        "eda_normality": stat_tests.normality(tidy, c.value_target),
        "eda_transforms": clean.compare_power_transforms(tidy, c.value_target),
        "eda_variances": stat_tests.variance_homogeneity(tidy, c.value_target, c.group),
        "eda_pair": stat_tests.correlation_test(tidy, next((v for v in c.vif_columns if v != c.value_target), c.vif_columns[0]), c.value_target),
        "eda_correlation": describe.correlation_matrix(tidy, c.vif_columns, "spearman"),
        "vif": collinear["vif"], "model_metrics": trained.metrics, "group_test": groups, "ols": regression.coefficients,
        "ols_fit": regression.fit_stats,
    }
    if treated is not None:
        out["outliers"] = treated
    if algorithm == "logistic":
        long, out["contributions"] = models.linear_shap(trained, tidy, c.key)
        out["contribution_check"] = models.shap_check(long, c.key)
        out["top_row"] = models.top_row_explanation(long, c.key)
    out["conclusions"] = conclusions(out)
    return trained, out


def conclusions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per finding that holds: ``phase``, ``finding``, ``impact`` and ``action``.

    The model's row is about ROC AUC, else F1, else R2, whichever its metrics have.
    """
    spark = tables["model_metrics"].sparkSession

    def line(df: DataFrame, phase: str, finding: Column, impact: Column, action: str) -> DataFrame:
        return df.select(F.lit(phase).alias("phase"), finding.alias("finding"), impact.alias("impact"), F.lit(action).alias("action"))

    def where_any(name: str, phase: str, finding: str, impact: str, action: str, condition: str = "true") -> list[DataFrame]:
        rows = [tables[name].where(condition).limit(1)] if name in tables else []
        return [line(df, phase, F.lit(finding), F.lit(impact), action) for df in rows]

    advice = {
        "roc_auc": "use the score to order contacts, beside business judgement",
        "f1": "review the threshold and the cost of each error",
        "r2": "compare the expected error with what the business tolerates",
    }
    metric = next(m for m in advice if m in tables["model_metrics"].columns)
    value = F.col(metric).cast("double")
    rows = [
        *where_any("audit_high_null_columns", "ingest", "columns with many nulls", "indicators may be biased by the way values go missing", "study why values are missing, then set imputation rules"),
        *where_any("audit_leakage", "ingest", "columns that may leak the target", "measured quality may not hold on new data", "check when each column is known and drop the late ones"),
        *where_any("vif", "eda", "relevant collinearity", "coefficients are unstable", "drop or group redundant columns, or regularise", "vif >= 5"),
        line(tables["model_metrics"], "model", F.format_string(metric + " = %.4f", value), scoring.metric_reading(F.lit(metric), value), advice[metric]),
        line(tables["group_test"], "inference", F.format_string("%s with p = %.4f", "test", F.col("p_value").cast("double")), scoring.metric_reading(F.lit("p_value"), F.col("p_value")), "weigh the effect size before a policy changes"),
        line(spark.range(1), "governance", F.lit("cleaning, tests, model and inference are traceable"), F.lit("the analysis can be repeated"), "monitor drift, calibration and data quality"),
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def methodology_run(
    data: DataFrame, c: Contract, algorithm: str, features: Sequence[str], observed_at: Column, expected_rows: int | None = None,
    audit: Mapping[str, DataFrame] | None = None, fitted_model: models.Trained | None = None,
) -> dict[str, DataFrame]:
    """Snapshot drift, health gate, tests, feature ranking, robustness, time folds, uncertainty, fairness and flags.

    ``fitted_model`` is a fit of the same rows, features and settings, if there is one already.
    """
    spark = data.sparkSession
    reference, current = (materialize(p, "snapshot") for p in quality.time_split(data, c.date, 0.65, c.key))
    numeric, _ = models.feature_kinds(data, features)
    source = audit or quality.audit(data, c.key, c.target, [c.key], [c.date], c.segments)
    out = {f"audit_{k}": v for k, v in source.items()}
    out["mcar"] = quality.little_mcar(data, numeric)
    drift = quality.dataset_drift(reference, current, [*features, c.target])
    out.update({f"drift_{k}": v for k, v in drift.items()})
    required = [f for f in [*features, c.target] if not f.endswith("_fracdiff")]
    health = quality.pipeline_health(current, "case", c.date, required, observed_at, expected_rows or reference.count(), c.health)
    out["health"], out["gate"] = health, quality.execution_gate(health, "case")
    decision = health.first()["decision"]
    out["normality"] = stat_tests.normality(data, c.vif_columns[0])
    collinear = linear.collinearity(data, c.vif_columns)
    out["vif"], out["critical_components"] = collinear["vif"], collinear["critical"]
    out["correlation"] = stat_tests.correlation_test(data, c.vif_columns[0], c.value_target, "auto")
    out["simpson"] = stat_tests.simpson_verdict(stat_tests.simpson_groups(data, c.vif_columns[0], c.value_target, c.group))
    out["groups"] = stat_tests.compare_groups(data, c.value_target, c.group)
    fitted = linear.ols(data, c.value_target, [f for f in c.vif_columns if f != c.value_target])
    out["ols"] = fitted.coefficients
    out.update({f"dispersion_{k}": v for k, v in linear.dispersion_audit(fitted).items()})
    facts: dict[str, float | bool | str | None] = {
        "is_mcar_compatible": out["mcar"].first()["is_mcar_compatible"], "is_normal": out["normality"].first()["is_normal"],
        "features_dropped": len(c.features) - len(features), "decision": decision,
        "severe_drift_columns": drift["drift"].where("is_severe").count(),
        "top_vif": out["vif"].agg(F.max("vif")).first()[0],
        "top_condition_index": collinear["components"].agg(F.max("condition_index")).first()[0],
        "critical_components": out["critical_components"].count(), "paradox": out["simpson"].first()["paradox"],
        "sampling_alerts": out["audit_sampling"].where("is_dominated or has_rare").count(),
    }
    out["tabular_alerts"] = quality.tabular_alerts(source)
    facts["tabular_alerts"] = sum(out["tabular_alerts"].first())
    if decision != "blocked":
        simple = algorithm if algorithm != "mlp" else "logistic"
        # Independent of one another, so their jobs run side by side.
        out["rfe"], out["multiverse"], (out["folds"], out["temporal"]), (out["intervals"], out["uncertainty"]), trained = side_by_side([
            lambda: models.recursive_elimination(data, c.key, c.target, features, min(6, len(features))),
            lambda: models.multiverse(data, c.key, c.target, features, c.outlier_columns, seed=c.seed, trees=c.trees),
            lambda: models.purged_validation(
                data, c.key, c.target, features, c.date, algorithm, c.folds, c.purge_days, c.embargo_days, c.seed
            ),
            lambda: models.bootstrap_intervals(
                data, c.key, c.target, features, c.date, simple, c.bootstrap_iterations, c.interval_alpha, c.seed
            ),
            lambda: fitted_model or models.train_classifier(data, c.key, c.target, features, algorithm, c.test_size, c.seed, trees=c.trees),
        ])
        scored = trained.predictions
        out["calibration"] = scoring.calibration_gaps(scored, "actual", "probability")
        facts["brier_score"] = trained.metrics.first()["brier_score"]
        facts["folds"], facts["std_roc_auc"] = out["folds"].count(), out["temporal"].first()["std_roc_auc"]
        facts["mean_interval_width"] = out["uncertainty"].first()["mean_width"]
        if c.sensitive:
            # The sensitive columns come from the source table by key, whether or not the model used them.
            named = data.select(c.key, *[e.alias(f"_s_{n}") for n, e in c.sensitive.items()])
            joined = scored.join(named, c.key)
            out["fairness_groups"] = scoring.fairness_groups(joined, {n: F.col(f"_s_{n}") for n in c.sensitive}, "actual", "predicted", "probability")
            out["fairness"] = scoring.fairness_summary(out["fairness_groups"])
            gaps = [F.max(f"{g}_difference") for g in ("demographic_parity", "equal_opportunity", "equalized_odds")]
            facts["fairness_max_gap"] = out["fairness"].agg(F.greatest(*gaps)).first()[0]
    out["risk_flags"] = quality.risk_flags(spark, facts)
    return out


def activation_run(data: DataFrame, c: Contract, predictions: DataFrame) -> dict[str, DataFrame]:
    """Customer value, value model, contact threshold, scorecard, gaps, bandit and segments of the scored customers.

    ``data`` carries frequency, recency, age and monetary; ``predictions`` is keyed like it.
    """
    valued = materialize(value.clv_shrinkage(data, c.horizons), "valued")
    low, high = f"clv_{min(c.horizons)}m", f"clv_{max(c.horizons)}m"
    compared, fitted = models.value_benchmark(
        valued, c.key, c.value_target, c.value_features or c.features, c.value_models, c.rmse_weight, c.test_size, c.seed, c.trees
    )
    champion = fitted[compared.where("is_champion").first()["model"]]
    if champion.model is not None:
        scored = champion.model.transform(valued.withColumn("label", F.lit(0.0))).select(c.key, rnd(F.col("prediction"), 2).alias("model_value"))
        valued = valued.join(scored, c.key).withColumn("value_gap_vs_model", value.relative_gap(F.col(high), F.col("model_value")))
    known = [n for n in valued.columns if n not in ("actual", "probability", "predicted")]
    rows = materialize(valued.select(*known).join(predictions.select(c.key, "actual", "probability"), c.key), "scored")
    sweep = activation.threshold_sweep(rows, "actual", "probability", high, c.contact_cost, c.success_rate)
    chosen = activation.recommended_threshold(sweep, c.max_contact_share)
    card = activation.retention_scorecard(
        rows, chosen.first()["threshold"], "probability", high, low, contact_cost=c.contact_cost, success_rate=c.success_rate
    )
    card = materialize(activation.consensus_gap(card, c.group, "probability", "expected_contact_value"), "card")
    policy = activation.bandit_policy(card, "offer", "expected_contact_value", c.epsilon)
    columns = ["probability", "expected_contact_value", low, "priority_score"]
    matrix = segments.segment_matrix(card, columns)
    options = segments.kmeans_options(matrix, c.segment_ks, c.seed)
    best_k = options.first()["k"]
    segmented = materialize(segments.kmeans_segments(matrix, best_k, c.seed).drop("features"), "segmented")
    profile = activation.rank_labels(
        segmented.groupBy("cluster_id").agg(
            F.count("*").alias("customers"), rnd(F.avg("probability"), 3).alias("probability"), rnd(F.avg("p_alive"), 3).alias("p_alive"),
            rnd(F.avg("expected_contact_value"), 3).alias("expected_contact_value"), rnd(F.avg(low), 3).alias(low),
            rnd(F.avg("priority_score"), 3).alias("priority_score"),
        ),
        low, "probability",
    )
    # One row per cluster.
    named = segmented.join(F.broadcast(profile.select("cluster_id", "segment_name")), "cluster_id")
    out = {
        "valued": valued, "clv_summary": value.clv_summary(valued, max(c.horizons)), "value_models": compared, "thresholds": sweep,
        "recommended_threshold": chosen, "scorecard": named, "shortlist": activation.shortlist(card, c.key),
        "risk_summary": activation.risk_segment_summary(card, c.group, high),
        "consensus": activation.consensus_summary(card, c.group, "probability", "expected_contact_value"),
        "bandit": policy, "bandit_summary": activation.bandit_summary(policy), "segment_options": options, "segment_profile": profile,
        "playbook": activation.segment_playbook(named, "segment_name", "probability", low),
    }
    out.update({f"dashboard_{k}": v for k, v in activation.dashboard_tables(card, c.group).items()})
    return out


def case_run(df: DataFrame, c: Contract, observed_at: Column, output: str | None = None, run_id: str | None = None) -> dict[str, dict[str, DataFrame]]:
    """The full case: dataset, model choice, BI layer, methodology, activation, summary; optionally written with a run log."""
    dataset = build_dataset(df, c)
    data = dataset["data"]
    audit = {k: v for k, v in dataset.items() if k != "data"}
    name, features, selection, fitted = choose_model(data, c)

    def acted() -> tuple[models.Trained, dict[str, DataFrame], dict[str, DataFrame]]:
        trained, bi = bi_run(data, c, name, features, audit)
        return trained, bi, activation_run(data, c, trained.predictions)

    (trained, bi, active), checks = side_by_side(
        [acted, lambda: methodology_run(data, c, name, features, observed_at, audit=audit, fitted_model=fitted)]
    )
    summary = io.execution_summary(
        [
            trained.metrics.select(F.lit(name).alias("champion_model"), "roc_auc", "log_loss", "brier_score"),
            checks["health"].select("decision"),
            active["recommended_threshold"].select("threshold", "roi", "net_value"),
            active["scorecard"].agg(F.sum("contact").alias("prioritised")),
            active["segment_options"].select(F.col("k").alias("best_k"), F.col("silhouette").alias("best_silhouette")),
            active["bandit"].select(F.col("arm").alias("recommended_arm")),
        ]
    )
    parts = {"dataset": dataset, "selection": selection, "bi": bi, "methodology": checks, "activation": active, "summary": {"summary": summary}}
    if output:
        run = run_id or uuid.uuid4().hex
        for stage, tables in parts.items():
            io.write_tables({k: v for k, v in tables.items() if isinstance(v, DataFrame)}, output, stage, run)
        metrics = summary.first().asDict()
        io.append_run_log(df.sparkSession, output, run, {"target": c.target, "seed": c.seed, "test_size": c.test_size, "features": len(features), "models": ",".join(c.models)}, metrics)
    return parts


def event_run(df: DataFrame, event: str, key: str, target: str, position: str, features: Sequence[str], outlier_columns: Sequence[str], **training) -> dict[str, DataFrame]:
    """Audit, cleaning, normality, transforms, collinearity, correlation, a model over whole events with its ranking
    metrics and prediction board, and the comparison of winners with the others.

    ``key`` names a competitor, who may come back in other events. The first numeric feature is the one examined.
    """
    # Written once; clipping is a projection, so the clean rows are read from the same table.
    df = materialize(df, "events")
    audit = quality.audit(df, key, target, [key])
    tidy, treated = clean.handle_outliers(df, outlier_columns, "clip_iqr")
    numeric = [f for f in features if f in numeric_columns(df)]
    scored, metrics = events.train_event_model(tidy, event, key, target, features, **training)
    # A competitor may come back in other events, so the event is part of the key.
    scored = materialize(scored.join(tidy.select(event, key, position), [event, key]), "scored_events")
    per_event = materialize(events.event_metrics(scored, event, key, "actual", "competitive_probability"), "per_event")
    board = events.event_board(scored, event, key, "competitive_probability", position)
    return {
        "audit_summary": audit["summary"], "outliers": treated, "vif": linear.collinearity(tidy, numeric)["vif"],
        "normality": stat_tests.normality(tidy, numeric[0]), "transforms": clean.compare_power_transforms(tidy, numeric[0]),
        "correlation": stat_tests.correlation_test(tidy, numeric[1 % len(numeric)], numeric[0]),
        "winners": stat_tests.compare_groups(tidy, numeric[0], target),
        "binary_metrics": metrics, "event_metrics": events.event_metric_means(per_event), "event_report": per_event, "board": board,
        "tickets": events.event_tickets(board),
    }


def base_run(df: DataFrame, key: str, target: str, features: Sequence[str], value_column: str, group: str, outlier_columns: Sequence[str]) -> dict[str, DataFrame]:
    """The short analysis: audit, outliers, normality, transform, collinearity, correlation, model, group test, OLS."""
    numeric = [f for f in features if f in numeric_columns(df)]
    tidy, treated = clean.handle_outliers(materialize(df, "base"), outlier_columns, "clip_iqr")
    tidy = materialize(tidy, "base_clean")
    trained = models.train_classifier(tidy, key, target, features)
    return {
        "audit_summary": quality.audit(df, key, target, [key])["summary"], "outliers": treated,
        "normality": stat_tests.normality(tidy, value_column), "transforms": clean.compare_power_transforms(tidy, value_column),
        "vif": linear.collinearity(tidy, numeric)["vif"], "correlation": stat_tests.correlation_test(tidy, numeric[0], value_column, "auto"),
        "model_metrics": trained.metrics, "group_test": stat_tests.compare_groups(tidy, value_column, group),
        "ols": linear.ols(tidy, value_column, [f for f in numeric if f != value_column]).coefficients,
    }


def universal_run(df: DataFrame, c: Contract, observed_at: Column) -> dict[str, DataFrame]:
    """The full methodology on clipped and iteratively imputed data: every check and model."""
    numeric, _ = models.feature_kinds(df, c.features)
    tidy, treated = clean.handle_outliers(materialize(df, "universal"), c.outlier_columns or numeric, "clip_iqr")
    # Learned on the rows that every split of this seed trains on.
    filled, _ = mice_impute(tidy, numeric, fit_on=hash_unit(c.key, c.seed) >= c.test_size)
    out = methodology_run(filled, c, "logistic", c.features, observed_at)
    out["outliers"] = treated
    out["transforms"] = clean.compare_power_transforms(filled, c.value_target)
    return out
