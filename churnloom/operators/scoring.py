"""Metrics of scores that already exist: classification, regression, calibration, fairness, time folds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clip, count_rows, num, rnd
from ..session import materialize
from .ordered import cumulative, running_sums
from .quantiles import bin_of, distinct_edges, quantiles


def roc_auc(df: DataFrame, actual: str, probability: str, digits: int = 4) -> DataFrame:
    """Area under the ROC curve from counts per distinct score, ties counted half."""
    label = F.col(actual).cast("int")
    counts = (
        df.where(num(probability).isNotNull() & label.isNotNull())
        .groupBy(num(probability).alias("p"))
        .agg(F.sum(label).cast("bigint").alias("pos"), F.sum(1 - label).cast("bigint").alias("neg"))
    )
    ranked = cumulative(counts, ["p"], ["neg"])
    wins = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.when(pairs > 0, rnd(wins / pairs, digits)).alias("roc_auc"),
    )


def score_metrics_by(df: DataFrame, by: Sequence[str], actual: str, probability: str, digits: int = 4) -> DataFrame:
    """``roc_auc``, ``log_loss`` and ``brier_score`` of every group, from one table of counts per group and distinct score."""
    p, y = num(probability), F.col(actual).cast("int")
    inner = clip(F.col("p"), 1e-15, 1 - 1e-15)
    counts = (
        df.where(p.isNotNull() & y.isNotNull()).groupBy(*by, p.alias("p"))
        .agg(F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg"))
    )
    ranked, _ = running_sums(counts, by, ["p"], ["neg"])
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    n = F.sum(F.col("pos") + F.col("neg"))
    lost = F.col("pos") * F.log(inner) + F.col("neg") * F.log(1 - inner)
    off = F.col("pos") * (1 - F.col("p")) * (1 - F.col("p")) + F.col("neg") * F.col("p") * F.col("p")
    return ranked.groupBy(*by).agg(
        F.when(pairs > 0, rnd(F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0)) / pairs, digits)).alias("roc_auc"),
        rnd(-F.sum(lost) / n, digits).alias("log_loss"), rnd(F.sum(off) / n, digits).alias("brier_score"),
    )


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    a, b = F.col(actual).cast("int"), F.col(predicted).cast("int")
    return df.groupBy(a.alias("actual"), b.alias("predicted")).agg(count_rows().alias("rows"))


def confusion_metrics(df: DataFrame, actual: str, predicted: str, digits: int = 4) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1; undefined ratios count as zero."""
    counts = confusion_counts(df, actual, predicted)
    n = F.col("rows")
    a = counts.groupBy(F.col("actual").alias("k")).agg(F.sum(n).alias("support"), F.sum(F.when(F.col("actual") == F.col("predicted"), n).otherwise(0)).alias("hits"))
    b = counts.groupBy(F.col("predicted").alias("k")).agg(F.sum(n).alias("chosen"))
    per = a.join(b, "k", "left").withColumns(
        {
            "precision": F.when(F.col("chosen") > 0, F.col("hits") / F.col("chosen")).otherwise(0.0),
            "recall": F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0),
        }
    )
    both = F.col("precision") + F.col("recall")
    per = per.withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0))
    total = F.sum("support")
    return per.agg(
        total.alias("rows"), rnd(F.sum("hits") / total, digits).alias("accuracy"),
        *[rnd(F.sum(F.col(c) * F.col("support")) / total, digits).alias(c) for c in ("precision", "recall", "f1")],
    )


def probability_losses(df: DataFrame, actual: str, probability: str, digits: int = 4) -> DataFrame:
    y = F.col(actual).cast("double")
    p = clip(num(probability), 1e-15, 1 - 1e-15)
    loss = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    return df.agg(
        rnd(F.avg(loss), digits).alias("log_loss"),
        rnd(F.avg((num(probability) - y) * (num(probability) - y)), digits).alias("brier_score"),
    )


def classification_metrics(df: DataFrame, actual: str, probability: str, predicted: str | None = None, threshold: float = 0.5) -> DataFrame:
    """One row with all classification metrics; the scores are written once and read three times."""
    label = F.col(predicted) if predicted else (num(probability) >= threshold).cast("int")
    slim = materialize(
        df.select(F.col(actual).cast("int").alias("a"), num(probability).alias("p"), label.cast("int").alias("c")), "scores"
    )
    return (
        confusion_metrics(slim, "a", "c")
        .crossJoin(roc_auc(slim, "a", "p").select("roc_auc"))
        .crossJoin(probability_losses(slim, "a", "p"))
    )


def regression_columns(y: Column, p: Column, digits: int = 4) -> list[Column]:
    """The aggregates of ``regression_metrics`` for two number columns without nulls."""
    e = y - p
    scale = F.greatest((F.abs(y) + F.abs(p)) / 2, F.lit(1e-6))
    return [
        F.count(e).alias("rows"), rnd(F.avg(F.abs(e)), digits).alias("mae"), rnd(F.sqrt(F.avg(e * e)), digits).alias("rmse"),
        rnd(F.when(F.var_pop(y) > 0, 1 - F.avg(e * e) / F.var_pop(y)), digits).alias("r2"),
        rnd(F.avg(-e), digits).alias("mean_error"), rnd(F.avg(F.abs(e) / scale) * 100, digits).alias("smape"),
    ]


def regression_metrics(df: DataFrame, actual: str, predicted: str, digits: int = 4) -> DataFrame:
    y, p = num(actual), num(predicted)
    return df.where(y.isNotNull() & p.isNotNull()).agg(*regression_columns(y, p, digits))


def reliability_curve(df: DataFrame, actual: str, probability: str, bins: int = 10) -> DataFrame:
    """Mean score and observed rate in equal-width bins of the score."""
    p = clip(num(probability), 1e-6, 1 - 1e-6)
    b = F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int")
    return df.where(p.isNotNull()).groupBy(b.alias("bin")).agg(
        count_rows().alias("rows"), rnd(F.avg(p), 4).alias("mean_probability"),
        rnd(F.avg(F.col(actual).cast("double")), 4).alias("observed_rate"),
    ).orderBy("bin")


def calibration_gaps(df: DataFrame, actual: str, probability: str, bins: int = 10) -> DataFrame:
    """Observed minus predicted rate in equal-frequency bins of the score."""
    data = df.select(clip(num(probability), 1e-6, 1 - 1e-6).alias("p"), F.col(actual).cast("double").alias("y"))
    levels = data.select("p").distinct().limit(bins).count()
    q = quantiles(data, ["p"], [i / min(bins, levels) for i in range(min(bins, levels) + 1)])["p"]
    edges = distinct_edges(q.values())
    gap = F.avg("y") - F.avg("p")
    return data.groupBy(bin_of(F.col("p"), edges).alias("bin")).agg(
        count_rows().alias("rows"), rnd(F.avg("p"), 4).alias("mean_probability"),
        rnd(F.avg("y"), 4).alias("observed_rate"), rnd(gap, 4).alias("calibration_gap"),
    ).orderBy("bin")


def fairness_groups(df: DataFrame, features: Mapping[str, Column], actual: str, predicted: str, probability: str) -> DataFrame:
    """Selection and error rates per group of each sensitive feature (null is its own group)."""
    y, c, p = F.col(actual).cast("int"), F.col(predicted).cast("int"), num(probability)
    groups = F.array(*[F.struct(F.lit(n).alias("feature"), F.coalesce(e.cast("string"), F.lit("<NA>")).alias("group")) for n, e in features.items()])
    rows = df.select(F.explode(groups).alias("g"), y.alias("y"), c.alias("c"), p.alias("p")).select("g.*", "y", "c", "p")
    pos, neg = F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)
    tp, fp = F.count_if((F.col("y") == 1) & (F.col("c") == 1)), F.count_if((F.col("y") == 0) & (F.col("c") == 1))
    return rows.groupBy("feature", "group").agg(
        count_rows().alias("support"), F.avg("c").alias("_selection"), F.avg("y").alias("_actual"), F.avg("p").alias("_mean"),
        F.when(pos > 0, tp / pos).alias("_tpr"), F.when(neg > 0, fp / neg).alias("_fpr"),
    ).select(
        "feature", "group", "support", rnd(F.col("_selection"), 4).alias("selection_rate"),
        rnd(F.col("_actual"), 4).alias("actual_rate"), rnd(F.col("_mean"), 4).alias("mean_probability"),
        rnd(F.col("_tpr"), 4).alias("tpr"), rnd(F.col("_fpr"), 4).alias("fpr"),
        rnd(F.abs(F.col("_mean") - F.col("_actual")), 4).alias("calibration_gap"),
    )


def fairness_summary(groups: DataFrame) -> DataFrame:
    """Parity, equal-opportunity and equalised-odds gaps per feature."""
    spread = lambda c: F.when(F.count(c) >= 2, F.max(c) - F.min(c))
    tpr, fpr = spread("tpr"), spread("fpr")
    return groups.groupBy("feature").agg(
        count_rows().alias("groups"),
        rnd(F.max("selection_rate") - F.min("selection_rate"), 4).alias("demographic_parity_difference"),
        F.when(F.max("selection_rate") > 0, rnd(F.min("selection_rate") / F.max("selection_rate"), 4)).alias("demographic_parity_ratio"),
        rnd(tpr, 4).alias("equal_opportunity_difference"),
        rnd(F.greatest(tpr, fpr), 4).alias("equalized_odds_difference"),
    )


def date_blocks(df: DataFrame, date: str, blocks: int) -> DataFrame:
    """Distinct days split into equal runs; earlier blocks take the remainder. One row per block.

    Distinct days number in the thousands, so the ordering of days is small.
    """
    days = df.where(F.col(date).isNotNull()).groupBy(F.to_date(date).alias("day")).agg(count_rows().alias("n"))
    numbered = days.withColumn("block", F.ntile(blocks).over(Window.orderBy("day")))
    return numbered.groupBy("block").agg(
        F.min("day").alias("start"), F.max("day").alias("end"), count_rows().alias("days"), F.sum("n").alias("rows")
    )


def purged_folds(
    df: DataFrame, date: str, target: str, blocks: int = 4, purge_days: int = 7, embargo_days: int = 14, two_sided: bool = False
) -> DataFrame:
    """Row counts of each purged time fold, from counts per day instead of row ranges.

    Training uses rows before the block minus the purge; ``two_sided`` adds rows after the embargo.
    """
    day = F.to_date(date)
    daily = df.where(F.col(date).isNotNull() & F.col(target).isNotNull()).groupBy(day.alias("day")).agg(
        count_rows().alias("n"), F.sum(num(target)).alias("pos")
    )
    folds = date_blocks(df.where(F.col(target).isNotNull()), date, blocks).select("block", "start", "end").collect()
    bounds = F.array(*[F.struct(F.lit(r["block"]).alias("block"), F.lit(r["start"]).alias("start"), F.lit(r["end"]).alias("end")) for r in folds])
    cut, stop = F.date_sub("start", purge_days), F.date_add("end", embargo_days)
    d, n = F.col("day"), F.col("n")
    train = d < cut
    if two_sided:
        train = train | (d > stop)
    test = (d >= F.col("start")) & (d <= F.col("end"))

    def rows(condition: Column, what: Column = n) -> Column:
        return F.coalesce(F.sum(F.when(condition, what)), F.lit(0))

    # One row per day and fold: a few thousand days times a handful of folds.
    return (
        daily.select("*", F.inline(bounds))
        .groupBy("block", "start", "end")
        .agg(
            rows(train).alias("n_train"), rows(train, F.col("pos")).cast("bigint").alias("train_positives"),
            rows(test).alias("n_test"), rows(test, F.col("pos")).cast("bigint").alias("test_positives"),
            rows((d >= cut) & (d < F.col("start"))).alias("purged_rows"),
            rows((d > F.col("end")) & (d <= stop)).alias("embargoed_rows"),
        )
        .withColumn(
            "is_valid",
            (F.col("n_train") >= 80) & (F.col("n_test") >= 20)
            & F.col("train_positives").between(1, F.col("n_train") - 1) & F.col("test_positives").between(1, F.col("n_test") - 1),
        )
    )


def temporal_summary(fold_metrics: DataFrame) -> DataFrame:
    return fold_metrics.agg(
        count_rows().alias("n_folds"), rnd(F.avg("roc_auc"), 4).alias("mean_roc_auc"),
        rnd(F.stddev_pop("roc_auc"), 4).alias("std_roc_auc"), rnd(F.avg("log_loss"), 4).alias("mean_log_loss"),
        rnd(F.avg("brier_score"), 4).alias("mean_brier_score"),
    )


# Lower cut points of strong and useful readings per metric.
METRIC_BANDS = {"roc_auc": (0.8, 0.7), "f1": (0.75, 0.6), "r2": (0.7, 0.4)}


def metric_reading(metric: Column, value: Column) -> Column:
    """Strong, useful or weak per metric; VIF and p-values read the other way round."""
    out = F.when(metric == "p_value", F.when(value < 0.01, "very strong evidence").when(value < 0.05, "enough evidence").otherwise("insufficient evidence"))
    out = out.when(metric == "vif", F.when(value >= 10, "severe").when(value >= 5, "relevant").otherwise("manageable"))
    out = out.when(metric == "mae_vs_baseline", F.when(value < 1, "better than baseline").otherwise("not better than baseline"))
    for name, (strong, useful) in METRIC_BANDS.items():
        out = out.when(metric == name, F.when(value >= strong, "strong").when(value >= useful, "useful").otherwise("weak"))
    return out.otherwise("compare with the cost of an error")


def unpivot_metrics(one_row: DataFrame, names: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    long = one_row.select(F.inline(cells))
    return long.withColumn("reading", metric_reading(F.col("metric"), F.col("value")))
