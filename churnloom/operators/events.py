"""Competitors ranked inside events: probabilities, ranking metrics, prediction boards, training.

Group results come from combining aggregations, top places from a limited window that Spark prunes
before the shuffle, so one very large event does not gather in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clip, count_rows, hash_unit, logit, num, numeric_columns, require_columns, rnd, text_columns
from ..session import materialize
from .clean import preprocessing_stages
from .scoring import classification_metrics
from .skew import GROUP_ROWS, largest_group, with_group_values


def event_softmax(df: DataFrame, event: str, score: str, temperature: float = 1.0, name: str = "probability") -> DataFrame:
    """Stable softmax of the scores inside each event; a null score or event raises."""
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    scaled = num(score) / temperature
    missing = F.raise_error(F.lit("null score or event in event_softmax"))
    guarded = F.when(scaled.isNull() | F.col(event).isNull(), missing.cast("double")).otherwise(scaled)
    small = largest_group(df, [event]) <= GROUP_ROWS
    peaked = with_group_values(df, [event], {"_peak": F.max(guarded)}, small)
    shifted = peaked.withColumn("_e", F.exp(scaled - F.col("_peak")))
    out = with_group_values(shifted, [event], {"_total": F.sum("_e")}, small)
    return out.withColumn(name, F.col("_e") / F.col("_total")).drop("_peak", "_e", "_total")


def top_places(df: DataFrame, event: str, order: Sequence[Column], k: int, name: str = "place") -> DataFrame:
    """The first ``k`` rows of each event; Spark keeps at most ``k`` per event and task before shuffling."""
    place = F.row_number().over(Window.partitionBy(event).orderBy(*order))
    return df.withColumn(name, place).where(F.col(name) <= k)


def event_metrics(df: DataFrame, event: str, key: str, target: str, probability: str, k: int = 3) -> DataFrame:
    """Per event with two or more rows and exactly one winner: rank, hits, log-loss, Brier, NDCG@k.

    Ranks break ties by key. NDCG averages the discount over rows tied with the winner.
    """
    require_columns(df, [event, key, target, probability])
    p = clip(num(probability), 1e-12, 1.0)
    rows = df.where(F.col(event).isNotNull() & F.col(target).isNotNull() & num(probability).isNotNull()).select(
        event, F.col(key).alias("_key"), F.col(target).cast("int").alias("_t"), p.alias("_p")
    )
    win = F.col("_t") == 1
    heads = {
        "field_size": count_rows(), "_winners": F.sum("_t"), "_wp": F.max(F.when(win, F.col("_p"))), "_wk": F.max(F.when(win, F.col("_key"))),
        "_brier": F.avg((F.col("_p") - F.col("_t")) * (F.col("_p") - F.col("_t"))),
    }
    joined = with_group_values(rows, [event], heads).where((F.col("field_size") >= 2) & (F.col("_winners") == 1))
    higher, same = F.col("_p") > F.col("_wp"), F.col("_p") == F.col("_wp")
    counted = joined.groupBy(event).agg(
        F.any_value("field_size").alias("field_size"), F.any_value("_wp").alias("_wp"), F.any_value("_brier").alias("_brier"),
        F.count_if(higher).alias("_above"), F.count_if(same).alias("_tied"),
        F.count_if(same & (F.col("_key") < F.col("_wk"))).alias("_before"),
    )
    rank = F.col("_above") + F.col("_before") + 1
    top = F.least(F.lit(k), F.col("field_size"))
    gains = sum(
        (
            F.when((F.col("_above") < i) & (F.col("_above") + F.col("_tied") >= i) & (top >= i), F.lit(1.0) / F.log2(F.lit(1.0 + i)))
            .otherwise(0.0)
            for i in range(1, k + 1)
        ),
        F.lit(0.0),
    )
    return counted.select(
        event, "field_size", rank.alias("winner_rank"), rnd(F.col("_wp"), 6).alias("winner_probability"),
        (rank == 1).cast("double").alias("top1_hit"), (rank <= top).cast("double").alias("topk_hit"),
        rnd(F.lit(1.0) / rank, 6).alias("reciprocal_rank"), rnd(-F.log("_wp"), 6).alias("event_log_loss"),
        rnd(F.col("_brier"), 6).alias("event_brier"), rnd(gains / F.col("_tied"), 6).alias("ndcg_at_k"),
    )


def event_metric_means(per_event: DataFrame) -> DataFrame:
    return per_event.agg(
        count_rows().alias("n_events"), rnd(F.avg("field_size"), 3).alias("mean_field_size"),
        rnd(F.avg("top1_hit"), 4).alias("top1_accuracy"), rnd(F.avg("topk_hit"), 4).alias("topk_accuracy"),
        rnd(F.avg("reciprocal_rank"), 4).alias("mean_reciprocal_rank"), rnd(F.avg("ndcg_at_k"), 4).alias("mean_ndcg_at_k"),
        rnd(F.avg("event_log_loss"), 4).alias("winner_log_loss"), rnd(F.avg("event_brier"), 4).alias("winner_brier"),
        rnd(F.avg("winner_probability"), 4).alias("mean_winner_probability"),
    )


def _path(names: Column, n: int) -> Column:
    return F.when(F.size(names) >= n, F.array_join(F.slice(names, 1, n), " > "))


def event_board(
    df: DataFrame, event: str, competitor: str, probability: str, actual_position: str | None = None, k: int = 3
) -> DataFrame:
    """Predicted winner, first two and first three per event, with hits against the real finish."""
    k = max(k, 3)
    rows = df.where(F.col(event).isNotNull() & F.col(competitor).isNotNull() & num(probability).isNotNull())
    name = F.col(competitor).cast("string")
    sizes = rows.groupBy(event).agg(count_rows().alias("field_size"))
    best = top_places(
        rows.select(event, name.alias("_name"), num(probability).alias("_p")), event, [F.desc("_p"), F.asc("_name")], k
    )
    predicted = best.groupBy(event).agg(F.array_sort(F.collect_list(F.struct("place", "_name", "_p"))).alias("_b"))
    board = sizes.join(predicted, event).select(
        event, "field_size", F.transform("_b", lambda s: s["_name"]).alias("_names"),
        F.transform("_b", lambda s: s["_p"]).alias("_probs"),
    )
    names = F.col("_names")
    columns = [
        F.col(event), F.col("field_size"), names[0].alias("predicted_winner"),
        rnd(F.col("_probs")[0], 6).alias("predicted_winner_probability"),
        _path(names, 2).alias("predicted_exacta"), _path(names, 3).alias("predicted_podium"),
        names.alias("predicted_top_k"), F.transform("_probs", lambda v: rnd(v, 4)).alias("predicted_top_k_probabilities"),
    ]
    if actual_position is None:
        return board.select(*columns)
    finish = rows.where(num(actual_position) > 0).select(event, name.alias("_name"), num(actual_position).alias("_a"))
    first = top_places(finish, event, [F.asc("_a"), F.asc("_name")], 3)
    actual = first.groupBy(event).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "_name"))), lambda s: s["_name"]).alias("_actual")
    )
    real = F.coalesce("_actual", F.array().cast("array<string>"))

    def hit(n: int, ordered: bool) -> Column:
        a, b = F.slice(names, 1, n), F.slice(F.col("_real"), 1, n)
        same = a == b if ordered else F.sort_array(F.array_distinct(a)) == F.sort_array(F.array_distinct(b))
        return F.coalesce((F.size("_real") >= n) & same, F.lit(False)).cast("double")

    return board.join(actual, event, "left").withColumn("_real", real).select(
        *columns, F.get("_real", F.lit(0)).alias("actual_winner"), _path(F.col("_real"), 2).alias("actual_exacta"),
        _path(F.col("_real"), 3).alias("actual_podium"), hit(1, True).alias("winner_hit"),
        hit(2, True).alias("exacta_ordered_hit"), hit(2, False).alias("exacta_box_hit"),
        hit(3, True).alias("podium_ordered_hit"), hit(3, False).alias("podium_box_hit"),
    )


def event_tickets(board: DataFrame) -> DataFrame:
    hits = ["winner_hit", "exacta_ordered_hit", "exacta_box_hit", "podium_ordered_hit", "podium_box_hit"]
    require_columns(board, hits)
    return board.agg(
        count_rows().alias("n_events"), *[rnd(F.avg(h), 4).alias(h) for h in hits],
        rnd(F.avg("predicted_winner_probability"), 4).alias("mean_top1_probability"),
    )


def valid_events(df: DataFrame, event: str, target: str, min_rows: int = 2) -> DataFrame:
    """Rows of events with enough rows and exactly one winner."""
    rows = df.where(F.col(event).isNotNull() & num(target).isin(0.0, 1.0))
    told = with_group_values(rows, [event], {"_n": count_rows(), "_w": F.sum(num(target))})
    return told.where((F.col("_n") >= min_rows) & (F.col("_w") == 1)).drop("_n", "_w")


def train_event_model(
    df: DataFrame,
    event: str,
    key: str,
    target: str,
    features: Sequence[str],
    algorithm: str = "logistic",
    test_size: float = 0.25,
    temperature: float = 1.0,
    seed: int = 42,
    min_rows: int = 2,
    **prep,
) -> tuple[DataFrame, DataFrame]:
    """Scores of held-out whole events, softmaxed per event, and the binary metrics."""
    rows = valid_events(df, event, target, min_rows).withColumn("label", num(target))
    held_out = hash_unit(event, seed) < test_size
    numeric = [c for c in features if c in numeric_columns(df)]
    text = [c for c in features if c in text_columns(df)]
    # Fitting and scoring read their rows many times, but not the window that tells valid events; only scoring needs names.
    used = list(dict.fromkeys([*numeric, *text, "label"]))
    train = materialize(rows.where(~held_out).select(*used), "event_train")
    test = materialize(rows.where(held_out).select(*dict.fromkeys([event, key, *used])), "event_test")
    if algorithm == "logistic":
        model = LogisticRegression(featuresCol="features", labelCol="label", maxIter=100, regParam=1e-6)
    elif algorithm == "random_forest":
        model = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=100, seed=seed)
    else:
        raise ValueError("algorithm must be logistic or random_forest")
    fitted = Pipeline(stages=[*preprocessing_stages(train, numeric, text, **prep), model]).fit(train)
    p = vector_to_array("probability")[1]
    scored = fitted.transform(test).select(
        event, key, F.col("label").cast("int").alias("actual"), p.alias("predicted_probability"),
        F.col("prediction").cast("int").alias("predicted"), logit(p).alias("raw_score"),
    )
    ranked = event_softmax(scored, event, "raw_score", temperature, "competitive_probability")
    return ranked, classification_metrics(scored, "actual", "predicted_probability", "predicted")
