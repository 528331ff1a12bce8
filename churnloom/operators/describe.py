"""Descriptive tables: summaries, shares, correlations, effect sizes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import category_columns, count_rows, num, numeric_columns, rnd
from ..session import materialize
from .ordered import cumulative, positions, with_average_ranks
from .quality import _counted_profile, null_profile, quality_report, rows_of, value_counts
from .quantiles import mode_table, quantile_table

PAIR_BLOCK = 200_000


def corrected_skewness(x: Column) -> Column:
    """Bias-corrected skewness (Spark's is the population form)."""
    n = F.count(x).cast("double")
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(x: Column) -> Column:
    n = F.count(x).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 3) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    stats = {
        "count": lambda x: F.count(x), "mean": lambda x: rnd(F.avg(x), digits),
        "std": lambda x: rnd(F.stddev_samp(x), digits), "min": lambda x: rnd(F.min(x), digits),
        "max": lambda x: rnd(F.max(x), digits), "skewness": lambda x: rnd(corrected_skewness(x), digits),
        "kurtosis": lambda x: rnd(corrected_kurtosis(x), digits),
    }
    wide = df.agg(*[f(num(c)).alias(f"{s}__{i}") for i, c in enumerate(columns) for s, f in stats.items()])
    moments = rows_of(wide, columns, list(stats))
    q = quantile_table(df, columns, [0.25, 0.5, 0.75])
    quart = q.groupBy("column_name").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]]
    )
    return (
        moments.join(F.broadcast(quart), "column_name", "left")
        .withColumn("iqr", rnd(F.col("q75") - F.col("q25"), digits))
        .withColumns({c: rnd(F.col(c), digits) for c in ("q25", "q50", "q75")})
        .orderBy(F.desc("std"), "column_name")
    )


def top_values(df: DataFrame, columns: Sequence[str], top: int = 5) -> DataFrame:
    counts = value_counts(df, columns).withColumn("value", F.coalesce("value", F.lit("<NA>")))
    place = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n"), "value"))
    return counts.withColumn("place", place).where(F.col("place") <= top)


def categorical_summary(df: DataFrame, columns: Sequence[str], top: int = 5) -> DataFrame:
    """Distinct values and the most frequent ones as ``value: count`` text."""
    levels = _counted_profile(df, columns).select("column_name", "distinct_values")
    text = F.concat_ws(": ", F.col("value"), F.col("n").cast("string"))
    best = top_values(df, columns, top).groupBy("column_name").agg(
        F.array_sort(F.collect_list(F.struct("place", text.alias("t")))).alias("a")
    )
    return levels.join(F.broadcast(best), "column_name").select(
        "column_name", "distinct_values", F.concat_ws(", ", F.transform("a", lambda s: s["t"])).alias("top_values")
    ).orderBy("distinct_values", "column_name")


def category_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    levels = _counted_profile(df, columns).select("column_name", F.col("distinct_with_null").alias("distinct_values"))
    return levels.join(F.broadcast(mode_table(df, columns, keep_null=True)), "column_name")


def value_shares(df: DataFrame, column: str, order: Sequence[str] | None = None) -> DataFrame:
    """Rows and share per value; with ``order``, exactly those values, zero where absent."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(count_rows().alias("rows"))
    if order is not None:
        fixed = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(order)], "place int, value string")
        counts = F.broadcast(fixed).join(counts, "value", "left").select(
            "place", "value", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows")
        )
    total = df.agg(count_rows().alias("_total"))
    out = counts.crossJoin(F.broadcast(total)).withColumn("pct_rows", rnd(F.col("rows") / F.col("_total") * 100, 2))
    return out.drop("_total")


def grouped(df: DataFrame, by: Sequence[str], aggregates: dict[str, Column], digits: int | None = None) -> DataFrame:
    """Named aggregates per group, optionally rounded."""
    out = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggregates.items()])
    if digits is None:
        return out
    return out.select(*by, *[rnd(F.col(n), digits).alias(n) if dict(out.dtypes)[n] == "double" else n for n in aggregates])


def crosstab_shares(df: DataFrame, row: str, column: str, digits: int = 3) -> DataFrame:
    """Share of each ``column`` value inside each ``row`` value, zero where a pair is absent (long form)."""
    pairs = df.groupBy(row, column).agg(count_rows().alias("n"))
    named = pairs.withColumn("_level", F.coalesce(F.col(column).cast("string"), F.lit("<NA>"))).withColumn("_row", F.to_json(F.struct(row)))
    # One row that holds the levels: as many as the result has columns in its wide form.
    levels = named.agg(F.array_sort(F.collect_set("_level")).alias("_levels"))
    per = named.groupBy("_row").agg(F.first(row).alias(row), F.sum("n").alias("_total"))
    grid = per.crossJoin(F.broadcast(levels)).withColumn("_level", F.explode("_levels")).drop("_levels")
    counts = named.groupBy("_row", "_level").agg(F.sum("n").alias("n"))
    filled = grid.join(counts, ["_row", "_level"], "left")
    return filled.select(row, F.col("_level").alias(column), rnd(F.coalesce("n", F.lit(0)) / F.col("_total"), digits).alias("share"))


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson", digits: int = 4) -> DataFrame:
    """Upper triangle as (a, b, r); pairs use the rows where both values are present."""
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    data = df.select(*[num(c).alias(c) for c in columns])
    if method == "spearman":
        # Ranks per column are exact for pairs only when no value is missing.
        data = materialize(data, "spearman")
        if data.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first() != tuple([0] * len(columns)):
            parts = [spearman_pair(data, a, b) for a, b in pairs]
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            return out.withColumn("r", rnd(F.col("r"), digits))
        data = with_average_ranks(data, {c: f"_r{i}" for i, c in enumerate(columns)})
        data = data.select(*[F.col(f"_r{i}").alias(c) for i, c in enumerate(columns)])
    wide = data.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), rnd(F.col(f"r{i}"), digits).alias("r")) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*cells)))


def covariance_matrix(df: DataFrame, columns: Sequence[str], min_pairs: int = 3, digits: int = 4) -> DataFrame:
    """Pairwise-complete sample covariances, diagonal included, as (a, b, covariance, n)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in list(columns)[i:]]
    both = [F.count_if(num(a).isNotNull() & num(b).isNotNull()) for a, b in pairs]
    wide = df.agg(
        *[F.covar_samp(num(a), num(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)],
        *[n.alias(f"n{i}") for i, n in enumerate(both)],
    )
    cells = [
        F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"),
            F.when(F.col(f"n{i}") >= min_pairs, rnd(F.col(f"c{i}"), digits)).alias("covariance"), F.col(f"n{i}").alias("n"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*cells)))


def spearman_pair(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman's r of one pair as (a, b, r), from joint value counts with tie-averaged ranks."""
    both = df.select(num(x).alias("x"), num(y).alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    ranked = with_average_ranks(both, {"x": "rx", "y": "ry"})
    return ranked.agg(F.corr("rx", "ry").alias("r"), count_rows().alias("n")).select(
        F.lit(x).alias("a"), F.lit(y).alias("b"), "r", "n"
    )


def dependent_pairs(df: DataFrame, columns: Sequence[str], threshold: float = 0.65) -> DataFrame:
    """Feature pairs whose absolute Spearman correlation reaches the threshold."""
    m = correlation_matrix(df, columns, "spearman")
    return m.select("a", "b", F.abs("r").alias("abs_spearman")).where(F.col("abs_spearman") >= threshold).orderBy(
        F.desc("abs_spearman"), "a", "b"
    )


def weighted_inversions(first: np.ndarray, second: np.ndarray, weight: np.ndarray) -> float:
    """Sum of w_i*w_j over pairs with first_i < first_j and second_i > second_j (distinct values).

    Merge counting, one vectorised sort per level.
    """
    order = np.argsort(first, kind="stable")
    key = np.argsort(np.argsort(second[order], kind="stable"), kind="stable")
    w = weight[order].astype(float)
    place = np.arange(len(w))
    total = 0.0
    size = 1
    while size < len(w):
        chunk = place // (2 * size)
        right = (place // size) % 2 == 1
        by = np.lexsort((key, chunk))
        left_w = np.where(right[by], 0.0, w[by])
        seen = np.cumsum(left_w)
        chunk_end = np.append(np.flatnonzero(np.diff(chunk[by])), len(w) - 1)
        up_to_end = seen[chunk_end][chunk[by]]
        total += float(np.sum(np.where(right[by], w[by] * (up_to_end - seen), 0.0)))
        size *= 2
    return total


def _inversions_between_blocks(placed: DataFrame, rows: int, block: int, fan: int = 16) -> float:
    """Inversions whose two points lie in different blocks of ``p``.

    Level by level, ``fan`` neighbouring blocks form a chunk. Running totals per sub-block in ``q``
    order give each point the weight of earlier sub-blocks that lies beyond it.
    """
    total, size = 0.0, block
    while size < rows:
        sub = F.floor(F.col("p") / size) % fan
        weights = [f"w{s}" for s in range(fan)]
        level = placed.select(
            F.floor(F.col("p") / (size * fan)).alias("chunk"), "q", sub.alias("sub"), F.col("w").cast("double").alias("w"),
            *[F.when(sub == s, F.col("w")).otherwise(0).cast("double").alias(n) for s, n in enumerate(weights)],
        )
        run = cumulative(level, ["chunk", "q"], weights)
        before = sum((F.when(F.col("sub") > s, F.col(f"before_{n}")).otherwise(0.0) for s, n in enumerate(weights)), F.lit(0.0))
        per = run.groupBy("chunk").agg(
            F.sum(F.col("w") * before).alias("cross"),
            *[F.sum(n).alias(f"tot_{n}") for n in weights], *[F.min(f"before_{n}").alias(f"base_{n}") for n in weights],
        )
        reached, pairs = F.lit(0.0), F.lit(0.0)
        for n in weights:
            pairs = pairs + F.col(f"tot_{n}") * reached
            reached = reached + F.col(f"tot_{n}") + F.col(f"base_{n}")
        total += per.agg(F.sum(pairs - F.col("cross"))).first()[0]
        size *= fan
    return total


def kendall_pair(df: DataFrame, x: str, y: str, block: int = PAIR_BLOCK) -> DataFrame:
    """Kendall's tau-b without comparing all pairs, as (a, b, r, n).

    Distinct (x, y) points get two unique places: ``p`` by (x, y), and ``q`` by y with ties in the
    first order. Discordant pairs are then the inversions between the two orders: inside blocks of
    ``p`` in bounded tasks, between blocks from running totals.
    """
    points = (
        df.select(num(x).alias("x"), num(y).alias("y"))
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("x", "y").agg(count_rows().alias("w"))
    )
    placed = materialize(positions(positions(points, ["x", "y"], "p"), ["y", "p"], "q"), "kendall")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        v = weighted_inversions(pdf["p"].to_numpy(), pdf["q"].to_numpy(), pdf["w"].to_numpy())
        return pd.DataFrame({"v": [v]})

    def pairs(c: str) -> Column:
        t = F.col(c).cast("double")
        return F.sum(t * (t - 1) / 2)

    one = (
        placed.groupBy("x").agg(F.sum("w").alias("t")).agg(pairs("t").alias("n1"), F.sum("t").alias("n"))
        .crossJoin(placed.groupBy("y").agg(F.sum("w").alias("t")).agg(pairs("t").alias("n2")))
        .crossJoin(placed.agg(pairs("w").alias("n3"), count_rows().alias("m")))
        .first()
    )
    blocks = placed.select(F.floor(F.col("p") / block).alias("b"), "p", "q", "w")
    discordant = blocks.groupBy("b").applyInPandas(count, "v double").agg(F.sum("v")).first()[0] or 0.0
    discordant += _inversions_between_blocks(placed, one["m"], block)
    n0 = one["n"] * (one["n"] - 1) / 2
    concordant = n0 - one["n1"] - one["n2"] + one["n3"] - discordant
    scale = ((n0 - one["n1"]) * (n0 - one["n2"])) ** 0.5
    tau = (concordant - discordant) / scale if scale else None
    return df.sparkSession.createDataFrame([(x, y, tau, one["n"])], "a string, b string, r double, n bigint")


def quick_report(df: DataFrame, key: str) -> dict[str, DataFrame]:
    """Quality, nulls, numeric and categorical summaries and outliers of a table in one call."""
    from .clean import outliers_iqr

    numbers = [c for c in numeric_columns(df) if c != key]
    texts = category_columns(df)
    out = {"quality": quality_report(df, key), "nulls": null_profile(df)}
    if numbers:
        out["numeric"], out["outliers"] = numeric_summary(df, numbers), outliers_iqr(df, numbers)
    if texts:
        out["categorical"] = categorical_summary(df, texts)
    return out


def effect_sizes(df: DataFrame, value: str, group: str) -> DataFrame:
    """Eta squared over all groups; Cohen's d of the first group (by name) against the second when there are two."""
    v = num(value)
    g = df.where(v.isNotNull() & F.col(group).isNotNull()).groupBy(F.col(group).cast("string").alias("g")).agg(
        count_rows().cast("double").alias("n"), F.avg(v).alias("m"), F.var_samp(v).alias("s2"), F.var_pop(v).alias("v0")
    )
    total = F.sum("n")
    weighted = F.sum(F.col("n") * F.col("m")) / total
    one = g.agg(
        count_rows().alias("groups"), total.alias("n"), weighted.alias("mean"),
        F.sum(F.col("n") * F.col("v0")).alias("within"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("raw"),
        F.min_by(F.struct("n", "m", "s2"), "g").alias("a"), F.max_by(F.struct("n", "m", "s2"), "g").alias("b"),
    )
    between = F.col("raw") - F.col("n") * F.col("mean") * F.col("mean")
    pooled = F.sqrt(
        ((F.col("a.n") - 1) * F.col("a.s2") + (F.col("b.n") - 1) * F.col("b.s2"))
        / F.greatest(F.col("a.n") + F.col("b.n") - 2, F.lit(1.0))
    )
    d = F.when(pooled == 0, 0.0).otherwise((F.col("a.m") - F.col("b.m")) / pooled)
    return one.select(
        "groups",
        F.when(F.col("groups") >= 2, rnd(F.when(between + F.col("within") == 0, 0.0).otherwise(between / (between + F.col("within"))), 4)).alias("eta_squared"),
        F.when(F.col("groups") == 2, rnd(d, 4)).alias("cohen_d"),
    )
