"""Exact quantiles, modes and bin edges without unbounded aggregation buffers.

``percentile`` keeps every distinct value of a group in one buffer. It is used here only when the
largest group is known to be small. Beyond that the wanted order statistics are picked from counts per
distinct value with running sums over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import count_rows, melt_numeric, melt_text
from .ordered import running_sums
from .skew import attach

SMALL_GROUP = 1_000_000


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """Linear-interpolation quantiles: one row per (by..., column_name, prob) with ``value``."""
    cells = melt_numeric(df, columns, by)
    keys = [*by, "column_name"]
    sizes = cells.groupBy(*keys).agg(count_rows().alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest <= small_group:
        levels = [float(p) for p in probs]
        found = cells.groupBy(*keys).agg(F.percentile("value", levels).alias("q"))
        pairs = F.arrays_zip(F.array(*[F.lit(p) for p in levels]).alias("prob"), F.col("q").alias("value"))
        return found.select(*keys, F.explode(pairs).alias("pair")).select(*keys, "pair.prob", "pair.value")
    return _select_order_statistics(cells, keys, probs)


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], small_group: int = SMALL_GROUP
) -> dict[str, dict[float, float | None]]:
    """``quantile_table`` for the whole table as Python numbers (columns x probs, so bounded)."""
    out: dict[str, dict[float, float | None]] = {c: {float(p): None for p in probs} for c in columns}
    for row in quantile_table(df, columns, probs, (), small_group).collect():
        out[row["column_name"]][row["prob"]] = row["value"]
    return out


def _select_order_statistics(cells: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles of groups of any size and number, from counts per distinct value with running sums.

    A value holds the places ``before`` to ``before + n - 1`` of its group, so the two order statistics of a
    probability are the values whose places contain them. Nothing is collected and no group meets one task.
    """
    # One text per group stands for its keys, so that null keys join like others.
    grouped = cells.withColumn("_g", F.to_json(F.struct(*keys)))
    counts = grouped.groupBy("_g", "value").agg(count_rows().alias("n"), *[F.first(k).alias(k) for k in keys])
    ranked, _ = running_sums(counts, ["_g"], ["value"], ["n"])
    totals = ranked.groupBy("_g").agg(F.sum("n").alias("_rows"), count_rows().alias("_values"))
    ranked = attach(ranked, totals, ["_g"], weight="_values")
    levels = F.array(*[F.lit(float(p)) for p in probs])
    place = lambda p: (F.col("_rows") - 1) * p
    holds = lambda i: (i >= F.col("before_n")) & (i < F.col("before_n") + F.col("n"))
    wanted = F.filter(levels, lambda p: holds(F.floor(place(p))) | holds(F.ceil(place(p))))
    hits = ranked.select(*keys, "_g", "value", "before_n", "n", "_rows", F.explode(wanted).alias("prob"))
    at = place(F.col("prob"))
    ends = hits.groupBy("_g", "prob").agg(
        *[F.first(k).alias(k) for k in keys],
        F.max(at - F.floor(at)).alias("part"),
        F.max(F.when(holds(F.floor(at)), F.col("value"))).alias("low"),
        F.max(F.when(holds(F.ceil(at)), F.col("value"))).alias("high"),
    )
    return ends.select(*keys, "prob", ((1 - F.col("part")) * F.col("low") + F.col("part") * F.col("high")).alias("value"))


def mode_table(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), keep_null: bool = False) -> DataFrame:
    """Most frequent value as text per (by..., column_name); the lowest value wins ties."""
    cells = melt_text(df, columns, by)
    if not keep_null:
        cells = cells.where(F.col("value").isNotNull())
    counts = cells.groupBy(*by, "column_name", "value").agg(count_rows().alias("n"))
    order = F.struct((-F.col("n")).alias("n"), F.col("value").isNull().alias("missing"), F.col("value").alias("v"))
    return counts.groupBy(*by, "column_name").agg(F.min(order).alias("m")).select(
        *by, "column_name", F.col("m.v").alias("mode"), (-F.col("m.n")).alias("mode_rows")
    )


def bin_of(x: Column, edges: Sequence[float]) -> Column:
    """Right-closed bin number (0-based), lowest edge included; null outside the edges."""
    out = F.when(x.isNull() | (x < edges[0]) | (x > edges[-1]), F.lit(None).cast("int"))
    for i, upper in enumerate(edges[1:]):
        out = out.when(x <= upper, F.lit(i))
    return out


def distinct_edges(values: Sequence[float | None]) -> list[float]:
    return sorted({v for v in values if v is not None})
