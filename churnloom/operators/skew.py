"""Joins and windows that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import count_rows
from ..session import materialize

BROADCAST_ROWS = 100_000
HOT_ROWS = 2_000_000
GROUP_ROWS = 1_000_000


def attach(
    rows: DataFrame,
    stats: DataFrame,
    on: Sequence[str],
    weight: str | None = None,
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    small: bool = False,
) -> DataFrame:
    """Join one-row-per-key ``stats`` onto ``rows``.

    The stats are written once and counted: a small table is broadcast. A large one is shuffled,
    except for keys whose ``weight`` (rows per key, a column of ``stats``) passes ``hot_rows``;
    there can be at most total/hot_rows of those, so they are broadcast. ``small`` says that the
    caller has already counted the stats.
    """
    on = list(on)
    if small:
        return rows.join(F.broadcast(stats), on, how)
    stats = materialize(stats, "stats")
    if stats.count() <= broadcast_rows:
        return rows.join(F.broadcast(stats), on, how)
    if weight is None:
        return rows.join(stats, on, how)
    hot = stats.where(F.col(weight) > hot_rows)
    if not 0 < hot.count() <= broadcast_rows:
        return rows.join(stats, on, how)
    hot = F.broadcast(hot)
    cold = stats.where(~(F.col(weight) > hot_rows))
    busy = rows.join(hot, on, "inner")
    quiet = rows.join(hot.select(*on), on, "left_anti").join(cold, on, how)
    return busy.unionByName(quiet.select(*busy.columns))


def with_group_values(
    rows: DataFrame, by: Sequence[str], values: Mapping[str, Column], small: bool | None = None, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Adds aggregates of each row's group as columns.

    While every group is known to fit one task (``small``, else counted here) a window does it in one shuffle, which later
    windows and aggregations by the same keys reuse. Beyond that, combined group rows are attached.
    """
    if small is None:
        small = largest_group(rows, by) <= group_rows
    if small:
        window = Window.partitionBy(*by)
        return rows.withColumns({name: value.over(window) for name, value in values.items()})
    stats = rows.groupBy(*by).agg(count_rows().alias("_rows"), *[value.alias(name) for name, value in values.items()])
    return attach(rows, stats, by, "_rows").drop("_rows")


def largest_group(df: DataFrame, by: Sequence[str]) -> int:
    sizes = df.groupBy(*by).agg(count_rows().alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0

