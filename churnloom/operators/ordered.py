"""Ranks, running sums and moving windows over a whole table, spread over many tasks.

A ``Window`` without partitions would move every row to one task. Here the rows are range
partitioned by the order, numbered inside each range, and written once; the ranges' totals (one row
per range) then give each range its offset.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import count_rows, melt_numeric, num
from ..session import materialize
from .skew import BROADCAST_ROWS, GROUP_ROWS, HOT_ROWS, attach, largest_group

BLOCK_ROWS = 200_000
ONE_TASK_ROWS = 100_000
RANGE_ROWS = 2_000_000
_LOCAL_BITS = 33


def _blocks(df: DataFrame, order: Sequence[str], rows: int | None = None) -> DataFrame:
    """Rows in global order with ``_block`` (range number) and ``_local`` (place inside the range)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rows is not None:
        # An explicit number is not split at run time, so it follows the rows.
        n = max(n, -(-rows // RANGE_ROWS))
    numbered = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    written = materialize(numbered, "ordered")
    return written.select(
        "*",
        F.shiftright("_id", _LOCAL_BITS).cast("int").alias("_block"),
        F.col("_id").bitwiseAND(F.lit(2**_LOCAL_BITS - 1)).alias("_local"),
    ).drop("_id")


def _offsets(totals: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exclusive running sums of one row per block (as many rows as shuffle partitions)."""
    rows = sorted(totals.collect(), key=lambda r: r["_block"])
    types = dict(totals.dtypes)
    running = {n: 0.0 if types[n] == "double" else 0 for n in names}
    out = []
    for r in rows:
        out.append((r["_block"], *[running[n] for n in names]))
        for n in names:
            running[n] += r[n] or 0
    fields = ", ".join(f"_off_{n} {types[n]}" for n in names)
    return totals.sparkSession.createDataFrame(out, f"_block int, {fields}")


def positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Adds the 0-based place of each row in the order; the order must identify rows."""
    blocks = _blocks(df, order, df.count())
    offsets = _offsets(blocks.groupBy("_block").agg(count_rows().alias("n")), ["n"])
    return (
        blocks.join(F.broadcast(offsets), "_block")
        .withColumn(name, F.col("_off_n") + F.col("_local"))
        .drop("_block", "_local", "_off_n")
    )


def running_sums(counts: DataFrame, by: Sequence[str], order: Sequence[str], weights: Sequence[str]) -> tuple[DataFrame, bool]:
    """Adds ``before_<w>`` inside each ``by`` group; also whether the table is small enough to broadcast.

    Up to ``ONE_TASK_ROWS`` counted rows are summed by a plain window; beyond that, range by range.
    """
    counts = materialize(counts, "counts")
    size = counts.count()
    if size <= ONE_TASK_ROWS:
        earlier = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumns({f"before_{w}": F.coalesce(F.sum(w).over(earlier), F.lit(0)) for w in weights}), True
    blocks = _blocks(counts, [*by, *order], size)
    offsets = _offsets(blocks.groupBy("_block").agg(*[F.sum(w).alias(w) for w in weights]), weights)
    earlier = Window.partitionBy("_block").orderBy("_local").rowsBetween(Window.unboundedPreceding, -1)
    out = blocks.join(F.broadcast(offsets), "_block")
    for w in weights:
        out = out.withColumn(f"before_{w}", F.coalesce(F.sum(w).over(earlier), F.lit(0)) + F.col(f"_off_{w}"))
    out = out.drop("_block", "_local", *[f"_off_{w}" for w in weights])
    if by:
        first = out.groupBy(*by).agg(*[F.min(f"before_{w}").alias(f"_first_{w}") for w in weights], count_rows().alias("_rows"))
        out = attach(out, first, by, weight="_rows")
        out = out.withColumns({f"before_{w}": F.col(f"before_{w}") - F.col(f"_first_{w}") for w in weights})
        out = out.drop("_rows", *[f"_first_{w}" for w in weights])
    return out, False


def cumulative(counts: DataFrame, order: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """Adds ``before_<w>``: the sum of ``w`` over all rows earlier in the order."""
    return running_sums(counts, (), order, weights)[0]


def _rank_table(df: DataFrame, column: str, by: Sequence[str]) -> tuple[DataFrame, bool]:
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(count_rows().alias("n"))
    ranked, small = running_sums(counts, by, [column], ["n"])
    ranked = ranked.withColumnRenamed("before_n", "before")
    return ranked.withColumn("avg_rank", F.col("before") + (F.col("n") + 1) / 2.0), small


def average_ranks(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value: its count ``n``, rows ``before`` it and tie-averaged ``avg_rank``."""
    return _rank_table(df, column, by)[0]


def with_average_rank(df: DataFrame, column: str, name: str, by: Sequence[str] = (), percent: bool = False) -> DataFrame:
    """Adds the tie-averaged rank of ``column`` to each row; as a share of the non-null rows if ``percent``."""
    ranks, small = _rank_table(df, column, by)
    if percent:
        # The last value of a group has all its rows before or in it.
        group = ranks.groupBy(*by).agg(F.max(F.col("before") + F.col("n")).alias("_total"))
        ranks = attach(ranks, group, by, small=small) if by else ranks.crossJoin(F.broadcast(group))
        ranks = ranks.withColumn("avg_rank", F.col("avg_rank") / F.col("_total"))
    ranks = ranks.select(*by, column, "n", F.col("avg_rank").alias(name))
    return attach(df, ranks, [*by, column], weight="n", small=small).drop("n")


def with_average_ranks(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Ranks of several columns (``{column: new name}``) from one pass over all their values."""
    cells = melt_numeric(df, list(columns))
    ranks, _ = _rank_table(cells, "value", ["column_name"])
    ranks = materialize(ranks, "ranks")
    # One small job tells how each column's ranks are joined.
    sizes = {r["column_name"]: r for r in ranks.groupBy("column_name").agg(count_rows().alias("values"), F.max("n").alias("most")).collect()}
    for column, name in columns.items():
        mine = ranks.where(F.col("column_name") == column).select(
            F.col("value").alias("_value"), F.col("n").alias("_n"), F.col("avg_rank").alias(name)
        )
        df = df.withColumn("_value", num(column))
        size = sizes.get(column)
        if size is None or size["values"] <= BROADCAST_ROWS:
            df = df.join(F.broadcast(mine), "_value", "left")
        elif size["most"] <= HOT_ROWS:
            df = df.join(mine, "_value", "left")
        else:
            df = attach(df, mine, ["_value"], weight="_n")
        df = df.drop("_value", "_n")
    return df


def with_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the 0-based alphabetical number of each value; null gives -1. Any number of values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(count_rows().alias("_n"), F.lit(1).cast("bigint").alias("one"))
    coded, small = running_sums(counts, (), [column], ["one"])
    coded = coded.select(column, "_n", F.col("before_one").cast("int").alias(name))
    return attach(df, coded, [column], weight="_n", small=small).drop("_n").withColumn(name, F.coalesce(name, F.lit(-1)))


def rank_within(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Row number inside each group; groups above ``group_rows`` rows are ranked over many tasks."""
    if largest_group(df, by) <= group_rows:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    blocks = _blocks(df, [*[F.col(b) for b in by], *order], df.count())
    pieces = materialize(
        blocks.groupBy(*by, "_block").agg(count_rows().alias("_n"), F.min("_local").alias("_start")), "pieces"
    )
    # Only a range's first or last group can go on in another range: at most two rows per range.
    ends = pieces.groupBy("_block").agg(F.max("_start").alias("_last"))
    edge = pieces.join(F.broadcast(ends), "_block").where((F.col("_start") == 0) | (F.col("_start") == F.col("_last")))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = edge.select(*by, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_carried"))
    inside = F.row_number().over(Window.partitionBy("_block", *by).orderBy("_local"))
    return (
        blocks.withColumn("_inside", inside)
        .join(F.broadcast(carried), [*by, "_block"], "left")
        .withColumn(name, (F.col("_inside") + F.coalesce(F.col("_carried"), F.lit(0))).cast("int"))
        .drop("_block", "_local", "_inside", "_carried")
    )


def halo_blocks(df: DataFrame, order: Sequence[str], width: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows cut into equal blocks by global ``position``; each block also gets the ``width - 1`` rows before it.

    A window partitioned by ``_block`` and ordered by ``position`` then sees full history. Drop the
    copies afterwards with ``where("not _copy")``.
    """
    size = max(block_rows, width)
    placed = positions(df, order)
    block = F.floor(F.col("position") / size).cast("bigint")
    spill = F.when(
        (F.col("position") % size) > size - width, F.array(block, block + 1)
    ).otherwise(F.array(block))
    return placed.select("*", F.posexplode(spill).alias("_copied", "_block")).withColumn(
        "_copy", F.col("_copied") == 1
    ).drop("_copied")


def moving(df: DataFrame, order: Sequence[str], width: int, build, block_rows: int = BLOCK_ROWS, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``{name: Column}`` from ``build(window)``, where the window covers at most ``width`` rows.

    Without ``by`` the window runs over the whole table in order; with it, inside each group. Either
    way no task holds more than a block, however large a group is.
    """
    blocks = halo_blocks(df, [*by, *order], width, block_rows)
    window = Window.partitionBy("_block", *by).orderBy("position")
    out = blocks
    for name, column in build(window).items():
        out = out.withColumn(name, column)
    return out.where(~F.col("_copy")).drop("_copy", "_block", "position")


def group_moving(df: DataFrame, by: Sequence[str], order: Sequence[str], width: int, build, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``moving`` with a plain window while every group is known to fit one task."""
    if largest_group(df, by) <= group_rows:
        window = Window.partitionBy(*by).orderBy(*order)
        for name, column in build(window).items():
            df = df.withColumn(name, column)
        return df
    return moving(df, order, width, build, by=by)
